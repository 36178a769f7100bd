"""Near-duplicate classes with DartMinHash signatures.

A text is the set of its word shingles, each of weight 1, so that candidates are
found by the similarity they are verified by. Every element owns the region weight x rank of a dart board, cut
into strips of weight 1; hashed darts fall into a strip as a Poisson process
along the rank, each with a height in the strip and a coordinate. A text keeps
the darts inside its own regions up to rank (k ln k + 2k) / total weight, and of
those the earliest per coordinate; where a coordinate got none, the rank doubles.
Two texts agree in a coordinate with probability equal to their weighted Jaccard
similarity, and a signature costs O(elements + k log k).

Then, on distinct texts only (copies collapse by a 128-bit hash of their words):

1. coordinates are banded and texts with an equal band meet in a bucket; each is
   paired with the most central text of the bucket, the one with most company
   over all its buckets, never with all others;
2. pairs are verified: exact Jaccard similarity of the shingle sets;
3. verified links form components. Buckets that still hold several components
   are settled exactly: their texts outside the largest component are joined
   with the texts of all such buckets on the rarest shingles (a prefix filter:
   the place of a shingle tells the lengths a text can reach by it, the shorter
   text is sent to the length classes it reaches, the longer to its own), texts
   of one component never with each other, and what passes is verified. A text
   reaches its own length only by the rarest ninth of its shingles (at 0.8), so
   texts of one template meet by it only where they are that much alike.

Defined results: words are cut at white space of the lower-cased text; a text of
fewer words than a shingle is one shingle; a null text or one without words is
similar to nothing, and is a class of its own; the class id is the smallest
doc_id of the class (null ids only if it has no other); rows that repeat a
doc_id are judged by their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, narrowed, slices, table_bytes
from tidemark.llm.components import connected_components
from tidemark.llm.hashing import U64, hash_words, mix, rolling

SHINGLE = 5
_STRIPS = 50_000  # strips, and texts, that are thrown at together: bounds the work arrays
_TEXTS = 64
_NONE = np.inf


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode()


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles in order; of a shorter text, one over all its words."""
    return rolling(words, min(size, len(words))) if len(words) else words


def _throw(
    strip: np.ndarray, height: np.ndarray, text: np.ndarray, limit: np.ndarray, k: int, best: np.ndarray, dart: np.ndarray
) -> None:
    """Throw darts into the strips up to each strip's rank limit; best[text, coordinate] and dart keep the earliest."""
    live, rank, m = np.arange(len(strip)), np.zeros(len(strip)), 0
    while len(live):
        chunk = int(max(1, min(np.ceil(limit[live].max()) + 4, 400_000 // len(live))))
        number = np.arange(m, m + chunk, dtype=U64)
        h = mix(strip[live][:, None] + number[None, :] * U64(0xD1B54A32D192ED03))
        gap = -np.log(((h >> U64(11)).astype(np.float64) + 0.5) / (1 << 53))
        ranks = rank[live][:, None] + np.cumsum(gap, axis=1)
        other = mix(h + U64(0x8CB92BA72F3D8DD7))
        inside = (ranks <= limit[live][:, None]) & (((other >> U64(40)).astype(np.float64) / (1 << 24)) < height[live][:, None])
        row, col = np.nonzero(inside)
        cell = text[live[row]] * k + ((other[row, col] & U64(0xFFFFFFFF)) % U64(k)).astype(np.int64)
        r, d = ranks[row, col], h[row, col]
        np.minimum.at(best, cell, r)
        won = best[cell] == r
        dart[cell[won]] = d[won]
        rank[live] = ranks[:, -1]
        live, m = live[ranks[:, -1] <= limit[live]], m + chunk


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """k coordinates (dart hashes) for each weighted set of (element hashes, weights), none of them empty."""
    out = np.zeros((len(sets), k), dtype=U64)
    total = np.array([w.sum() for _, w in sets])
    todo, reach = np.arange(len(sets)), k * np.log(max(k, 2)) + 2 * k
    while len(todo):
        strips, heights, owner = [], [], []
        for at, i in enumerate(todo):
            element, weight = sets[i]
            n = np.ceil(weight).astype(np.int64)
            which = np.repeat(np.arange(len(element)), n)
            level = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            strips.append(mix(element[which] + level.astype(U64) * U64(0x9E3779B97F4A7C15)))
            heights.append(np.minimum(1.0, weight[which] - level))
            owner.append(np.full(len(which), at))
        text = np.concatenate(owner)
        best, dart = np.full(len(todo) * k, _NONE), np.zeros(len(todo) * k, dtype=U64)
        _throw(np.concatenate(strips), np.concatenate(heights), text, (reach / total[todo])[text], k, best, dart)
        filled = (best.reshape(-1, k) < _NONE).all(axis=1)
        out[todo[filled]] = dart.reshape(-1, k)[filled]
        todo, reach = todo[~filled], 2 * reach  # darts up to the old rank stay the same, so it only adds later ones
    return out


def _band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cut = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=U64), cut.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * U64(0x9E3779B97F4A7C15) + cut[:, :, r])
    return key


def _sign_batch(texts: list[str | None], bands: int, rows: int):
    """Two hashes of the words and the band keys of each text; None where it has no words."""
    out: list = [None] * len(texts)
    words = []
    for i, t in enumerate(texts):
        h, _ = hash_words([_bytes(t)])
        words.append(h)
    order = sorted((i for i in range(len(texts)) if len(words[i])), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):  # texts of like length together, so that their rank limits are alike
        end, load = at, 0
        while end < len(order) and end - at < _TEXTS and (end == at or load + len(words[order[end]]) <= _STRIPS):
            load += len(words[order[end]])
            end += 1
        group, sets = order[at:end], []
        for i in group:
            element = np.unique(shingles(words[i]))
            sets.append((element, np.ones(len(element))))
        keys = _band_keys(signatures(sets, bands * rows), bands, rows)
        for i, key in zip(group, keys):
            n = len(words[i])
            place = np.arange(n, dtype=U64) * U64(0x9E3779B97F4A7C15)
            one, two = (int(mix(words[i] + place + U64(s)).sum(dtype=U64)) ^ n for s in (1, 2))
            out[i] = (one, two, key)
        at = end
    return out


def sign(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, h, f1, f2, bands): h hashes the text as it stands, f1 and f2 its words (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            signed = _sign_batch(batch.column("text").to_pylist(), bands, rows)
            signed_64 = [[None if s is None else np.uint64(s[j]).astype(np.int64).item() for s in signed] for j in (0, 1)]
            keys = [None if s is None else s[2].view(np.int64).tolist() for s in signed]
            hashes = [pa.array(x, pa.int64()) for x in signed_64]
            columns = [batch.column("doc_id"), batch.column("h"), *hashes, pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "f1", "f2", "bands"])

    text = F.col("text").cast("string")
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return rows_in.mapInArrow(run, "doc_id long, h long, f1 long, f2 long, bands array<long>")


def _shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles): the distinct shingle hashes of each node (node, h), sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [np.unique(shingles(hash_words([_bytes(t)])[0])).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    text = F.col("text").cast("string")
    texts = docs.select(F.xxhash64(text).alias("h"), text.alias("text")).groupBy("h").agg(F.first("text").alias("text"))
    return texts.join(nodes, "h").select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def _rows(lists: pa.Array) -> list[np.ndarray]:
    ends = lists.offsets.to_numpy()
    flat = lists.flatten().to_numpy()
    return [flat[a:b] for a, b in zip((ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist())]


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) whose shingle sets have a Jaccard similarity of ``threshold`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_rows(batch.column("x")), _rows(batch.column("y"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame, threshold: float = 0.8, bands: int = 32, rows: int = 7) -> DataFrame:
    """(doc_id, text_hash, class_id, class_key) for every row of ``docs`` (doc_id, text).

    ``text_hash`` is xxhash64 of the text, which tells rows that repeat a doc_id
    apart; ``class_key`` is a number of the class that no other class has, null
    for texts without words.

    With 32 bands of 7 rows a pair at similarity 0.8 meets in a bucket with
    probability 0.9995, one at 0.5 with 0.22, one at 0.3 with 0.007.
    """
    signed = materialize(sign(docs, bands, rows).withColumn("row", F.monotonically_increasing_id()), "signatures")
    texts = materialize(
        signed.where("f1 is not null")
        .groupBy("f1", "f2")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.first("h").alias("h"), F.first("bands").alias("bands")),
        "distinct-texts",
        table_bytes(signed),
    )
    members = texts.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(members.join(materialize(shared, "buckets", table_bytes(texts)), "key"), "bucket-members", 2 * table_bytes(texts))
    size = table_bytes(members)
    company = materialize(members.groupBy("node").agg(F.sum("n").alias("company")), "company", size)
    hubs = members.join(company, "node").groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("hub"))
    paired = members.join(materialize(hubs, "hubs", size), "key").where("node != hub")
    paired = paired.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    pairs = materialize(paired, "pairs", size)
    # Every text that can be compared is a member of a shared bucket.
    needed = texts.select("node", "h").join(members.select("node").distinct(), "node", "left_semi")
    sets = materialize(_shingle_sets(docs, needed), "shingle-sets", 2 * table_bytes(docs))
    links = materialize(_verify(pairs, sets, threshold), "links", table_bytes(pairs) + table_bytes(sets))
    components = connected_components(links)
    components = _settle(members.select("key", "node"), pairs, links, components, sets, threshold)
    # Class ids: the smallest doc_id of each component.
    placed = texts.select("f1", "f2", "node", "doc_id").join(components, "node", "left")
    placed = materialize(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    classes = materialize(placed.groupBy("component").agg(F.min("doc_id").alias("class_id")), "classes", table_bytes(placed))
    placed = placed.join(classes, "component").select("f1", "f2", "class_id", F.col("component").alias("class_key"))
    placed = materialize(placed, "class-of-text", table_bytes(signed))
    joined = signed.select("doc_id", "h", "f1", "f2").join(placed, ["f1", "f2"], "left")
    class_id = F.when(F.col("f1").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return joined.select("doc_id", F.col("h").alias("text_hash"), class_id.alias("class_id"), "class_key")


def _length_class(size: Column) -> Column:
    """Number of the class of sizes, each 5 % wider than the one before."""
    return F.floor(F.log(F.greatest(size.cast("double"), F.lit(1.0))) / float(np.log(1.05))).cast("int")


def _sides(ranked: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The shorter and the longer texts of the prefix join on (token, length), of (node, component, outside, tokens).

    At the rarest shingle that two texts share, they share no more than what is
    left of either: ``reach`` is the length up to which a text can be similar to
    this one if that shingle stands here.
    """
    size = F.size("tokens")
    # Behind this prefix a shingle reaches no text that is long enough to be similar.
    prefix = F.slice("tokens", 1, (F.floor(size * (1 - threshold) + 1e-6) + 1).cast("int"))
    placed = ranked.select("node", "component", "outside", size.alias("size"), F.posexplode(prefix).alias("place", "t"))
    reach = (F.col("size") - F.col("place")) * ((1 + threshold) / threshold) - F.col("size")
    placed = placed.where("t.n > 1").select("node", "component", "outside", "size", "t.token", reach.alias("reach"))
    longer = materialize(placed, "shingle-prefixes")
    farthest = _length_class(F.least(F.col("reach"), F.col("size") / threshold) + 1e-6)
    shorter = longer.where(F.col("reach") >= F.col("size") - 1e-6)
    shorter = shorter.withColumn("length", F.explode(F.sequence(_length_class(F.col("size")), farthest)))
    longer = longer.withColumn("length", _length_class(F.col("size")))
    columns = ("node", "component", "outside", "size", "reach")
    one, two = (side.select("token", "length", *(F.col(c).alias(f"{c}_{k}") for c in columns)) for side, k in ((shorter, "a"), (longer, "b")))
    return one, two


def _settle(members: DataFrame, compared: DataFrame, links: DataFrame, components: DataFrame, sets: DataFrame, threshold: float):
    """Find the links between components that meet in a bucket; see 3. above."""
    placed = members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct("n", "component")).alias("top")
    largest = parts.groupBy("key").agg(top, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    largest = materialize(largest.select("key", F.col("top.component").alias("largest")), "open-buckets", table_bytes(members))
    open_rows = placed.join(largest, "key").select("node", "component", (F.col("component") != F.col("largest")).alias("outside"))
    nodes = materialize(open_rows.groupBy("node", "component").agg(F.max("outside").alias("outside")), "open-texts", table_bytes(members))
    tokens = materialize(sets.join(nodes, "node").select("node", F.explode("shingles").alias("token")), "open-shingles")
    counts = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shingle-counts", table_bytes(tokens))
    # A shingle of one text alone joins nothing, but takes its place in the order of rarity.
    token = F.struct(F.coalesce("n", F.lit(1)).alias("n"), "token")
    ranked = tokens.join(counts, "token", "left").groupBy("node").agg(F.array_sort(F.collect_list(token)).alias("tokens"))
    one, two = _sides(narrowed(ranked.join(nodes, "node"), table_bytes(sets)), threshold)
    near = (F.col("size_b") <= F.col("reach_a") + 1e-6) & (F.col("size_a") <= F.col("reach_b") + 1e-6)
    order = F.expr("size_a < size_b or (size_a = size_b and node_a < node_b)")
    apart = F.expr("component_a != component_b")

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, ["token", "length"]).where(apart & near & order).select("node_a", "node_b")

    # At least one of the two is outside the largest component of a bucket.
    met = meet(one.where("outside_a"), two).union(meet(one.where("not outside_a"), two.where("outside_b")))
    new = met.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()
    new = materialize(new.join(compared, ["a", "b"], "left_anti"), "pairs")
    found = materialize(_verify(new, sets, threshold), "links", table_bytes(new) + table_bytes(sets))
    if found.isEmpty():
        return components
    return connected_components(links.unionByName(found))

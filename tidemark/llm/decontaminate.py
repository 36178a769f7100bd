"""Benchmark decontamination by a prefix-filtered join, in built-in expressions only.

A *window* is ``size`` consecutive words of an item (a shorter item is one
window). A document must hold all words of a window in order to contain it, so
one necessary token a window is enough to find every occurrence: its rarest
word in the corpus, at a known offset. Documents' words join these prefix
tokens; an occurrence must start inside the text and end inside it (positional
and length bounds); what is left is verified word by word.

The prefix table is written out, so its size is known. Under Spark's broadcast
threshold the words of a document are exploded, joined and verified in one
stage, and no word is ever shuffled. Beyond it, words are shuffled to the
prefix tokens, and each candidate to the piece of the text (written once) in
which it starts, so that it carries some PIECE words however long the text is,
and a long text's candidates are spread over its pieces.

Defined results: a null text has no words and an item without words no window;
rows that repeat a doc_id are judged each by itself; items that share a window
are all listed; of words equally rare in a window the first in it is its prefix;
very long texts are handled whole; an item_id of null marks words as hit but is
not listed; empty tables give no rows, or rows without hits; other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_limit, materialize, table_bytes

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PIECE = 64  # words a candidate meets, beside those of its window
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, then maximal runs of 0-9, a-z and all characters beyond ASCII."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is the cheaper way where it cannot touch a letter beyond A-Z.
    beyond = plain.rlike(r"[^\x00-\x7F]")
    lowered = F.when(beyond, F.translate(plain, _UPPER, _UPPER.lower())).otherwise(F.lower(plain))
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(window, items): the distinct windows of all items, and the ids of the items that hold each."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    length = F.least(F.size("w"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    windows = F.transform(starts, lambda i: F.slice("w", i, length))
    each = items.where(F.size("w") > 0).select("item", F.explode(windows).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items"))


def _word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each word of the vocabulary stands in the whole corpus."""
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    if table_bytes(vocabulary) <= broadcast_limit(docs.sparkSession):
        return words.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "word")


def prefix_table(docs: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    """(word, entries): the windows whose rarest word this is, with its offset in each."""
    windows = materialize(item_windows(benchmark, size), "item-windows", size * table_bytes(benchmark))
    tokens = windows.select("window", "items", F.posexplode("window").alias("offset", "word"))
    vocabulary = materialize(tokens.select("word").distinct(), "item-words", size * table_bytes(windows))
    counts = materialize(_word_counts(docs, vocabulary), "item-word-counts", table_bytes(docs))
    rarest = (
        tokens.join(counts, "word", "left")
        .groupBy("window")
        .agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("least"),
            F.first("items").alias("items"),
        )
    )
    entry = F.struct(
        F.col("least.offset").alias("offset"),
        F.size("window").alias("length"),
        F.array_join("window", " ").alias("text"),
        "items",
    )
    grouped = rarest.groupBy(F.col("least.word").alias("word")).agg(F.collect_list(entry).alias("entries"))
    return materialize(grouped, "item-prefixes", size * table_bytes(windows))


def _verified(entries: Column, words: Column, at: Column) -> Column:
    """Those entries that really stand in ``words`` around position ``at``: array<struct<start, length, items>>."""

    def holds(e: Column) -> Column:
        start = at - e["offset"]
        inside = (start >= 0) & (start + e["length"] <= F.size(words))
        there = F.array_join(F.slice(words, F.greatest(start, F.lit(0)) + 1, e["length"]), " ")
        return F.when(inside, there == e["text"]).otherwise(False)

    return F.transform(
        F.filter(entries, holds),
        lambda e: F.struct((at - e["offset"]).alias("start"), e["length"].alias("length"), e["items"].alias("items")),
    )


def _pieces(rows: DataFrame, size: int) -> DataFrame:
    """(row, piece, part): the words of each text in pieces, each long enough for a window that starts in its first PIECE words."""
    numbers = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / PIECE).cast("int"))
    parts = F.transform(numbers, lambda k: F.slice("words", k * PIECE + 1, PIECE + size - 1))
    return rows.where(F.size("words") > 0).select("row", F.posexplode(parts).alias("piece", "part"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, items (sorted ids of the items found), n_occurrences.

    ``text_hash`` is xxhash64 of the text, which tells rows that repeat a doc_id apart.
    """
    spark = docs.sparkSession
    prefixes = prefix_table(docs, benchmark, size)
    text_hash = F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_hash, words_of(F.col("text")).alias("words"))
    none = F.lit(None).cast("array<struct<start: int, length: int, items: array<string>>>")
    if table_bytes(prefixes) <= broadcast_limit(spark):
        tokens = rows.select("row", "doc_id", "text_hash", "words", F.posexplode_outer("words").alias("at", "word"))
        # The first word of a text stays whether it matches or not: every text gives a row.
        first = F.coalesce("at", F.lit(0)) == 0
        kept = tokens.join(F.broadcast(prefixes), "word", "left").where(F.col("entries").isNotNull() | first)
        found = kept.select(
            "row",
            "doc_id",
            "text_hash",
            F.size("words").alias("n"),
            F.when(F.col("entries").isNotNull(), _verified(F.col("entries"), F.col("words"), F.col("at"))).otherwise(none).alias("hits"),
        )
    else:
        rows = materialize(rows, "decontaminate-words")
        base = ("row", "doc_id", "text_hash", F.size("words").alias("n"))
        tokens = rows.select(*base, F.posexplode("words").alias("at", "word"))
        start = F.col("at") - F.col("e.offset")
        candidates = (
            tokens.join(prefixes, "word")
            .select("row", "doc_id", "text_hash", "n", "at", F.explode("entries").alias("e"))
            .where((start >= 0) & (start + F.col("e.length") <= F.col("n")))
            .select("row", "doc_id", "text_hash", "n", "e", start.alias("start"), F.floor(start / PIECE).cast("int").alias("piece"))
        )
        pieces = _pieces(rows, size)
        there = F.array_join(F.slice("part", F.col("start") - F.col("piece") * PIECE + 1, F.col("e.length")), " ")
        met = candidates.join(pieces, ["row", "piece"]).where(there == F.col("e.text"))
        hit = F.struct("start", F.col("e.length").alias("length"), F.col("e.items").alias("items"))
        hits = met.select("row", "doc_id", "text_hash", "n", F.array(hit).alias("hits"))
        found = hits.unionByName(rows.select(*base, none.alias("hits")))
    return (
        found.groupBy("row", "doc_id", "text_hash")
        .agg(F.max("n").cast("long").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"))
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.size(
                F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))))
            ).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))).alias("items"),
            F.size(F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"], h["length"])))).alias("n_occurrences"),
        )
    )

"""Driver queries of the ``llm`` operators, and DuckDB SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat_format import format_conversations, read_back
from tidemark.llm.dart_minhash import near_duplicate_classes
from tidemark.llm.decontaminate import contamination
from tidemark.llm.hard_negatives import hard_negatives, labelled_vectors
from tidemark.llm.language_id import fit_language_model, predict_language
from tidemark.llm.piece_codec import decode_documents, encode_documents, read_model
from tidemark.llm.secret_ledger import BASE_KINDS, find_secrets
from tidemark.llm.source_divergence import audit_sources
from tidemark.llm.source_mixing import mix_sources
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.url_templates import TreeSettings, UrlRule, filter_urls
from tidemark.llm.vector_topk import integer_vectors, top_k
from tidemark.paths import fresh_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


_SUBSTRING_DEDUP = """
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, i, list_slice(w, i, i + 12) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS first_doc FROM s GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p
  FROM s JOIN f USING (g) WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p
  WHERE gone.p IS NULL GROUP BY words.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def q_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"), fresh_dir(spark, "secret-ledger"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(*kinds):
        return F.filter("findings", lambda s: s["kind"].isin(*kinds))

    base = of_kind(*BASE_KINDS)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


#: The conversation that the op10 contract adds: control strings inside texts.
ADDED_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def q_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [F.struct(*(F.lit(v).alias(c) for c, v in zip(turns.columns, row))) for row in ADDED_CONVERSATION]
    added = spark.range(1).select(F.inline(F.array(*rows)))
    out = format_conversations(turns.unionByName(added))
    read = out.withColumn("turns", read_back(F.col("formatted")))
    # The loss mask of the segments, over the texts read back.
    trained = F.array_join(
        F.zip_with("turns", "segments", lambda t, s: F.when(s["loss"], t["text"]).otherwise(F.lit(""))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


_CONTROL = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[SEP]")


def _sql_escape(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in _CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_CHAT_FORMAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (
  SELECT *,
    CASE role WHEN 'system' THEN 8 + 11 WHEN 'user' THEN 7 + 8 WHEN 'assistant' THEN 3 + 4
      ELSE 6 + length({_sql_escape("role")}) + 5 + 7 END + length({_sql_escape("text")}) AS chars,
    CASE WHEN i = 1 THEN role IN ('system', 'user')
      ELSE (before, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) END AS ok
  FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY i)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(ok) AS valid
FROM f GROUP BY conv_id
"""


def _remainder(n: int):
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, labels, trainable=_remainder(3) != 1)
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def q_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_language_model(docs, trainable=_remainder(5) != 0)
    return predict_language(docs, model).select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def q_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def q_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_table(spark, sf_dir, "documents"), threshold=0.8)


def q_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(_table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("vec_id % 100 = 0"), vectors, k=10)


_VECTOR_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
_DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + least(len(w), 10) - 1) AS g, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (g, n)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, s + unnest(range(0, n)) AS q FROM hits) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""

#: The rules of the op9 contract.
URL_RULES = (
    UrlRule("net", "/", "block"),
    UrlRule("example.net", "/en/", "allow"),
    UrlRule("example.com", "/de/", "block"),
    UrlRule("org", "/fr/", "allow"),
)


def q_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def _url_sql() -> str:
    s = TreeSettings()
    rules = sorted(URL_RULES, key=lambda r: -len(r.name))

    def longest(value):
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in rules
        ) + " END"

    def purity(block, labelled, free):
        return f"({block} + CAST({s.prior} AS DOUBLE) * ({free} + CAST({s.strength} AS DOUBLE))) / ({labelled} + {free} + CAST({s.strength} AS DOUBLE))"

    shape = (
        "list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: "
        "regexp_replace(regexp_replace(x, '[0-9a-f]{12,}', '<hex>', 'g'), '[0-9]+', '<n>', 'g'))"
    )
    ctes = [
        "a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)",
        "b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, "
        "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a)",
        f"c AS (SELECT *, {longest(lambda r: r.name)} AS rule, {longest(lambda r: r.verdict)} AS ruled, {shape} AS full_shape FROM b)",
        f"u AS (SELECT *, CASE WHEN len(full_shape) <= {s.depth} THEN full_shape ELSE "
        f"list_append(list_slice(full_shape, 1, {s.depth - 1}), array_to_string(list_slice(full_shape, {s.depth}, len(full_shape)), '/')) END AS shape FROM c)",
        "s0 AS (SELECT host, shape, '' AS template, count(*) FILTER (ruled = 'block') AS block, "
        "count(*) FILTER (ruled = 'allow') AS allow, count(*) FILTER (ruled IS NULL) AS free FROM u GROUP BY ALL)",
    ]
    for k in range(s.depth):
        ctes += [
            f"e{k} AS (SELECT host, template, shape[{k + 1}] AS child, coalesce(shape[{k + 2}], '') AS next, sum(block + allow + free) AS n, "
            f"sum(block) AS b, sum(block + allow) AS l, sum(free) AS u FROM s{k} WHERE len(shape) > {k} GROUP BY ALL)",
            f"c{k} AS (SELECT host, template, child, sum(n) AS n_child, count(*) AS kinds, sum(b) AS b, sum(l) AS l, sum(u) AS u, "
            f"first(next ORDER BY n DESC, next DESC) AS cluster FROM e{k} GROUP BY host, template, child HAVING sum(n) >= {s.support})",
            f"f{k} AS (SELECT e.host, e.template, e.child, e.next, e.n, c.n_child, c.kinds, c.b, c.l, c.u, c.cluster "
            f"FROM e{k} e JOIN c{k} c USING (host, template, child))",
            f"m{k} AS (SELECT host, template, cluster, count(*) AS members, sum(n_child) AS n_cluster, "
            f"{purity('sum(b)', 'sum(l)', 'sum(u)')} AS cluster_purity FROM c{k} GROUP BY ALL)",
            f"p{k} AS (SELECT host, template, cluster, next, sum(n) AS n_pool FROM f{k} GROUP BY ALL)",
            f"l{k} AS (SELECT host, template, child, CASE WHEN members = 1 OR sum(greatest(n / n_child - n_pool / n_cluster, 0)) > "
            f"{s.tolerance} + {s.noise} * sqrt(kinds / n_child) OR (l > 0 AND abs({purity('b', 'l', 'u')} - cluster_purity) > {s.apart}) "
            f"THEN child ELSE '*(' || cluster || ')' END AS branch "
            f"FROM f{k} JOIN p{k} USING (host, template, cluster, next) JOIN m{k} USING (host, template, cluster) "
            f"GROUP BY host, template, child, cluster, n_child, kinds, members, b, l, u, cluster_purity)",
            f"s{k + 1} AS (SELECT s.host, s.shape, s.template || CASE WHEN len(s.shape) <= {k} THEN '' ELSE "
            f"'/' || coalesce(l.branch, '*') END AS template, block, allow, free FROM s{k} s LEFT JOIN l{k} l "
            f"ON s.host = l.host AND s.template = l.template AND s.shape[{k + 1}] = l.child)",
        ]
    ctes.append(
        f"r AS (SELECT host, template FROM s{s.depth} GROUP BY ALL HAVING sum(block + allow) > 0 "
        f"AND {purity('sum(block)', 'sum(block + allow)', 'sum(free)')} >= {s.reject})"
    )
    ctes.append(f"x AS (SELECT DISTINCT host, shape FROM s{s.depth} JOIN r USING (host, template))")
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT page_id, host, path, rule, "
        "coalesce(ruled, CASE WHEN x.shape IS NOT NULL THEN 'block' END, 'allow') AS verdict FROM u LEFT JOIN x USING (host, shape)"
    )


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(rows.withColumn("label", shifted), scale=256)
    return hard_negatives(vectors.where("vec_id % 100 = 0"), vectors, positives=5, negatives=10, low=30, high=90)


_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS i FROM s WHERE same) WHERE i <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def q_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query's model is found through it

    model = read_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    decoded = decode_documents(encode_documents(_table(spark, sf_dir, "documents"), model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def q_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(_table(spark, sf_dir, "documents"), least=3, top=200)


_SOURCE_DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t WHERE (lang, term) IN (SELECT lang, term FROM k) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total, count(*) AS v FROM k GROUP BY lang),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000 * (CAST(coalesce(c.n, 0) AS HUGEINT) + 1)) // (coalesce(gt.total, 0) + lt.v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (CAST(k.n AS HUGEINT) + 1)) // (lt.total + lt.v) AS BIGINT) AS q
  FROM g JOIN k USING (lang) JOIN lt USING (lang) LEFT JOIN gt USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": q_substring_dedup,
    "op2_toxicity": q_toxicity,
    "op3_secret_ledger": q_secret_ledger,
    "op4_source_mixing": q_source_mixing,
    "op5_language_id": q_language_id,
    "op6_dart_minhash": q_dart_minhash,
    "op7_decontaminate": q_decontaminate,
    "op8_vector_topk": q_vector_topk,
    "op9_url_templates": q_url_templates,
    "op10_chat_format": q_chat_format,
    "op11_hard_negatives": q_hard_negatives,
    "op12_piece_codec": q_piece_codec,
    "op13_source_divergence": q_source_divergence,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": _SUBSTRING_DEDUP,
    "op7_decontaminate": _DECONTAMINATE,
    "op8_vector_topk": _VECTOR_TOPK,
    "op9_url_templates": _url_sql(),
    "op10_chat_format": _CHAT_FORMAT,
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op13_source_divergence": _SOURCE_DIVERGENCE,
}

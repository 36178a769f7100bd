"""The corpus pipeline: from raw documents to a mixed training corpus.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns the documents that stay, which are written and read again as the next
stage's input. All but the last return the columns of ``documents``; the last
adds ``copies``, how often the mix takes the document.

A row is told apart by its doc_id and the hash of its text. Rows that are equal
in both are one document to the second stage, and go or stay together in the
others; the last stage gives each its copies.

Defined results: a null text, one without letters, or one in a language that was
not learned (or junk) goes with the first stage (no language); a later stage given such rows keeps them, except that the mix
takes nothing without words. A null doc_id is a value like any other and the
last choice among near-duplicates, a null source a source of its own; null
``lang`` and ``n_chars`` change nothing. Of near-duplicates of one doc_id, the
text with the smaller hash stays. Columns beside those of ``documents`` are
carried along, whatever their names, except that the last stage replaces one
named ``copies``. An empty table stays empty.

``run`` has no SQL form (the language model and the tilted rates are iterative), so it is
tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, narrowed, table_bytes
from tidemark.llm.dart_minhash import near_duplicate_classes
from tidemark.llm.decontaminate import contamination
from tidemark.llm.language_id import UNKNOWN, fit_language_model, predict_language
from tidemark.llm.secret_ledger import redact
from tidemark.llm.source_mixing import mix_sources
from tidemark.paths import fresh_dir


def _row(docs: DataFrame) -> Column:
    """All columns as one, so that none can clash with a column of ours."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _key(doc_id: str = "doc_id", text_hash: Column | None = None) -> Column:
    """doc_id and text hash as one value; equal to itself also where the doc_id is null."""
    hashed = F.xxhash64(F.col("text").cast("string")) if text_hash is None else text_hash
    return F.struct(F.col(doc_id).cast("long").alias("doc_id"), hashed.alias("text_hash")).alias("key")


def _columns(rows: DataFrame, docs: DataFrame) -> list[Column]:
    return [F.col(f"row.`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; learned from those whose crc32(doc_id) modulo 5 is not 0."""
    trainable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = fit_language_model(docs, trainable)
    predicted = predict_language(docs.select(_row(docs)), model, keep="row", reject=True)
    kept = predicted.where(F.col("lang_pred") != UNKNOWN)
    return kept.select(*_columns(kept, docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the smallest doc_id. Texts without words all stay."""
    classes = near_duplicate_classes(docs).where("class_key is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("first")
    kept = materialize(classes.groupBy("class_key").agg(first).select(_key("first.doc_id", F.col("first.text_hash"))), "class-firsts", table_bytes(docs))
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(worded).select(_row(docs), _key())
    one = rows.join(kept, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return narrowed(one.select(*_columns(one, docs)), table_bytes(docs)).unionByName(docs.where(~worded))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item (nor all words of a shorter one)."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10).where("n_hit > 0")
    hit = materialize(found.select(_key(text_hash=F.col("text_hash"))).distinct(), "contaminated", table_bytes(docs))
    rows = docs.select(_row(docs), _key()).join(hit, "key", "left_anti")
    return rows.select(*_columns(rows, docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` follows the text."""
    clean = narrowed(redact(docs, fresh_dir(spark, "pipeline-ledger")), table_bytes(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes at least once, with ``copies``."""
    mixed = mix_sources(docs).select(_key(text_hash=F.col("text_hash")), F.col("copies").alias("n"))
    counted = materialize(mixed.groupBy("key").agg(F.array_sort(F.collect_list("n")).alias("each")), "mixed-copies", table_bytes(docs))
    joined = docs.select(_row(docs), _key()).join(counted, "key")
    # Rows alike in id and text take the copies of their kind in turn.
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    taken = joined.withColumn("copies", F.get("each", turn - 1)).where("copies > 0")
    taken = taken.select(*(c for c, name in zip(_columns(taken, docs), docs.columns) if name != "copies"), "copies")
    return narrowed(taken, table_bytes(docs))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Secret scanning over an incremental ledger of blobs.

A *blob* is a distinct text, addressed by its SHA-256. The ledger is a Parquet
table of (blob, findings), partitioned by the version of the rules that were
run: a digest of everything that decides what they find (:func:`rules_version`), so
other rules are another version by themselves. A scan

1. content-addresses every row of ``docs`` (each historical version of each
   path is a row) and keeps the blobs the ledger lacks for this rule version,
2. runs the rules over one copy of each of those, and appends them,
3. joins the findings back to every row that holds the blob.

A second scan of the same rows with the same rules runs none of them; a changed, added
or removed rule scans every blob once more and leaves the older findings in place.

A private key is found from its BEGIN line to the END line. Where another BEGIN
line or the end of the text comes first, it ends with its key lines: header
fields, base64 of 20 characters or more, and one last, shorter piece. Line ends may
be written as \\n, and lines be quoted or indented.

Defined results: a null text counts as empty; rows with any ``doc_id`` (null or
repeated) get the findings of their own text; an empty table gives no rows.
Appending is not transactional across concurrent scans: two scans that run at
once may both add a blob, which the read side removes again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import broadcast_limit, byte_slices, materialize, narrowed, table_bytes

FINDINGS = "array<struct<kind: string, start: int, end: int>>"
SLICE_BYTES = 4 << 20  # texts that a task holds as Python strings at a time


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters or more.

    ``hints``: unless one of them stands in the lower-cased text, nothing can match.
    """

    kind: str
    pattern: re.Pattern
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()

    def spans(self, text: str, lower: str) -> Iterator[tuple[int, int]]:
        if self.hints and not any(h in lower for h in self.hints):
            return
        for m in self.pattern.finditer(text):
            if len(m[self.group]) >= self.least:
                yield m.span()


_BASE64 = r"(?:[A-Za-z0-9+/]|\\/)"
_BETWEEN = r"(?:[\s>#*|\"',]|\\+[nrt])*+"  # key lines
_LINE_END = r"(?:\r?\n|(?:\\+r)?\\+n)"
_PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
    r"(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----|"
    rf"(?:{_BETWEEN}(?:Proc-Type|DEK-Info):\x20?[A-Za-z0-9,-]*+)*+"
    rf"(?:{_BETWEEN}{_BASE64}{{20,}}+=*+)*+"
    rf"(?:{_BETWEEN}{_BASE64}++=*+(?=\s*\Z)"  # the text ends within the key
    rf"|{_BETWEEN}(?:{_BASE64}{{4}})*+{_BASE64}{{2,3}}=+"
    rf"|{_LINE_END}[\x20\t>]*+(?:{_BASE64}{{4}})++(?={_LINE_END}))?)"
)

# The formats to find, in the order in which kinds that start together are listed.
RULES = (
    Rule(
        "assign",
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        group=2,
        least=6,
        hints=("passw", "secret", "token", "key"),
    ),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), least=20, hints=("akia",)),
    Rule("hex", re.compile(r"[0-9a-f]{24,}")),
    Rule("private_key", re.compile(_PRIVATE_KEY), hints=("-----begin",)),
    Rule("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), hints=("eyj",)),
    Rule("forge_token", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), hints=("gh",)),
)
BASE_KINDS = ("assign", "access", "hex")


def rules_version(rules: tuple[Rule, ...] = RULES) -> str:
    """A digest of kind, pattern, flags, group, least length and hints of every rule, in their order."""
    said = [[r.kind, r.pattern.pattern, int(r.pattern.flags), r.group, r.least, list(r.hints)] for r in rules]
    return hashlib.sha256(json.dumps(said).encode()).hexdigest()[:16]


def scan_text(text: str, rules: tuple[Rule, ...] = RULES) -> list[dict]:
    """All findings of a text by start, then rule order; offsets in code points, end exclusive."""
    lower = text.lower()
    found = [(a, k, b) for k, rule in enumerate(rules) for a, b in rule.spans(text, lower)]
    return [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(found)]


def _read_ledger(docs: DataFrame, ledger: str, version: str) -> DataFrame:
    reader = docs.sparkSession.read.schema(f"blob binary, findings {FINDINGS}")
    try:
        return reader.parquet(f"{ledger}/version={version}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return docs.sparkSession.createDataFrame([], f"blob binary, findings {FINDINGS}")


def _blob():
    return F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("blob")


def scan_unseen(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the blobs of ``docs`` that the ledger lacks, append them; returns the blobs scanned now."""
    spark, version = docs.sparkSession, rules_version(rules)
    seen = _read_ledger(docs, ledger, version).select("blob")
    unseen = materialize(docs.select(_blob()).distinct().join(seen, "blob", "left_anti"), "unseen-blobs", table_bytes(docs))
    texts = docs.select(_blob(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if table_bytes(unseen) <= broadcast_limit(spark):  # a small increment: rows of seen blobs go before the shuffle
        texts = texts.join(F.broadcast(unseen), "blob", "left_semi")
    # Copies merge map-side, so a blob that a third of all rows hold is sent once a task.
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob", "left_semi")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", SLICE_BYTES):
            found = [scan_text(t, rules) for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(found, kind)], ["blob", "findings"])

    found = narrowed(blobs.mapInArrow(scan, f"blob binary, findings {FINDINGS}"), table_bytes(docs))
    found.write.mode("append").parquet(f"{ledger}/version={version}")
    return unseen


def _join_findings(rows: DataFrame, ledger: str, version: str) -> DataFrame:
    """``rows`` with ``findings`` in place of ``blob``; only blobs with findings are joined, each once."""
    known = _read_ledger(rows, ledger, version).where(F.size("findings") > 0)
    known = known.groupBy("blob").agg(F.first("findings").alias("findings"))
    found = F.coalesce("findings", F.expr(f"cast(array() as {FINDINGS})")).alias("findings")
    return rows.join(known, "blob", "left").select(*(c for c in rows.columns if c != "blob"), found)


def find_secrets(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, findings) for every row of ``docs``; unseen blobs are scanned and added to the ledger first."""
    scan_unseen(docs, ledger, rules)
    return _join_findings(docs.select("doc_id", _blob()), ledger, rules_version(rules))


@F.pandas_udf(StringType())
def _masked(text: pd.Series, findings: pd.Series) -> pd.Series:
    out = []
    for t, spans in zip(text, findings):
        if t is None or not len(spans):
            out.append(t)
            continue
        parts, at = [], 0
        for s in spans:  # by start; overlapping spans become one
            if s["start"] >= at:
                parts.append(t[at : s["start"]])
                parts.append("[REDACTED]")
            at = max(at, s["end"])
        out.append("".join(parts) + t[at:])
    return pd.Series(out, dtype=object)


def redact(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``[REDACTED]``; other columns as they are."""
    scan_unseen(docs, ledger, rules)
    # The row travels as a struct, so no column of it can clash with ours.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = _join_findings(docs.select(_blob(), row), ledger, rules_version(rules))
    text = F.col("row.text")
    # Only texts with findings go to Python: the function is evaluated for every row, whatever stands around it.
    holds = F.size("findings") > 0
    masked = F.when(holds, _masked(F.when(holds, text), F.col("findings"))).otherwise(text)
    return found.select(*(masked.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))

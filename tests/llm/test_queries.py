"""The driver's queries: against their SQL, or against brute force or held-out labels where SQL cannot express them."""

import hashlib
import re
import zlib

import duckdb
import pytest

from conftest import SF
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.source_mixing import token_targets

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def test_one_query_an_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(columns, cursor.fetchall())


def result(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()


def test_secrets_against_brute_force(spark, documents):
    assign = re.compile(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    got = result(spark, "op3_secret_ledger")
    for doc_id, text, *_ in documents:
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        r, kinds = got[doc_id], [k for _, k, _ in found]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in range(3))
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(",")) | {""}
    assert len(got) == len(documents)


def test_mixing_meets_its_targets(spark, documents):
    sizes, taken = {}, {}
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _, _ in documents}
    for d, _, _, s in documents:
        sizes[s] = sizes.get(s, 0) + size[d]
    target, got = token_targets(sizes, (3, 1, 2), 1.5), result(spark, "op4_source_mixing")
    for d, _, _, s in documents:
        r = got[d]
        assert r["size"] == size[d] and r.source_size == sizes[s] and r.target == pytest.approx(target[s], rel=1e-12)
        assert 0 <= r.taken <= 2 * size[d]
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= max(60, 0.01 * target[s]) for s in sizes)


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_of_held_out_documents(spark, documents):
    got = result(spark, "op5_language_id")
    assert all(got[d].held_out == (remainder(d, 5) == 0) for d, *_ in documents)
    held = [got[d].lang_pred == lang for d, _, lang, _ in documents if got[d].held_out]
    assert sum(held) / len(held) > 0.95


def test_toxicity_of_held_out_documents(spark, duck, documents):
    got = result(spark, "op2_toxicity")
    assert all(got[d].held_out == (remainder(d, 3) == 1) for d, *_ in documents)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    labels = duck.execute("SELECT doc_id, toxic FROM labels").fetchall()
    right = [got[d].predicted == toxic for d, toxic in labels]
    assert sum(right) / len(right) > 0.9


def test_near_duplicates_against_brute_force(spark, documents):
    sets = {}
    for d, text, *_ in documents:
        w = text.lower().encode().split()
        n = min(5, len(w))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and root(a) != root(b):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    got = result(spark, "op6_dart_minhash")
    assert {d: r.class_id for d, r in got.items()} == {d: root(d) for d in ids}


def test_pieces_as_the_library(spark, documents):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = result(spark, "op12_piece_codec")
    for d, text, *_ in documents:
        ids = library.encode(text or "", add_eos=True)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids), *digests)
    assert len(got) == len(documents)

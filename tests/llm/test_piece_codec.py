import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import piece_codec
from tidemark.llm.piece_codec import PieceModel, decode_documents, encode_documents, read_model

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def data():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def model(data):
    return PieceModel(data)


ALPHABETS = [
    "a b", "abc \t\n", "  ▁x", " é漢字\x00​😀", "\U0010ffff�<0x41></s>[INST]<unk>", "aab", "thein ", "0123 ", "mis", "-=_ *#",
    "".join(map(chr, range(0x21, 0x250))), "".join(map(chr, range(0x250, 0x3100, 7))),
]


@pytest.mark.parametrize("rounds", [0, 1, 3, 64])
def test_random_texts_as_the_library(model, library, monkeypatch, rounds):
    monkeypatch.setattr(piece_codec, "ROUNDS", rounds)
    r = random.Random(rounds)
    for _ in range(1500):
        alphabet = r.choice(ALPHABETS)
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(80))) + " " * r.choice([0, 0, r.randrange(40)]) + r.choice(["", "the"])
        ids = library.encode(text)
        assert model.encode(text) == ids, text
        assert model.decode(ids) == library.decode(ids), text


def test_many_words_at_once(model, library):
    """All pieces of the vocabulary, joined in pairs, are one flat array."""
    r = random.Random(5)
    words = ["▁" + library.id_to_piece(r.randrange(259, 32000)) + library.id_to_piece(r.randrange(259, 32000)) for _ in range(4000)]
    words = [w for text in words for w in model.words(text.replace("▁", " ").strip())]
    ids, sizes = model.ids(words)
    at = 0
    for word, n in zip(words, sizes.tolist()):
        assert ids[at : at + n].tolist() == library.encode(word[1:].replace("▁", " ")) if model.prefix else True
        at += n


@pytest.mark.parametrize("text", [" " * 3000, "ab" * 5000, "x" * 20000, "the" * 7000, "漢" * 3000, " a" * 10000, "-" * 5001 + "=" * 4000])
def test_long_words(model, library, text):
    assert model.encode(text) == library.encode(text)


def test_any_ids_decode_as_the_library(model, library):
    r = random.Random(1)
    kinds = [lambda: r.randrange(32000), lambda: r.randrange(3, 259), lambda: r.randrange(3), lambda: r.randrange(259, 300)]
    for _ in range(3000):
        ids = [r.choice(kinds)() for _ in range(r.randrange(12))]
        assert model.decode(ids) == library.decode(ids), ids
    lists = [[r.choice(kinds)() for _ in range(r.choice([0, 1, 5]))] for _ in range(3000)]
    flat, bounds = np.array([i for x in lists for i in x]), np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    assert model.decode_lists(flat, bounds).to_pylist() == [library.decode(x) for x in lists]
    plain = [[i for i in x if i > 258] + [2] for x in lists]
    flat, bounds = np.array([i for x in plain for i in x]), np.concatenate(([0], np.cumsum([len(x) for x in plain])))
    assert model.decode_lists(flat, bounds).to_pylist() == [library.decode(x) for x in plain]
    assert model.decode_lists(flat[:0], np.zeros(3, dtype=np.int64)).to_pylist() == ["", ""]
    with pytest.raises(IndexError):
        model.decode_lists(np.array([32000]), np.array([0, 1]))
    with pytest.raises(IndexError):
        model.decode([32000])
    with pytest.raises(IndexError):
        model.decode([-1])


def test_documents(spark, data, library):
    texts = [None, "", " ", "Hello  world", "a\x00b", "▁x", "naïve 漢字 😀", "w" * 50_000, "one two " * 20_000, "Hello  world"]
    rows = [(i if i != 4 else None, t, "c", "c", "c") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string, n string")
    out = decode_documents(encode_documents(docs, data), data).collect()
    want = [(d, library.encode(t or "") + [2]) for d, t, *_ in rows]
    assert sorted(((r.doc_id, r.ids) for r in out), key=repr) == sorted(want, key=repr)
    assert {tuple(r.ids): r.decoded for r in out} == {tuple(ids): library.decode(ids) for _, ids in want}
    assert encode_documents(docs.limit(0), data).collect() == []
    assert all(r.ids[-1:] != [2] for r in encode_documents(docs, data, end=False).collect())


def test_a_full_table_of_words_changes_no_result(spark, data, library, monkeypatch):
    r = random.Random(2)
    rows = [(i, " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 9))) for _ in range(60))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    # Settings reach the Python workers with the function, which refers to the module by name: run it in this process.
    monkeypatch.setattr(piece_codec, "WORDS", 50)
    monkeypatch.setattr(piece_codec, "SLICE", 500)
    import pyarrow as pa

    captured = []

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, f, _):
            captured.append(f)

    encode_documents(Frame(), data)
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])
    got = {x["doc_id"]: x["ids"] for b in captured[0](iter([batch])) for x in b.to_pylist()}
    assert got == {i: library.encode(t) + [2] for i, t in rows}
    assert docs.count() == len(got)


def test_model_from_any_storage(spark, data):
    assert read_model(spark, f"file://{PATH}") == read_model(spark, PATH) == data


def test_other_models_are_refused(data):
    # The trainer's model type (field 3) is 2 for BPE; this message says 1.
    with pytest.raises(ValueError, match="no BPE model"):
        PieceModel(b"\x12\x02\x18\x01")


def test_pairs_are_looked_up_by_their_hash(model):
    """A lookup finds every merge with its rank, also where two share a slot, and nothing else."""
    left, right = model.pair // model.width, model.pair % model.width
    rank, into = model._ranked(left, right)
    assert (rank == model.rank).all() and (into == model.into).all()
    assert model.crowded.any()  # some do share one
    key = np.setdiff1d(model.pair + 1, model.pair)
    assert (model._ranked(key // model.width, key % model.width)[0] == piece_codec._NONE).all()

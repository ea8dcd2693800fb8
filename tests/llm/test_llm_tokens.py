"""Encoding, decoding and packing against the libraries themselves."""

import hashlib
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lendstar.llm import bpe, packing
from lendstar.llm.units import split_units

TEXTS = ["", None, "a", " ", "  a  b\n\n c", "don't y'all'd've 12 3x4", "x" * 5000, "ab1" * 4000 + "'s",
         " " * 3000 + "z", "<|endoftext|> hi", "a <|endoftext|><|endoftext|>b <|endoftext| >", "don<|endoftext|>'t  <|endoftext|>\n", "é́ a\x1cb　", "\U0001f600 ok " * 700, "the end\n"]


@pytest.fixture(scope="module")
def enc():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANK_FILE)))


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("a'st 1\n\t!é \x1c　x"), max_size=40))
def test_units_encode_as_the_whole_text(text):
    e = bpe._encoding(public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN)
    units = split_units(text)
    assert "".join(units) == text
    assert [i for u in units for i in e.encode_ordinary(u)] == e.encode_ordinary(text)


def test_encode_decode(spark, enc):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)] + [(None, "b", 0)],
                               "doc_id long, text string, ids int")
    out = bpe.decode(bpe.encode(df, "text", "ids"), "ids", "decoded").collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        assert list(r["ids"]) == enc.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(df.limit(0)).collect() == []


def test_op4_against_library(spark, enc, sf_dir):
    rows = {r["doc_id"]: r for r in bpe.op4_bpe_roundtrip(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = enc.encode_ordinary(d["text"] or "")
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def ids_of(encoder, texts, kind=pa.string()):
    return [list(memoryview(b).cast("I")) if b else [] for b in encoder.encode_all(pa.array(texts, kind))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.sampled_from("a'st 1,_\n\t!\u00e9\u00d7\u00b2 \x1c\x85\xa0\u1680\u2003\u3000\u0438\u0301\u4e2d\u0bee\U0001f600\x00\x7f"), max_size=30)
                | st.sampled_from(TEXTS), max_size=6))
def test_texts_encoded_by_their_different_units(texts):
    path = public_tokenizers.path(packing.VOCABULARY)
    whole = Tokenizer.from_file(path)
    expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids_of(packing._encoder(path, 1000), texts) == expected


def test_units_across_slices(tok, monkeypatch):
    monkeypatch.setattr(packing, "_TEXT_BYTES", 1500)
    monkeypatch.setattr(packing, "_TEXTS_AT_ONCE", 3)
    monkeypatch.setattr(packing, "_WORDS_AT_ONCE", 4)
    texts = [t for i in range(5) for t in [*TEXTS, f"slice {i} \u00e9t\u00e9, \u00a0 ({i})"]]
    expected = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = packing._Encoder(public_tokenizers.path(packing.VOCABULARY))
    for kind in (pa.string(), pa.large_string()):
        assert ids_of(encoder, texts, kind) == expected
        array = pa.array(texts, kind).slice(3, 40)
        assert [len(x) // 4 for x in encoder.encode_all(array)] == [len(x) for x in expected[3:43]]
    assert ids_of(encoder, []) == [] and ids_of(encoder, [None, ""]) == [[], []]


def test_new_words_reach_the_library_many_at_a_time(tok):
    """F1 of round 3: a call of the library for each new word cost most of the CPU time."""
    encoder = packing._Encoder(public_tokenizers.path(packing.VOCABULARY))
    calls, model = [], encoder.words.model

    class Counting:
        def tokenize(self, s):
            calls.append(len(s))
            return model.tokenize(s)

    encoder.words.model = Counting()
    encoder.memo.encode_ids = lambda s: calls.append(len(s)) or tok.encode(s, add_special_tokens=False).ids
    letters = "abcdefghij"
    words = ["".join(letters[int(d)] for d in str(n)) for n in range(1000, 6000)]
    texts = [" ".join(["so", *words[i:i + 50], "it's, 12;"]) for i in range(0, 5000, 50)]
    assert ids_of(encoder, texts) == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) < 30


def test_model_with_other_rules_is_not_joined(tmp_path):
    """A vocabulary whose whole words come before the merges: each unit by the library alone."""
    import json

    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["ignore_merges"] = True
    (path := tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    encoder, other = packing._Encoder(str(path)), Tokenizer.from_file(str(path))
    assert not encoder.words.usable
    assert ids_of(encoder, TEXTS) == [other.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def check_pack(pieces, texts, tok, window):
    """Pieces tile every document, sequences are gapless, ids are the tokenizer's."""
    docs, seqs = {}, {}
    for p in pieces:
        docs.setdefault(p["doc_id"], []).append(p)
        seqs.setdefault(p["sequence_id"], []).append(p)
    assert docs.keys() == texts.keys()
    for d, ps in docs.items():
        ids = tok.encode(texts[d] or "", add_special_tokens=False).ids + [packing.EOS_ID]
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            part = b"".join(i.to_bytes(4, "little") for i in ids[at:at + p["length"]])
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(part) and ("ids" not in p or bytes(p["ids"]) == part)
            at += p["length"]
        assert at == len(ids)
    for ps in seqs.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return len(seqs), sum(p["length"] for p in pieces)


def test_op3_on_documents(spark, tok, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    n, total = check_pack([r.asDict() for r in packing.op3_pack(spark, sf_dir).collect()], texts, tok, 2048)
    assert total / (n * 2048) > 0.97


@pytest.mark.parametrize("parts,fan_in", [(1, 2), (7, 2), (40, 3)])
def test_pack_small(spark, tok, parts, fan_in):
    texts = {i: t for i, t in enumerate(TEXTS + [f"word {i} " * (i % 37) for i in range(120)])}
    df = spark.createDataFrame([(t, 5, i) for i, t in texts.items()], "text string, start int, doc_id long")
    out = packing.pack(df.repartition(parts), window=64, open_windows=3, min_cut=4, fan_in=fan_in).collect()
    check_pack([r.asDict() for r in out], texts, tok, 64)


def test_pack_edge_cases(spark):
    df = spark.createDataFrame([(7, "a b"), (7, "a b"), (None, None)], "doc_id long, text string")
    out = packing.pack(df).collect()
    assert len(out) == 3 and {r["doc_id"] for r in out} == {7, None}
    assert packing.pack(df.limit(0)).collect() == []

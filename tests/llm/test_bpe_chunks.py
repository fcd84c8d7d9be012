import hashlib
import random

import numpy as np
import pytest
from llm.conftest import SF
from tokenizers import Tokenizer

from shelfwise.llm import bpe_chunks as K
from shelfwise.llm.packing import _encoder
from shelfwise.llm.queries import TOKENIZER, op11_bpe_chunks

PARTS = {"words": " ab", "mixed": "a b\n<|endoftext|>'s 1é　\x1c.", "space": " \n\ta", "wide": "漢字 😀é "}


def odd_texts():
    rng = random.Random(11)
    out = ["", None, "a", " a", "a  <|endoftext|> b <|endoftext|>", "x <|endo", " " * 5000 + "x", "\n b" * 900, "a" * 30_000,
           "ünï ß 漢字 😀 " * 700, "\x1c b\x85c d" * 300, "same words again " * 3000]
    for n in (100, 400, 3000, 9000):
        out += ["".join(rng.choice(a) for _ in range(n)) for a in PARTS.values()]
    bits = ["a", " b", "<|endoftext|>", " <|endoftext|>", "  ", "\n", "'s", "12"]
    return out + ["".join(rng.choice(bits) for _ in range(3000)) for _ in range(3)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER[0])


def memory(shared=None):
    return K._Memory(_encoder(*TOKENIZER), K._sync(TOKENIZER[0]), shared or {})


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_chunks_cover_the_text_and_follow_the_content():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ijkl.") for _ in range(60_000))
    for text in ("", "x", passage, "ab" * 50_000, "😀é " * 9000):
        cs = K.chunks(text)
        assert "".join(cs) == text and all(cs) and all(len(c) <= K.MOST for c in cs)
    # behind different beginnings the same passage falls into the same chunks but for the first few
    a, b = set(K.chunks("one beginning " + passage)), set(K.chunks(passage[7000:] + " another end" * 50))
    assert len(a & b) > 0.9 * len(b)
    # blocks of the rolling hash leave no seam
    long = passage * 20
    small, K._BLOCK = K._BLOCK, 1 << 12
    try:
        assert K.cuts(long) == (setattr(K, "_BLOCK", small), K.cuts(long))[1]
    finally:
        K._BLOCK = small


def test_joined_chunks_equal_the_whole_text(library, monkeypatch):
    texts = [t or "" for t in odd_texts()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for least, mean in ((128, 512), (1, 3)):  # cuts within every word as well
        monkeypatch.setattr(K, "cuts", lambda t, f=K.cuts, a=mean, b=least: f(t, a, b))
        assert [np.frombuffer(b, "<u4").tolist() for b in K.encode_texts(texts, memory())] == want
        monkeypatch.undo()


def test_memory_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(K, "OWN_CHARS", 2000)
    m = memory()
    rng = random.Random(4)
    for _ in range(20):
        t = " ".join(rng.choice(["alpha", "beta", "gamma'll", "12"]) for _ in range(900))
        assert np.frombuffer(K.encode_texts([t, t], m)[1], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
        assert m.size == sum(map(len, m.own)) <= 2000


def test_every_row_equals_the_library(spark, docs_of, library):
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    rows += [(None, "null id"), (None, None), (3, "repeated id"), (3, "repeated id")]
    got = K.digests(K.round_trip(docs_of([(i, t, "en") for i, t in rows]), *TOKENIZER)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(library, t)) for i, t in rows), key=key)


def test_shared_chunks_are_encoded_once(spark, docs_of, library):
    rng = random.Random(5)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(8000))
    rows = [(i, f"start {i} {passage} end {i}") for i in range(20)] + [(99, "alone")]
    docs = docs_of([(i, t, "en") for i, t in rows])
    shared = K.shared_dictionary(docs, *TOKENIZER)
    assert sum(map(len, shared)) > 0.8 * len(passage)
    assert sum(map(len, K.shared_dictionary(docs, *TOKENIZER, most=3000))) <= 3000
    for chunk, (head, ids, tail) in shared.items():
        middle = chunk[len(head):len(chunk) - len(tail)]
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(middle, add_special_tokens=False).ids
    calls = []
    m = K._Memory(lambda ts: (calls.append(ts), _encoder(*TOKENIZER)(ts))[1], K._sync(TOKENIZER[0]), shared)
    K.encode_texts([t for _, t in rows], m)
    assert sum(map(len, calls[0])) < 0.1 * sum(len(t) for _, t in rows)  # what surrounds the passage, not twenty passages


def test_whole_small_table(spark, library):
    want = {r["doc_id"]: expected(library, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_bpe_chunks(spark, SF)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r[1:4]) for r in got.collect()} == want


def test_decode_alone(spark, docs_of):
    docs = docs_of([(i, t, "en") for i, t in enumerate(odd_texts())])
    coded = K.encode(docs, *TOKENIZER, reuse=False)
    key = lambda r: r["doc_id"]
    want = sorted(K.round_trip(docs, *TOKENIZER).collect(), key=key)
    assert sorted(K.decode(coded, TOKENIZER[0]).collect(), key=key) == want
    broken = spark.createDataFrame([(1, None), (2, np.array([188, 64], dtype="<u4").tobytes())], "doc_id long, ids binary")
    assert [r["decoded"] for r in K.decode(broken, TOKENIZER[0]).orderBy("doc_id").collect()] == [
        None, Tokenizer.from_file(TOKENIZER[0]).decode([188, 64])]


def test_empty_table(spark, docs_of):
    assert K.round_trip(docs_of([(1, "x", "en")]).where("doc_id < 0"), *TOKENIZER).collect() == []

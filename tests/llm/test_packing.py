import random
import zlib

import numpy as np
import public_tokenizers as P
from llm.conftest import SF
from tokenizers import Tokenizer

from shelfwise.llm import packing as K
from shelfwise.llm.queries import TOKENIZER


def reference_ids(texts):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


TEXTS = ["", None, "a", " a", "a ", "a  b", "a\n b", "\n\na b\n", "x <|endoftext|> y", "can't 't  \n 'll b", "a 　b c", "a \x1cb", "1 22 a1 .. é É",
         "ünï ß 漢字 😀 mixed\ttabs \t here", " ".join("word%d" % i for i in range(5000)), "same same " * 20_000]


def check(rows, docs):
    """Each document's pieces hold its tokens once; each sequence is gapless."""
    want = sorted((i if i is not None else -1, ids) for (i, _), ids in zip(docs, reference_ids([t for _, t in docs])))
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"] if r["doc_id"] is not None else -1, []).append(r)
    ids_of = {}
    for i, ids in want:
        ids_of.setdefault(i, []).append(np.array(ids, dtype="<u4"))
    assert by.keys() == ids_of.keys()
    for i, versions in ids_of.items():
        left = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by[i])
        expect = sorted((s, n, c, len(v)) for v in versions for s, n, c in K.pieces_of(v.tobytes()))
        assert left == expect
        for v in versions:
            at = 0
            for s, n, c in K.pieces_of(v.tobytes()):
                assert s == at and c == zlib.crc32(v[s:s + n].tobytes())
                at += n
            assert at == len(v)
    seq = {}
    for r in rows:
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= K.WINDOW
    return [sum(n for _, n in p) for p in seq.values()]


def test_word_by_word_encoding_equals_the_reference(monkeypatch):
    encode = K._encoder(*TOKENIZER)
    texts = [t or "" for t in TEXTS]
    expect = [ids[:-1] for ids in reference_ids(texts)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == expect
    monkeypatch.setattr(K, "_CACHE_WORDS", 10)  # the memory of words is dropped between texts
    assert [np.frombuffer(encode([t])[0], "<u4").tolist() for t in texts] == expect


def test_documents_round_trip(spark, docs_of):
    rng = random.Random(1)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "tok " * rng.randint(1, 3000)) for i in range(150)]
    docs += [(None, "null id"), (None, "another null id"), (3, "a repeated id"), (100, docs[20][1]), (101, docs[17][1])]
    got = K.pack_documents(docs_of([(i, t, "en") for i, t in docs]), *TOKENIZER).collect()
    loads = check(got, docs)
    padded = sum(2048 if n & (n - 1) else n for n in loads)
    assert sum(loads) / padded > 0.98


def test_whole_small_table(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    check(K.pack_documents(d, *TOKENIZER).collect(), [(r["doc_id"], r["text"]) for r in d.collect()])


def test_empty_table(spark, docs_of):
    assert K.pack_documents(docs_of([(1, "x", "en")]).where("doc_id < 0"), *TOKENIZER).collect() == []


def test_differencing_is_near_equal():
    rng = random.Random(8)
    for n, k in ((1, 1), (5, 3), (400, 40), (700, 9)):
        lengths = [rng.randint(1, 512) for _ in range(n)]
        place = K.differencing(lengths, k)
        loads = np.bincount(place, weights=lengths, minlength=k)
        assert len(place) == n and loads.sum() == sum(lengths)
        if n >= 400:
            assert loads.max() - loads.min() <= 0.05 * loads.mean()
    # two-way differencing of a textbook case
    assert sorted(np.bincount(K.differencing([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])) == [14, 16]


def test_capacity_raises_the_window_count():
    place, windows = K.pack_group([1500] * 5)
    assert windows == 5 and sorted(place) == list(range(5))
    place, windows = K.pack_group([1025, 1025, 1023, 1023])
    assert max(np.bincount(place, weights=[1025, 1025, 1023, 1023])) <= 2048
    assert K.pack_group([]) == ([], 1)

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow as pa
import sentencepiece
from llm.conftest import SF
from tokenizers import Tokenizer

from shelfwise.llm import token_alignment as K
from shelfwise.llm.queries import PIECES, TOKENIZER, op13_token_alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens_of(texts):
    """(id, bytes) lists of both sides, by the libraries, text by text."""
    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    spelled = {}
    for name, i in first.get_vocab().items():
        spelled[i] = name
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out = []
    for t in texts:
        a = [(i, bytes(byte_of[c] for c in spelled[i])) for i in first.encode(" " + t, add_special_tokens=False).ids] if t else []
        b = []
        for i in second.encode(t) if t else []:
            p = second.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + t).encode() if t else b""
        good = all(b"".join(x for _, x in side) == whole for side in (a, b))
        out.append((a, b) if good else ([], []))
    return out


def brute(texts):
    """The contract's columns by plain loops, one tuple a text."""
    sides = tokens_of(texts)
    linked, docs = [], Counter()
    for a, b in sides:
        found, spans = Counter(), []
        at = 0
        for j, x in b:
            spans.append((at, at + len(x), j))
            at += len(x)
        at = 0
        for i, x in a:
            found.update((i, j) for s, e, j in spans if s < at + len(x) and e > at)
            at += len(x)
        linked.append(found)
        docs.update(found.keys())
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    out = []
    for (a, b), found in zip(sides, linked):
        ends = [set(), set()]
        for side, seen in ((a, ends[0]), (b, ends[1])):
            at = 0
            for _, x in side:
                at += len(x)
                seen.add(at)
        cut = sorted(ends[0] & ends[1])
        groups = []
        for low, high in zip([0, *cut], cut):
            parts = []
            for side in (a, b):
                at, ids = 0, []
                for i, x in side:
                    at += len(x)
                    if low < at <= high:
                        ids.append(str(i))
                parts.append(",".join(ids))
            groups.append("|".join(parts))
        text = ";".join(groups)
        out.append((len(a), len(b), len(cut), sum(found.values()), sum(n for p, n in found.items() if docs[p] == most[p[0]]),
                    sum(n * docs[p] for p, n in found.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def odd_texts():
    rng = random.Random(13)
    out = ["", None, "a", " a", "a ", "a  b", "x\n y", "tab\there", "<s> </s> <unk> <0x0A>", "x <|endoftext|> y", "ﬁ é é　 x", "▁a ▁", "́ ́a",
           "漢字 😀 mixed", "a" * 3000, "same same " * 400, "1 22 a1 .. can't 'll"]
    out += ["".join(rng.choice(" ab\n") for _ in range(200)) for _ in range(8)]
    bits = ["x", "é\n", "́", "ﬁ", "'s", "<0x41>", "</s>", "word", "words.\nWord"]
    return out + [" ".join(rng.choice(bits) for _ in range(60)) for _ in range(12)]


def test_odd_texts_equal_plain_loops(spark, docs_of):
    texts = odd_texts()
    rows = list(enumerate(texts)) + [(None, "a null id"), (3, "repeated id"), (3, "repeated id")]
    want = brute([t for _, t in rows])
    assert {w[0] == 0 for w in want} == {True, False}
    got = K.digests(docs_of([(i, t, "en") for i, t in rows]), TOKENIZER, PIECES)
    assert got.columns == COLUMNS
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)


def test_whole_small_table_equals_plain_loops(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = sorted(docs, key=lambda d: len(d[1] or ""))[:150]  # the loops are quadratic in a text's length
    df = spark.createDataFrame(short, "doc_id long, text string").repartition(3)
    want = {i: w for (i, _), w in zip(short, brute([t for _, t in short]))}
    assert {r[0]: tuple(r)[1:] for r in K.digests(df, TOKENIZER, PIECES).collect()} == want


def test_shuffled_pairs_equal_broadcast_ones(spark, monkeypatch):
    want = sorted(map(tuple, op13_token_alignment(spark, SF).collect()))
    monkeypatch.setattr(K, "small_or_plain", lambda df: df.hint("merge"))
    assert sorted(map(tuple, op13_token_alignment(spark, SF).collect())) == want


def test_portions_change_nothing(spark, docs_of, monkeypatch):
    code, bytes_a, bytes_b = K._coders(*TOKENIZER, PIECES)
    tables = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
    texts = [t or "" for t in odd_texts()]
    whole = pa.array([b" " + t.encode() if t else b"" for t in texts], pa.binary())
    a, b = code(texts)
    together = K.align_lists(a, b, whole, *tables)
    for i, t in enumerate(texts):
        one = K.align_lists(*code([t]), whole.slice(i, 1), *tables)
        part = K.align_lists(K._slice(a, i, 1), K._slice(b, i, 1), whole.slice(i, 1), *tables)
        for name, column in together.items():
            assert one[name].to_pylist() == part[name].to_pylist() == column.slice(i, 1).to_pylist(), (t[:40], name)


def test_groups_spell_the_text(spark):
    rows = K.align(spark.read.parquet(f"{SF}/documents.parquet"), TOKENIZER, PIECES).select("n_a", "n_b", "n_groups", "groups").limit(20).collect()
    for r in rows:
        groups = [g.split("|") for g in r["groups"].split(";")] if r["groups"] else []
        assert len(groups) == r["n_groups"] and all(len(g) == 2 and all(g) for g in groups)
        assert [sum(len(g[s].split(",")) for g in groups) for s in (0, 1)] == [r["n_a"], r["n_b"]]


def test_empty_table(spark, docs_of):
    assert K.digests(docs_of([(1, "x", "en")]).where("doc_id < 0"), TOKENIZER, PIECES).collect() == []
    assert K.digests(docs_of([(1, None, "en"), (2, "", "en")]), TOKENIZER, PIECES).orderBy("doc_id").collect() == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

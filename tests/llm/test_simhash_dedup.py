import random
import re

import xxhash
from llm.conftest import rows_of
from llm.test_common import union_find
from pyspark.sql import functions as F

from shelfwise.llm import simhash_dedup as S


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    out = ["", None, "  \t\n", "One", "one two", "ONE two", "É x\u00a0y É z", "a b c", "a b c d " * 30_000]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(60, 400))]
        out.append(" ".join(base))
        for _ in range(rng.randint(1, 5)):
            near = list(base)
            for _ in range(rng.randint(0, 2)):
                near[rng.randrange(len(near))] = word()
            out.append("\n".join(near))
    return out


def plain(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    uf = union_find([(a, b) for i, a in enumerate(fps) for b in fps[i:] if (a ^ b).bit_count() <= 3])
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[uf[f]] = min(i, least.get(uf[f], i))
    return [(i, f"{f:016x}", least.get(uf[f])) for (i, _), f in zip(rows, fps)]


def test_fingerprint_equals_the_plain_one():
    for t in texts():
        assert S.fingerprint(t) % (1 << 64) == plain_fingerprint(t)


def test_embedding_bounds_the_bit_distance(spark):
    rng = random.Random(1)
    rows = [(a, a ^ sum(1 << k for k in rng.sample(range(62), 3))) for a in (rng.getrandbits(63) - (1 << 62) for _ in range(300))]
    df = spark.createDataFrame(rows, "a long, b long")
    r = df.select(F.bit_count(S.embedding(F.col("a")).bitwiseXOR(S.embedding(F.col("b")))).alias("m"),
                  F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("h")).collect()
    assert all(x["m"] <= x["h"] for x in r)


def test_components_match_brute_force(spark, docs_of):
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts())]
    rows += [(None, rows[20][1]), (None, "alone with no id at all"), rows[20], rows[20]]
    docs = docs_of([(i, t, "en") for i, t in rows])
    assert rows_of(S.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(plain(rows), key=repr)


def test_links_lose_no_pair_of_random_neighbours(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(300)]
    fps = set(base)
    for b in base:
        for _ in range(3):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 5))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r["fp"] % (1 << 64): r["root"] % (1 << 64) for r in S.components(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    fps = sorted(fps)
    uf = union_find([(a, b) for i, a in enumerate(fps) for b in fps[i:] if (a ^ b).bit_count() <= 3])
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups(got) == groups(uf)


def test_keep_one_keeps_the_smallest_id_once(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(texts(), 5)]
    rows += [rows[15], rows[15], (None, rows[15][1]), (None, "only a null id here"), (None, "only a null id here")]
    docs = docs_of([(i, t, None) for i, t in rows])
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    comp = plain(rows)
    expect = sorted([(i, t) for (i, t), (_, _, c) in zip(rows, comp) if i is not None and i == c and rows.index((i, t)) >= 0], key=repr)
    expect = sorted(set(expect) | {(None, "only a null id here")}, key=repr)
    assert rows_of(kept, "doc_id", "text") == expect


def test_empty_table(spark, docs_of):
    empty = docs_of([(1, "x", "en")]).where("doc_id < 0")
    assert S.near_duplicates(empty).collect() == []
    assert S.keep_one(empty).collect() == []

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from shelfwise.llm import decontaminate as D


def tok(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def plain(docs, items):
    """Best window similarity of every (doc, item), over all windows of the
    item's length (shorter at the end)."""
    out = {}
    for d, t in docs:
        w = tok(t)
        for i, x in items:
            iw = tok(x)
            if not iw:
                continue
            k = min(5, len(iw))
            ic = Counter(tuple(iw[j:j + k]) for j in range(len(iw) - k + 1))
            m = len(iw) - k + 1
            sh = [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
            for p in range(len(sh)):
                wc = Counter(sh[p:p + m])
                inter = sum(min(c, ic[s]) for s, c in wc.items())
                sim = inter / (sum(wc.values()) + m - inter)
                if sim >= 0.8:
                    out[d, i] = max(sim, out.get((d, i), 0))
    return out


def make():
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, say(rng.randint(14, 60))) for i in range(25)]
    items += [(100, "three word item"), (101, ""), (102, None), (103, "rep " * 30), (104, items[3][1]), (None, say(20))]
    docs = [(i, say(rng.randint(1, 300))) for i in range(40)]
    for n in range(80):
        i = rng.randrange(25)
        w = tok(items[i][1])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(w))
            w[at:at + rng.choice([0, 1])] = rng.choice([[], ["xyz"], [w[at].upper() + ","]])
        if rng.random() < 0.15:
            w = w[:int(len(w) * rng.uniform(0.5, 0.97))]
        docs.append((200 + n, f"{say(rng.randint(0, 80))} {' '.join(w).capitalize()}. {say(rng.randint(0, 80))}"))
    swapped = tok(max((x for _, x in items[:25]), key=len))
    docs += [(400, " ".join(swapped[30:] + swapped[:30])), (401, f"{say(5)} three word item {say(5)}"), (402, "rep " * 28), (403, "rep rep"),
             (404, items[2][1] + " " + items[2][1]), (405, say(6_000) + " " + items[5][1])]
    return docs, items


def test_matches_brute_force_over_all_windows(spark, docs_of):
    docs, items = make()
    frame = docs_of([(i, t, None) for i, t in [*docs, (500, None), (501, ""), docs[41], docs[41], (None, items[1][1])]])
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("wh", F.lit(1)).withColumn("sh", F.lit("c"))
    rows = D.matches(frame, bench).collect()
    expect = plain([*docs, (None, items[1][1])], items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    assert len(got) == len(rows)
    # the fingerprint radius may leave out similar windows of very few shingles only
    missing = {k: v for k, v in expect.items() if k not in got}
    assert not got.keys() - expect.keys()
    assert len(missing) <= 0.02 * len(expect) and all(v < 0.95 for v in missing.values())
    assert all(abs(got[k] - expect[k]) < 1e-9 or got[k] >= 0.8 for k in got)
    text = dict(docs)
    for r in rows:
        if r["doc_id"] in text and r["similarity"] == 1.0:
            w = tok(text[r["doc_id"]])[r["start_word"]:r["start_word"] + r["n_words"]]
            assert w == tok(dict(items)[r["item_id"]])


def test_several_passes_give_the_same(spark, docs_of, monkeypatch):
    docs, items = make()
    frame = docs_of([(i, t, None) for i, t in docs[:80]])
    bench = spark.createDataFrame(items[:25], "item_id long, text string")
    a = sorted(map(tuple, D.matches(frame, bench).collect()))
    monkeypatch.setattr(D, "PASS_SHINGLES", 300)
    assert sorted(map(tuple, D.matches(frame, bench).collect())) == a


def test_clean_drops_contaminated_rows_only(spark, docs_of):
    docs, items = make()
    frame = docs_of([(i, t, None) for i, t in [*docs, (None, items[1][1]), (None, "clean one"), (None, None)]])
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    bad = {r["doc_id"] for r in D.matches(frame, bench).collect()}
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None) == sorted((i, t) for i, t in docs if i not in bad)
    assert {r["text"] for r in kept.collect() if r["doc_id"] is None} == {"clean one", None}


def test_empty_tables(spark, docs_of):
    frame = docs_of([(1, "some words here", None)])
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    assert D.matches(frame, none).collect() == []
    assert D.matches(frame.where("doc_id < 0"), bench).collect() == []
    assert D.clean(frame, none).count() == 1
    assert [r["doc_id"] for r in D.matches(frame, bench).collect()] == [1]


def test_no_python_in_the_plan(spark, docs_of):
    bench = spark.createDataFrame([(1, "some words here and there are some more")], "item_id long, text string")
    plan = D.matches(docs_of([(1, "some words here and there are some more", None)]), bench)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from shelfwise.llm import chat_windows as C

TRICKY = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\|", "<\\|", "<", "|", "<|", "a\\n b\n", "", None, "é😀<|im_end|>\n", "\\\\<|\\n", "<<||>>"]


def conversation_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = rng.choice([0, 1, 2, 5, 40])
        if rng.random() < 0.5:
            rows.append((c, 0, "system", rng.choice(TRICKY)))
        for t in range(1, turns + 1):
            text = rng.choice([*TRICKY, "word " * rng.randint(1, 150)])
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "tool", "ro\nle<|", None]), text))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumn("window", F.lit("x")).withColumn("at", F.lit(1)).withColumn("tokens", F.lit("t"))


def expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(loss), sha(loss))
    return out


def check(spark, rows):
    w = C.format_windows(frame(spark, rows))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in C.read_back(w).collect()}
    assert got == expected(rows)
    return w


def test_round_trip_of_tricky_texts(spark):
    rows = conversation_rows(1, 40)
    rows += [(None, 1, "user", "null conversation"), (None, 2, "assistant", "yes"), (7000, None, "assistant", "null turn"), (7000, 1, "user", "x"),
             (7001, 3, "assistant", "tie"), (7001, 3, "assistant", "tie"), (7001, 3, "user", "tie"), (7002, 5, "assistant", "z" * 200_000),
             (7002, 6, "user", "after"), (7002, -4, "user", "before")]
    check(spark, rows)


def test_windows_keep_budget_history_and_system(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", f"turn{t} " + "abcd " * (t % 37)) for t in range(1, 1500)]
    w = {r["window"]: r for r in check(spark, rows).collect()}
    assert len(w) > 20
    for k, r in w.items():
        assert not r["over_budget"]
        assert r["formatted"].startswith("<|im_start|>system\nbe kind<|im_end|>\n")
        assert r["formatted"].count("<|im_start|>") == r["n_context"] + r["n_turns"]
        assert (r["n_context"] >= 1) == (k > 0)
        for s in r["loss"]:
            assert r["formatted"][:s["start"]].endswith("<|im_start|>assistant\n")
            assert r["formatted"][s["start"] + s["length"]:].startswith("<|im_end|>\n")
        # repeated turns carry no loss
        head = r["formatted"].split("<|im_end|>\n")[:r["n_context"]]
        assert all(s["start"] >= sum(len(x) + 11 for x in head) for s in r["loss"])
    assert any(r["n_context"] >= 2 for r in w.values())
    assert sum(r["n_turns"] for r in w.values()) == 1500


def test_a_turn_over_the_budget_stays_whole(spark):
    w = check(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "abcd " * 5000), (1, 2, "user", "r")]).collect()
    assert any(r["over_budget"] for r in w)


def test_empty_table(spark):
    w = C.format_windows(frame(spark, [(1, 1, "user", "x")]).where("conv_id < 0"))
    assert w.collect() == [] and C.read_back(w).collect() == []


def test_no_python_in_the_plan(spark):
    plan = C.read_back(C.format_windows(frame(spark, conversation_rows(2, 3))))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

"""Key indexes and deletions on bitmaps, against plain joins and sets."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.exprs import has_bit
from shelfwise.operators import jobs
from shelfwise.sources import append, keyindex

DAY = dt.date(2001, 8, 2)


def test_has_bit(spark):
    ids = [0, 1, 7, 8, 32767, 32768, 32769, -1, -40000, 10**12]
    bits = spark.createDataFrame([(i,) for i in ids], "id long").groupBy(F.bitmap_bucket_number("id").alias("b")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    asked = spark.createDataFrame([(i + d,) for i in ids for d in (-1, 0, 1)], "id long").distinct()
    got = asked.join(bits, F.bitmap_bucket_number("id") == F.col("b"), "left").where(has_bit("bits", F.bitmap_bit_position("id")))
    assert sorted(r.id for r in got.collect()) == sorted(ids)


@pytest.mark.parametrize("expected", [100, 100_000])  # an overfull filter only hits more often
def test_taken_is_exact(spark, tmp_path, expected):
    path = str(tmp_path / "ix")
    table = spark.range(0, 40_000, 2).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"), F.lit("x").alias("part_name"))
    keyindex.create_index(table, path, ["a", "b"], expected, parts=8)
    new = spark.range(30_000, 50_000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"), F.lit(1).alias("bits"))
    new = new.unionByName(new.limit(50)).unionByName(spark.createDataFrame([(None, 1, 1), ("4", None, 1)], "a string, b long, bits int"))
    want = {(str(i), i % 7) for i in range(30_000, 40_000, 2)}
    assert {tuple(r) for r in keyindex.taken(new, path).collect()} == want
    n = keyindex.hits(new, path).count()
    assert len(want) <= n <= (20_000 if expected == 100 else len(want) + 600)
    batch = keyindex.reserve(new.dropna(), path)
    with pytest.raises(RuntimeError, match="didn't end"):
        keyindex.taken(new, path)
    keyindex.commit(spark, path, batch)
    assert keyindex.taken(new, path).count() == 20_000
    assert keyindex.taken(new.limit(0), path).count() == 0


def test_lookup_reads_the_parts_it_touches(spark, tmp_path):
    path = str(tmp_path / "ix")
    keyindex.create_index(spark.range(100_000), path, ["id"], 100_000, parts=32)
    m = keyindex._state(spark, path)
    keys = keyindex._read(spark, path, m, "keys", [3])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*part#\d+ = 3", plan)
    assert {r[0].split("/")[-2] for r in keys.select(F.input_file_name()).distinct().collect()} == {"part=3"}
    assert 0 < keys.count() < 10_000
    assert keyindex.top(spark, path) == 99_999
    empty = str(tmp_path / "empty")
    keyindex.create_index(spark.range(0), empty, ["id"], 10)
    assert keyindex.taken(spark.range(5), empty).count() == 0 and keyindex.top(spark, empty) is None


def test_append_through_an_index(spark, tmp_path, lib):
    index, path = str(tmp_path / "index"), str(tmp_path / "members")
    n = lib["members"].count()
    append.index_keys(lib["members"], "members", index, 1000, parts=4)
    rows = spark.createDataFrame([("Zed", "Z", "zed@example.org")], "first_name string, last_name string, email string")
    new, bad = append.append_rows(rows, "members", path, DAY, index=index)
    assert not bad and new.first().member_id == n + 1
    _, bad = append.append_rows(rows, "members", path, DAY, index=index)
    assert set(bad) == {"unique_email"} and spark.read.parquet(path).count() == 1
    _, bad = append.append_rows(rows.withColumn("member_id", F.lit(n + 1)).withColumn("email", F.lit(None).cast("string")), "members", path, DAY, index=index)
    assert "pk" in bad
    more, bad = append.append_rows(rows.withColumn("email", F.lit("y@example.org")), "members", path, DAY, index=index)
    assert not bad and more.first().member_id == n + 2
    with pytest.raises(ValueError, match="either"):
        append.append_rows(rows, "members", path, DAY, index=index, existing=lib["members"])


EDGES = [("b", "a_id", "a", "id", "cascade"), ("c", "a_id", "a", "id", "cascade"), ("d", "b_id", "b", "id", "cascade"),
         ("d", "c_id", "c", "id", "cascade"), ("e", "d_id", "d", "id", "restrict"), ("d", "a_id", "a", "id", "restrict"), ("f", "f_id", "f", "id", "restrict")]
KEYS = {t: ["id"] for t in "abcdef"}


def brute_delete(data, ids):
    gone = {"a": set(ids)}
    gone["b"] = {r["id"] for r in data["b"] if r["a_id"] in gone["a"]}
    gone["c"] = {r["id"] for r in data["c"] if r["a_id"] in gone["a"]}
    gone["d"] = {r["id"] for r in data["d"] if r["b_id"] in gone["b"] or r["c_id"] in gone["c"]}
    bad = {("d", "a_id", r["id"]) for r in data["d"] if r["a_id"] in gone["a"] and r["id"] not in gone["d"]}
    bad |= {("e", "d_id", r["id"]) for r in data["e"] if r["d_id"] in gone["d"]}
    return {t: sorted(r["id"] for r in data[t] if r["id"] not in gone.get(t, ())) for t in data}, bad


@pytest.mark.parametrize("broadcast", [4096, 0])
def test_deletion_on_bitmaps(spark, monkeypatch, broadcast):
    import random
    monkeypatch.setattr(jobs, "BROADCAST_BUCKETS", broadcast)
    rng = random.Random(5)
    ids = {t: rng.sample(range(-70_000, 200_000), 60) for t in "abcde"}
    ref = lambda t: rng.choice([*ids[t], ids[t][0], ids[t][0], None])
    data = {"a": [{"id": i} for i in ids["a"]], "b": [{"id": i, "a_id": ref("a")} for i in ids["b"]], "c": [{"id": i, "a_id": ref("a")} for i in ids["c"]],
            "d": [{"id": i, "a_id": ref("a"), "b_id": ref("b"), "c_id": ref("c")} for i in ids["d"]], "e": [{"id": i, "d_id": ref("d")} for i in ids["e"]]}
    tables = {t: spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} long" for c in rows[0])) for t, rows in data.items()}
    for given in (ids["a"][:4], ids["a"][30:31], [], [199_999_999]):
        want, bad = brute_delete(data, given)
        frame = spark.createDataFrame([(i,) for i in [*given, *given, None]], "x long")
        out, viol = jobs.cascade_delete(tables, "a", frame, EDGES, KEYS)
        assert {t: sorted(r.id for r in df.collect()) for t, df in out.items()} == want
        assert {t: df.columns for t, df in out.items()} == {t: df.columns for t, df in tables.items()}
        assert {tuple(r) for r in viol.collect()} == bad
    f = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id long, f_id long")
    out, viol = jobs.cascade_delete({"f": f}, "f", spark.createDataFrame([(1,), (3,)], "x long"), EDGES, KEYS)
    assert [r.id for r in out["f"].collect()] == [2] and [tuple(r) for r in viol.collect()] == [("f", "f_id", 2)]
    with pytest.raises(ValueError, match="circle"):
        jobs.cascade_delete(tables, "a", tables["a"], [*EDGES, ("a", "d_id", "d", "id", "cascade")], KEYS)

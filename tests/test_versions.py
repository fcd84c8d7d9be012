"""Versioned tables: what an update writes, and what readers see."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import versions as V


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture
def made(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="versions-"), "t")
    rows = [(i, f"name {i}", "active") for i in range(4000)] + [(None, "no key", "active")]
    V.create_versioned(spark.createDataFrame(rows, "id long, name string, status string"), path, "id", 16)
    return path, rows


def test_updates_equal_a_dict(spark, made):
    path, rows = made
    rng = random.Random(41)
    want, seen = dict((r[0], list(r)) for r in rows), []
    for step in range(4):
        seen.append(sorted((tuple(r) for r in want.values()), key=repr))
        ids = rng.sample(range(5000), 7) + [None]
        new = [(i, rng.choice(["suspended", None])) for i in ids]
        assert V.update_version(spark, path, spark.createDataFrame(new, "id int, status string")) == step + 2
        for i, s in new:
            if i is not None and i in want:
                want[i] = [want[i][0], want[i][1], s]
    seen.append(sorted((tuple(r) for r in want.values()), key=repr))
    for version, expect in enumerate(seen, 1):  # every version stays readable
        assert sorted(map(tuple, V.read_version(spark, path, version).collect()), key=repr) == expect
    assert V.versions(spark, path) == [1, 2, 3, 4, 5]


def test_bytes_written_follow_the_changes(spark, made):
    path, _ = made
    V.update_version(spark, path, spark.createDataFrame([(17, "suspended")], "id long, status string"))
    first, second = sorted(os.listdir(f"{path}/data"))
    assert len([d for d in os.listdir(f"{path}/data/{second}") if d.startswith("part=")]) == 1
    assert _size(f"{path}/data/{second}") < 0.15 * _size(f"{path}/data/{first}")
    read = V.update_version.__globals__["_read"](spark, path, V._manifest(spark, path, None), [3]).inputFiles()
    assert len(read) == 1 and "part=3" in read[0]
    assert V.update_version(spark, path, spark.createDataFrame([], "id long, status string")) == 2


def test_a_failed_update_changes_nothing(spark, made):
    path, rows = made
    twice = spark.createDataFrame([(5, "a"), (5, "b")], "id long, status string")
    with pytest.raises(Exception, match="repeated id"):
        V.update_version(spark, path, twice)
    assert V.versions(spark, path) == [1] and V.read_version(spark, path).count() == len(rows)
    # what it left behind does not stand in the way of the next one
    assert V.update_version(spark, path, spark.createDataFrame([(5, "c")], "id long, status string")) == 2
    assert V.read_version(spark, path).where("id = 5").first()["status"] == "c"
    assert V.read_version(spark, path).count() == len(rows)


def test_the_later_of_two_writers_fails(spark, made, monkeypatch):
    path, _ = made
    publish = V._publish

    def late(spark, path, version, manifest):
        monkeypatch.setattr(V, "_publish", publish)
        V.update_version(spark, path, spark.createDataFrame([(1, "first")], "id long, status string"))
        publish(spark, path, version, manifest)

    monkeypatch.setattr(V, "_publish", late)
    with pytest.raises(RuntimeError, match="another job"):
        V.update_version(spark, path, spark.createDataFrame([(3000, "second")], "id long, status string"))
    got = V.read_version(spark, path)
    assert got.where("status = 'first'").count() == 1 and got.where("status = 'second'").count() == 0


def test_empty_table_and_taken_path(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="versions-"), "t")
    none = spark.createDataFrame([], "id long, v string")
    V.create_versioned(none, path, "id", 4)
    assert V.read_version(spark, path).collect() == []
    assert V.update_version(spark, path, spark.createDataFrame([(1, "x")], "id long, v string")) == 1
    with pytest.raises(ValueError):
        V.create_versioned(none, path, "id", 4)
    with pytest.raises(ValueError):
        V.read_version(spark, path, 9)
    with pytest.raises(ValueError):
        V.create_versioned(none.withColumn("part", F.lit(1)), path + "2", "id", 4)

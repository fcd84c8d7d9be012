import random

import pytest

from pyspark.sql import functions as F

from shelfwise.llm import language_id as L

SYLLABLES = {"aa": "ka to mi re sa".split(), "bb": "sch ung ver keit ß".split(), "cc": "ção nh lho ões é".split()}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    return [(i, sentence(rng, la, rng.randint(1, 80)), la) for i, la in enumerate(random.Random(1).choices(sorted(SYLLABLES), k=600))]


def test_held_out_accuracy_and_edges(spark, docs_of, corpus):
    model = L.fit(docs_of(corpus[:400]))
    assert model.languages == sorted(SYLLABLES)
    extra = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !! _ ²³", None), (None, corpus[0][1], "bb"), (1003, "漢字", None),
             (1004, "ka to mi " * 200_000, None), (1005, corpus[0][1].upper(), None)]
    docs = docs_of([*corpus[400:], *extra, corpus[450], corpus[450]])
    got = L.identify(docs, model)
    assert got.columns == ["doc_id", "lang_pred", "score", "accepted"]
    rows = got.collect()
    assert len(rows) == docs.count()
    truth = {i: la for i, _, la in corpus}
    held = [r for r in rows if r["doc_id"] in truth]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    by = {r["doc_id"]: r for r in rows}
    for i in (1000, 1001, 1002):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["accepted"]) == ("und", 0.0, False)
    assert by[1003]["lang_pred"] in model.languages
    assert by[1004]["lang_pred"] == "aa" and by[1004]["accepted"]
    assert by[None]["lang_pred"] == corpus[0][2] == by[1005]["lang_pred"]
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_and_id_are_no_inputs(spark, docs_of, corpus):
    model = L.fit(docs_of(corpus[:300]))
    a = L.identify(docs_of([(1, corpus[310][1], "aa")]), model).first()
    b = L.identify(docs_of([(99, corpus[310][1], "zz")]), model).first()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_training_is_bounded_and_repeatable(spark, docs_of, corpus):
    docs = docs_of(corpus)
    a, b = L.fit(docs, sample=50), L.fit(docs.repartition(5), sample=50)
    assert a.languages == b.languages and (a.scores == b.scores).all()
    assert L._sample_rows(docs.select("doc_id", "lang", "text"), 50).count() <= 50


def test_nothing_to_learn(spark, docs_of):
    empty = docs_of([(1, "x", "en")]).where("doc_id < 0")
    model = L.fit(empty)
    assert L.identify(empty, model).collect() == []
    assert L.identify(docs_of([(1, "some text", None)]), model).first()["lang_pred"] == "und"
    assert L.fit(docs_of([(1, "only null", None)])).languages == []


def test_long_text_in_pieces_equals_one_piece(monkeypatch):
    data = L.clean(sentence(random.Random(4), "bb", 400))
    ids, c = L.counts(data)
    monkeypatch.setattr(L, "_CHUNK", 97)
    ids2, c2 = L.counts(data)
    assert (ids == ids2).all() and (c == c2).all()
    assert int(c.sum()) == sum(len(data) - n + 1 for n in (2, 3, 4))


def test_queries_only_learn_from_their_fold(spark):
    from llm.conftest import SF

    from shelfwise.llm.common import py_crc
    from shelfwise.llm.queries import op3_language_id
    rows = op3_language_id(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (py_crc(str(r["doc_id"])) % 3 == 1) for r in rows)
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held)


def test_sample_of_repeated_rows_and_null_ids(spark, docs_of, corpus):
    """A row repeated thousands of times takes one place of the sample, rows
    without ids are rows of their own, and a rare language is learned."""
    rows = [(i, t, la) for i, t, la in corpus][:300]
    once = docs_of(rows)
    many = once.unionByName(docs_of([rows[0]]).crossJoin(spark.range(3000)).drop("id"))
    labelled = lambda df: df.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where("lang is not null")
    want = L._sample_rows(labelled(once), 200).count()
    assert L._sample_rows(labelled(many), 200).count() == want == min(200, once.where("lang is not null").count())
    nameless = docs_of([(None, t, la) for _, t, la in rows])
    assert L._sample_rows(labelled(nameless), 200).count() == 200
    rare = docs_of([(10_000 + i, f"zq xv{i} wk zzq", "xx") for i in range(5)]).unionByName(many)
    assert {r["lang"]: r["count"] for r in L._sample_rows(labelled(rare), 100).groupBy("lang").count().collect()}["xx"] == 5

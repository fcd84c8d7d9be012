import random

import numpy as np
import pytest

from shelfwise.llm import toxicity as T

BAD = ["grobba", "grobbeln", "grobbi", "idiot", "scum", "zlotka"]


def corpus(n=700):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ta", "re", "lo", "mi", "sen", "ou"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        text = [word() for _ in range(rng.randint(5, 120))]
        if toxic:
            text += rng.choices(BAD, k=rng.randint(1, 4)) if rng.random() < 0.9 else ["Grobb" + word()]
            rng.shuffle(text)
        rows.append((i, " ".join(text), "xx"))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, toxic string")
    marks = [(i, y, "clash") for i, y in labels if i % 4 != 2] + [(None, 1, "c"), (0, None, "c"), (99999, 1, "c"), (0, labels[0][1], "c")]
    lab = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    return rows, dict(labels), T.fit(docs, lab)


def test_held_out_accuracy(spark, docs_of, fitted):
    rows, truth, model = fitted
    got = T.score(docs_of([r for r in rows if r[0] % 4 == 2]), model)
    assert got.columns == ["doc_id", "score", "predicted"]
    got = got.collect()
    right = [int(r["predicted"] == truth[r["doc_id"]]) for r in got]
    assert np.mean(right) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_unseen_word_of_a_learned_stem(fitted):
    model = fitted[2]
    assert model.score("tare grobbenheit milo") > 0.3 > model.score("tare lore milo")


def test_edges(spark, docs_of, fitted):
    rows, _, model = fitted
    docs = docs_of([(1, None, None), (2, "", None), (None, "you idiot", None), (3, "ta re " * 150_000, None), (3, "ta re " * 150_000, None), (4, "!" * 50, None)])
    got = sorted(map(tuple, T.score(docs, model).collect()), key=repr)
    assert len(got) == 6
    by = {r[0]: r[1] for r in got}
    assert by[1] == by[2] and by[None] > by[2]
    assert T.score(docs.where("doc_id < 0"), model).collect() == []


def test_without_labels_the_lexicons_vote(spark, docs_of):
    docs = docs_of([(1, "hello there", None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for d in (docs, docs.where("doc_id < 0")):
        m = T.fit(d, none)
        assert m.score("you idiot") > 0.3 > m.score("hello there")


def test_label_model_joins_correlated_voters():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    a = np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.02)
    copies = np.stack([a, a ^ (rng.random(4000) < 0.01), a])
    alone = [np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.05) for _ in range(2)]
    noise = rng.random(4000) < 0.1
    votes = np.stack([*copies, *alone, noise], 1)
    model = T.fit_label_model(votes, np.where(y ^ (rng.random(4000) < 0.02), 0.99, 0.002))
    assert len({*model.clique[:3]}) == 1 and len({*model.clique}) == 4
    post = model.posterior(votes.astype(float))
    # three copies of one witness weigh like one; the posterior is calibrated
    assert abs(post.mean() - y.mean()) < 0.05
    sure = post > 0.9
    assert y[sure].mean() > 0.85
    k = model.clique[0]
    assert abs(model.rates[1, k, 1:].sum() - 0.7) < 0.08 and model.rates[0, k, 1:].sum() < 0.1


def test_query_holds_out_its_fold(spark):
    from llm.conftest import SF

    from shelfwise.llm.common import py_crc
    from shelfwise.llm.queries import op9_toxicity
    rows = op9_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (py_crc(str(r["doc_id"])) % 4 == 2) for r in rows)

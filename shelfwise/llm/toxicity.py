"""Toxicity by weak supervision.

Voters fire on a text: lexicons of insults in several languages, word stems
induced from labelled training documents, and patterns (shouting, an insult
aimed at the reader, ...). A generative label model estimates how
often they fire in either class and which are correlated given the class:
correlated voters form cliques, modelled jointly, so they don't count as
independent witnesses. It is fitted by EM anchored at the labels of the
training sample. Its posterior labels train a sparse linear classifier over words and word stems,
which then scores every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, stage

#: bound of the labelled training sample, per class (smallest id hashes)
SAMPLE_PER_CLASS = 2500
#: induced voters at most, and features of the classifier at most
MAX_VOTERS, MAX_FEATURES = 160, 4000
STEMS = (4, 5, 6)
THRESHOLD = 0.3

# fixed values: general insult lexicons
LEXICONS = {
    "en": ("idiot", "moron", "loser", "scum", "stupid", "pathetic", "worthless", "trash", "clown", "disgusting", "imbecile", "dumb", "jerk",
           "bastard", "bitch", "asshole", "fool", "garbage", "vermin", "degenerate", "freak", "creep", "filth", "shut", "hate"),
    "de": ("idiot", "trottel", "dumm", "arschloch", "abschaum", "schwachkopf", "versager", "widerlich", "dreck", "depp", "blödmann", "clown"),
    "fr": ("idiot", "imbécile", "connard", "débile", "ordure", "minable", "nul", "crétin", "dégoûtant", "abruti", "clown", "stupide"),
    "es": ("idiota", "imbécil", "estúpido", "basura", "escoria", "payaso", "patético", "asqueroso", "perdedor", "tonto", "inútil"),
}
_AIMED = re.compile(r"\b(?:you|your|you're|du|ihr|tu|vous|t[úu]|eres|es)\b[^.!?\n]{0,40}\b(?:" + "|".join(
    sorted({w for words in LEXICONS.values() for w in words}, key=lambda w: (-len(w), w))) + r")\b", re.IGNORECASE)
_ATTACK = re.compile(r"\b(?:go to hell|shut up|get lost|drop dead|kill yourself|halt die klappe|ta gueule|c[áa]llate)\b", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")
PATTERNS = ("aimed", "attack", "shout", "bangs")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features(words: set[str]) -> set[str]:
    """Each word, and its stems marked with a star."""
    out = set(words)
    for n in STEMS:
        out.update(w[:n] + "*" for w in words if len(w) >= n)
    return out


def patterns(text: str | None) -> tuple[bool, ...]:
    """Which pattern voters fire."""
    if not text:
        return (False,) * len(PATTERNS)
    return (_AIMED.search(text) is not None, _ATTACK.search(text) is not None,
            len(text) >= 20 and text.isupper(), text.count("!") * 20 > len(text))


@dataclass
class LabelModel:
    """Two-class generative model of voters that fire or not. Voters whose
    firing is correlated within the toxic class form cliques, which are
    independent given the class; ``rates[c, k, l]`` is the rate at which none
    (l=0), one (1) or several (2) voters of clique k fire in class c."""

    prior: float
    clique: np.ndarray
    rates: np.ndarray

    def levels(self, votes: np.ndarray) -> np.ndarray:
        fired = np.zeros((len(votes), self.rates.shape[1]))
        np.add.at(fired.T, self.clique, votes.T)
        return np.minimum(fired, 2).astype(np.int64)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        weight = np.log(self.rates[1] / self.rates[0])
        z = math.log(self.prior / (1 - self.prior)) + weight[np.arange(len(weight)), self.levels(votes)].sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def cliques(votes: np.ndarray, post: np.ndarray, least: float = 0.15) -> np.ndarray:
    """Clique number of every voter: voters connected by correlations of
    ``least`` or more within the toxic class."""
    w = post / max(post.sum(), 1e-9)
    residual = votes - w @ votes
    sd = np.sqrt(w @ (residual ** 2)) + 1e-9
    linked = (residual * w[:, None]).T @ residual / np.outer(sd, sd) >= least
    np.fill_diagonal(linked, True)
    label = np.arange(votes.shape[1])
    while True:
        low = np.where(linked, label[None, :], len(label)).min(1)
        if (low == label).all():
            return np.unique(label, return_inverse=True)[1]
        label = low


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 15) -> LabelModel:
    """EM anchored at ``start`` (the labels of the training sample, softened):
    each step's rates are those under the mean of ``start`` and the current
    posterior. Without the anchor, cliques that never fire together (lexicons
    of different languages) would drift apart into either class. A clique
    that fires more often in the clean class counts as no evidence."""
    votes = votes.astype(np.float64)
    post = start.astype(np.float64)
    for turn in range(rounds):
        if turn < 3:
            clique = cliques(votes, post)
        k = int(clique.max()) + 1 if len(clique) else 0
        model = LabelModel(float(np.clip(post.mean(), 0.01, 0.99)), clique, np.ones((2, k, 3)))
        level = model.levels(votes)
        held = (start + post) / 2
        for c, w in ((0, 1 - held), (1, held)):
            for x in range(3):
                model.rates[c, :, x] = (w @ (level == x) + (0.1 if x else 1.0)) / (w.sum() + 1.2)
        for x in (1, 2):
            model.rates[1, :, x] = np.maximum(model.rates[0, :, x], model.rates[1, :, x])
        new = model.posterior(votes)
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return model


def fit_linear(rows: list[np.ndarray], target: np.ndarray, weight: np.ndarray, size: int, epochs: int = 12,
               rate: float = 0.3, lasso: float = 0.02, seed: int = 5) -> tuple[np.ndarray, float]:
    """Logistic regression with soft targets on sparse binary rows: AdaGrad
    steps with a lasso proximal step, so unused features get weight zero."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros(size), np.full(size, 1e-8)
    b, bg2 = 0.0, 1e-8
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids = rows[i]
            z = b + w[ids].sum()
            err = (1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) - target[i]) * weight[i]
            g2[ids] += err * err
            bg2 += err * err
            step = rate / np.sqrt(g2[ids])
            u = w[ids] - step * err
            w[ids] = np.sign(u) * np.maximum(np.abs(u) - step * lasso, 0.0)
            b -= rate / math.sqrt(bg2) * err
    return w, b


@dataclass
class Model:
    """Non-zero weights of words, of stems by length, and of patterns."""

    words: dict[str, float]
    stems: dict[int, dict[str, float]]
    patterns: tuple[float, ...]
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias
        if text:
            words = words_of(text)
            z += sum(map(self.words.__getitem__, self.words.keys() & words))
            for n, table in self.stems.items():
                if table:
                    z += sum(map(table.__getitem__, table.keys() & {w[:n] for w in words}))
            if any(self.patterns):
                z += sum(w for w, on in zip(self.patterns, patterns(text), strict=True) if on)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, text) of at most ``per_class`` labelled documents of
    either class, and the class counts of all of them. Labels repeated for a
    document count as their maximum."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stage(docs.select("doc_id").distinct().join(marks, "doc_id"), "toxic-labels")
    count = {int(r["toxic"]): r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for c in (0, 1):
        some = marks.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    # at most 2 x per_class rows of two numbers: a proven bound
    rows = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return stage(rows, "toxic-sample"), count


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Train from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) on a
    bounded sample. Labels induce voters, start the label model and set the
    class balance; the classifier learns from the model's posterior labels. Without toxic
    labels the general lexicons alone vote."""
    ship(docs.sparkSession)
    sample, count = _sample(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                            labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")), per_class)

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = {0: Counter(), 1: Counter()}
            for text, y in zip(f["text"], f["toxic"], strict=True):
                got[int(y > 0)].update(features(words_of(text)))
            keys = sorted(got[0].keys() | got[1].keys())
            if keys:
                yield pd.DataFrame({"feature": pd.Series(keys, dtype=object), "toxic": [got[1][k] for k in keys], "clean": [got[0][k] for k in keys]})

    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = max(1, sum(n for y, n in seen.items() if y > 0)), max(1, sum(n for y, n in seen.items() if y <= 0))
    ratio = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    best = (sample.mapInPandas(tally, "feature string, toxic long, clean long")
                  .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                  .where("toxic >= 4").withColumn("power", ratio * F.sqrt("toxic")).where((ratio > 1.5) & (F.col("power") > 5))
                  .orderBy(F.desc("power"), "feature").limit(MAX_FEATURES).collect())
    lexicon = sorted({w for words in LEXICONS.values() for w in words})
    names = list(dict.fromkeys([r["feature"] for r in best] + lexicon))
    index = {f: i for i, f in enumerate(names)}
    induced = [r["feature"] for r in best if r["clean"] * 100 * n1 <= r["toxic"] * n0][:MAX_VOTERS]

    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for ident, toxic, text in zip(f["doc_id"], f["toxic"], f["text"], strict=True):
                ids = np.array(sorted(index[x] for x in features(words_of(text)) if x in index), dtype=np.int32)
                rows.append((ident, toxic, ids.tobytes(), [bool(x) for x in patterns(text)]))
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "ids", "patterns"])

    got = sorted(sample.mapInPandas(collect, "doc_id long, toxic int, ids binary, patterns array<boolean>").collect(), key=lambda r: r["doc_id"])
    if not got:
        return Model({w: 3.0 for w in lexicon}, {}, (0.0,) * len(PATTERNS), -3.0)
    sets = [np.frombuffer(r["ids"], np.int32) for r in got]
    fires = np.array([list(r["patterns"]) for r in got], dtype=bool)
    columns = [fires[:, j] for j in range(len(PATTERNS))]
    for words in LEXICONS.values():
        ids = {index[w] for w in words}
        columns.append(np.array([not ids.isdisjoint(s.tolist()) for s in sets]))
    for f in induced:
        i = index[f]
        columns.append(np.array([bool(len(s)) and s[min(np.searchsorted(s, i), len(s) - 1)] == i for s in sets]))
    votes = np.stack(columns, 1)
    marked = np.array([r["toxic"] > 0 for r in got])
    post = fit_label_model(votes, np.where(marked, 0.99, 0.002)).posterior(votes.astype(np.float64))
    # rows are weighted back to the class balance of all labelled documents
    toxic = max(1, sum(n for y, n in count.items() if y > 0))
    clean = max(1, sum(n for y, n in count.items() if y <= 0))
    scale = post * (toxic / n1) + (1 - post) * (clean / n0)
    scale /= scale.mean()
    size = len(names)
    rows = [np.concatenate([s, size + np.flatnonzero(p)]).astype(np.int64) for s, p in zip(sets, fires, strict=True)]
    w, b = fit_linear(rows, post, scale, size + len(PATTERNS))
    kept = {f: float(w[i]) for f, i in index.items() if w[i]}
    return Model({f: x for f, x in kept.items() if not f.endswith("*")},
                 {n: {f[:-1]: x for f, x in kept.items() if f.endswith("*") and len(f) == n + 1} for n in STEMS},
                 tuple(float(x) for x in w[size:]), float(b))


def toxic_score(text: Column, model: Model) -> Column:
    """Score (0 to 1) of a text column; null and empty texts get the score of
    no evidence. The model holds at most MAX_FEATURES weights."""
    spark = SparkSession.active()
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = held.value
        return pd.Series([m.score(t) for t in texts], dtype="float64")

    return run(text)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row, whole texts. Repeated rows are
    returned as often as given, null ids stay null, an empty table gives an
    empty result, other columns are ignored."""
    d = docs.select("doc_id", toxic_score(F.col("text"), model).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

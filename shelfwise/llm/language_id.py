"""Language identification: averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent in numpy.

A text is lower-cased, everything but letters becomes one space, and the
byte n-grams (2 to 4 bytes, word ends included) of the result are hashed into
buckets. The text's vector is the mean of its buckets' embeddings; a linear
softmax turns it into language scores. As mean and linear map commute, a
trained model is applied as one table of per-bucket class scores.

The temperature of the softmax is calibrated on documents kept out of the
gradient steps, and documents whose calibrated confidence is under the
threshold are marked rejected (junk, or no learned language).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from shelfwise.llm.common import ship


BUCKETS = 1 << 15
DIM = 16
EPOCHS = 6
RATE = 8.0
#: bound of the labelled training sample (by hash, languages in turn)
SAMPLE = 3000
#: calibrated confidence under which a document is rejected
REJECT_BELOW = 0.4
UNKNOWN = "und"
_GRAMS = (2, 3, 4)
_CHUNK = 1 << 20
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
#: ASCII letters to lower case, other ASCII to space, bytes of non-ASCII characters kept
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile(rb"[a-z]")
_NON_ASCII_OTHER = re.compile(r"[^\x00-\x7f\w]+|[^\x00-\x7f\D]+")


def clean(text: str | None) -> bytes:
    """Letters in lower case with single spaces around the words."""
    if not text:
        return b""
    low = text.lower()
    if not low.isascii():
        low = _NON_ASCII_OTHER.sub(" ", low)
    words = low.encode("utf-8", "replace").translate(_CLEAN).split()
    return b" " + b" ".join(words) + b" " if words else b""


def buckets(data: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams, in bounded pieces."""
    for at in range(0, len(data), _CHUNK):
        a = np.frombuffer(data[at:at + _CHUNK + max(_GRAMS) - 1], dtype=np.uint8).astype(np.uint32)
        code = a.copy()
        for n in range(2, max(_GRAMS) + 1):
            code = code[:-1] * np.uint32(257) + a[n - 1:]
            if n in _GRAMS:
                h = code * _MULT[n - 2]
                h ^= h >> np.uint32(15)
                # the last piece's n-grams only; others start in this piece
                yield (h & np.uint32(BUCKETS - 1))[:_CHUNK]
            if len(code) < 2:
                break


def counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for b in buckets(data):
        total += np.bincount(b, minlength=BUCKETS)
    ids = np.flatnonzero(total)
    return ids.astype(np.uint16), total[ids].astype(np.uint32)


@dataclass
class Model:
    """``scores``: per bucket and language, already divided by the calibrated
    temperature; ``bias`` likewise. No languages: everything is unknown."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    threshold: float

    def predict(self, text: str | None) -> tuple[str, float]:
        data = clean(text)
        if not data or not self.languages or not (_ASCII_LETTER.search(data) or any(map(str.isalpha, text))):
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.languages)), 0
        for b in buckets(data):
            if len(b) > BUCKETS // 2:
                total += np.bincount(b, minlength=BUCKETS).astype(np.float32) @ self.scores
            else:
                total += self.scores[b].sum(0, dtype=np.float64)
            n += len(b)
        z = total / max(n, 1) + self.bias
        z = np.exp(z - z.max())
        best = int(z.argmax())
        return self.languages[best], float(z[best] / z.sum())


def train(samples: list[tuple[np.ndarray, np.ndarray, str]], threshold: float = REJECT_BELOW, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Fit on (bucket ids, counts, language) rows. Every fifth row takes no
    gradient step and calibrates the temperature (least log loss)."""
    samples = [s for s in samples if len(s[0])]
    languages = sorted({s[2] for s in samples})
    k = len(languages)
    if not k:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), threshold)
    index = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1.0 / dim, 1.0 / dim, (BUCKETS, dim))
    out = np.zeros((dim, k))
    bias = np.zeros(k)
    data = [(ids, (c / c.sum()).astype(np.float32), index[lang]) for ids, c, lang in samples]
    fit = [d for i, d in enumerate(data) if i % 5 != 4] or data
    tune = [d for i, d in enumerate(data) if i % 5 == 4] or data
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            ids, w, y = fit[i]
            lr = rate * (1 - done / steps)
            done += 1
            h = w @ emb[ids]
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            back = out @ p
            out -= lr * 0.1 * np.outer(h, p)
            bias -= lr * 0.002 * p
            emb[ids] -= lr * np.outer(w, back)
    scores = emb @ out
    logits = np.array([w @ scores[ids] + bias for ids, w, _ in tune])
    truth = np.array([y for _, _, y in tune])

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(truth)), truth]).mean())

    heat = min((2.0 ** (e / 4) for e in range(-16, 17)), key=loss)
    return Model(languages, (scores / heat).astype(np.float32), bias / heat, threshold)


def _sample_rows(docs: DataFrame, sample: int) -> DataFrame:
    """The bounded labelled sample, chosen by hashes before any text is read
    whole: an id and language count once however often the row is repeated
    (with its smallest text), rows without an id once for each text. Languages
    take turns, so that a rare one is learned beside frequent ones."""
    pick = F.xxhash64("doc_id", "lang", F.when(F.col("doc_id").isNull(), F.col("text"))).alias("pick")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))
    chosen = (docs.select("lang", pick).distinct().withColumn("turn", turn).where(F.col("turn") <= sample)
                  .orderBy("turn", "pick").limit(sample).select(F.col("lang").alias("chosen_lang"), F.col("pick").alias("chosen")))
    # at most ``sample`` small rows: a proven bound for the broadcast
    return (docs.withColumn("pick", pick).join(F.broadcast(chosen), (F.col("pick") == F.col("chosen")) & (F.col("lang") == F.col("chosen_lang")))
                .groupBy("pick", "doc_id", "lang").agg(F.min("text").alias("text")).drop("pick"))


def fit(docs: DataFrame, sample: int = SAMPLE, threshold: float = REJECT_BELOW) -> Model:
    """Train on at most about ``sample`` rows of ``docs`` (doc_id, text, lang;
    null languages and rows are ignored). Texts become bucket counts on the
    executors; the driver receives at most BUCKETS counts a row. From each
    text short runs of words are learned as well, so that one-line texts are
    told apart."""
    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for ident, text, lang in zip(f["doc_id"], f["text"], f["lang"], strict=True):
                data = clean(text)
                words = data.split()
                parts = [data]
                for n in (1, 3, 8):
                    if len(words) > n:
                        at = (int(ident) * 31 + n * 7 if ident == ident and ident is not None else n) % (len(words) - n)
                        parts.append(b" " + b" ".join(words[at:at + n]) + b" ")
                for j, part in enumerate(parts):
                    ids, c = counts(part)
                    rows.append((ident if ident == ident else None, j, lang, ids.tobytes(), c.tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "part", "lang", "ids", "counts"])

    ship(docs.sparkSession)
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where("lang is not null")
    got = _sample_rows(labelled, sample).mapInPandas(features, "doc_id long, part int, lang string, ids binary, counts binary")
    # one partition at a time, and straight into small arrays: the driver holds the bounded sample once
    samples = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["part"], r["lang"], bytes(r["ids"]), bytes(r["counts"])) for r in got.toLocalIterator()))
    return train([(np.frombuffer(i, np.uint16), np.frombuffer(c, np.uint32), lang) for _, _, _, lang, i, c in samples], threshold)


_RESULT = StructType([StructField("lang", StringType()), StructField("score", DoubleType()), StructField("accepted", BooleanType())])


def predict(text: Column, model: Model) -> Column:
    """Struct (lang, score, accepted) of a text column. Null texts and texts
    without letters: ``und``, score 0, not accepted. The model (a table of
    BUCKETS x languages floats) is a bounded broadcast."""
    spark = SparkSession.active()
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf(_RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        m = held.value
        got = [m.predict(t) for t in texts]
        return pd.DataFrame({"lang": [g[0] for g in got], "score": [g[1] for g in got],
                             "accepted": [g[0] != UNKNOWN and g[1] >= m.threshold for g in got]})

    return run(text)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, accepted of every row (whole texts). Repeated
    rows are returned as often as given, null ids stay null, an empty table
    gives an empty result, other columns are ignored."""
    d = docs.select("doc_id", predict(F.col("text"), model).alias("p"))
    return d.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                    F.col("p.accepted").alias("accepted"))



"""Phrase collocations by best-first growth with admissible bounds.

A phrase's score is the lowest of its cuts' ``floor(1000 a n / (l r))`` (a, l
and r count the phrase, its first part and the rest; n all words of the
language). As a is at most r, no phrase that begins with a word counted l
times can pass ``floor(1000 n / l)``: the count of a prefix bounds whatever
grows from it, so rare first words come first. Rounds take the next first
words in this order, grow their phrases word by word (only a phrase counted
often enough is grown further), score what is found, and end in each language
when no first word left could reach its 2000th surviving score.

The table is read twice: once to count words, then to write it as arrays of
the numbers of those counted often enough (no other word is in a phrase to be
found, so it ends a piece). A growth step broadcasts a bounded number of
phrases as a trie of sorted arrays, finds them in the arrays, and sums up the
words that follow in a task before anything is shuffled; more phrases take more
steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import drop_path, ship, small_or_plain, staged

LONGEST, LEAST, BEST = 5, 100, 2000
#: first words of a language in the first round (each later round takes eight times as many), and phrases broadcast at a time
ROOTS, NODES = 4000, 400_000
#: characters of one array of word numbers (a longer text alone)
PORTION = 1 << 20
#: rows (arrays of about a megabyte; texts) of an Arrow batch: the JVM and the worker each hold one
BATCH, TEXTS = 4, 16
#: pairs, and bytes of words, that a task holds to sum them up before it gives them on, and rows of an Arrow batch it gives
HELD, HELD_BYTES, GIVEN = 1 << 20, 1 << 25, 1 << 16
#: words of a table for each file of phrases: few are counted often enough, and a file a shuffle partition would mostly be tiny
FILE_WORDS = 50_000_000
#: Parquet looks at sizes only every 100 rows by default: pages and their off-heap buffers would grow to 100 arrays
LAYOUT = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
_SAME = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_C = [f"c{i}" for i in range(1, LONGEST + 1)]


# ---------------------------------------------------------------- words
def word_rows(lang: str, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Different words of the texts, how often each occurs, their codes, and
    the texts as word numbers from 1 on, 0 between pieces."""
    import xxhash

    raw = "\n".join(texts).encode().lower().translate(_SAME).replace(b"\n", b" \n ")  # bytes.lower: A-Z only
    coded = pc.split_pattern(pa.array([raw], pa.large_string()), " ").flatten().dictionary_encode()
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    number = np.zeros(len(words), dtype=np.int32)
    kept = [i for i, w in enumerate(words) if w not in ("", "\n")]
    number[kept] = np.arange(1, len(kept) + 1)
    if "" in words:
        at = at[at != words.index("")]  # white space in a row is one gap
    numbers = number[at]
    words = [words[i] for i in kept]
    seed = xxhash.xxh64_intdigest(lang.encode(), seed=42)
    codes = np.array([xxhash.xxh64_intdigest(w, seed=seed) for w in words], dtype=np.uint64).view(np.int64)
    return words, np.bincount(numbers, minlength=len(words) + 1)[1:], codes, numbers


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language, about PORTION characters at a time."""
    held: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            t = text.as_py()
            held.setdefault(lang, []).append(t)
            size[lang] = size.get(lang, 0) + len(t)
            if size[lang] >= PORTION:
                yield lang, held.pop(lang)
                del size[lang]
    yield from held.items()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n), summed up in a task as far as HELD_BYTES go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for lang, texts in _portions(batches):
            words, counts, _, _ = word_rows(lang, texts)
            held.append(pa.table({"lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())}))
            if sum(t.nbytes for t in held) >= HELD_BYTES:
                held = [summed(held)]
                if held[0].nbytes > HELD_BYTES // 2:
                    yield from held.pop().to_batches(GIVEN)
        if held:
            yield from summed(held).to_batches(GIVEN)

    def summed(held: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(held).group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")])
        return sums.select(["lang", "word", "n_sum"]).rename_columns(["lang", "word", "n"]).combine_chunks()

    return _texts(docs).mapInArrow(run, "lang string, word string, n long")


def numbered_texts(docs: DataFrame, codes: Broadcast) -> DataFrame:
    """(numbers): a row for each portion of a language's texts in a task, as
    the places from 1 on of its words in the sorted ``codes``, 0 between
    pieces and for words that aren't there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _portions(batches):
            _, _, own, numbers = word_rows(lang, texts)
            place = np.minimum(np.searchsorted(codes.value, own), len(codes.value) - 1)
            numbers = np.concatenate([[0], np.where(codes.value[place] == own, place + 1, 0)])[numbers]
            numbers = numbers[(numbers > 0) | np.concatenate([[False], numbers[:-1] > 0])]  # breaks in a row are one
            yield pa.RecordBatch.from_pydict({"numbers": pa.array([numbers.astype("<i4").tobytes()], pa.binary())})

    return _texts(docs).mapInArrow(run, "numbers binary")


# ---------------------------------------------------------------- phrases in the arrays
class Trie:
    """Phrases of several lengths to be found in arrays of word codes, one
    list for each kind of count: ``whole`` (the phrase), ``right`` and ``left``
    (the phrase with each word behind or before it)."""

    def __init__(self, **kinds: np.ndarray):
        phrases = {k: p.astype(np.int64).reshape(-1, LONGEST) for k, p in kinds.items()}
        everything = np.concatenate(list(phrases.values()))
        self.words = np.unique(everything[everything != 0])
        #: numbers of the words from 1 on, 0 behind a phrase: half the size of codes
        self.phrases = {k: np.where(p != 0, np.searchsorted(self.words, p) + 1, 0).astype(np.int32) for k, p in phrases.items()}
        self.keys: list[np.ndarray] = [np.empty(0, dtype=np.int64)]
        self.rows: list[dict[str, np.ndarray]] = []
        at = {k: p.astype(np.int64) - 1 for k, p in self.phrases.items()}
        lengths = {k: (p != 0).sum(axis=1) for k, p in self.phrases.items()}
        node = {k: np.zeros(len(p), dtype=np.int64) for k, p in self.phrases.items()}
        self.depth = max((int(n.max()) for n in lengths.values() if len(n)), default=0)
        for level in range(1, self.depth + 1):
            for k in node:
                deep = lengths[k] >= level
                node[k][deep] = at[k][deep, 0] if level == 1 else node[k][deep] * len(self.words) + at[k][deep, level - 1]
            keys = np.unique(np.concatenate([node[k][lengths[k] >= level] for k in node]))
            self.keys.append(keys)
            rows = {}
            for k in node:
                deep = lengths[k] >= level
                node[k][deep] = np.searchsorted(keys, node[k][deep])
                ends = np.flatnonzero(lengths[k] == level)
                if len(ends):
                    rows[k] = np.full(len(keys), -1, dtype=np.int32)
                    rows[k][node[k][ends]] = ends
            self.rows.append(rows)

    def spelled(self, kind: str, rows: np.ndarray) -> np.ndarray:
        """The codes of phrases, by their rows."""
        return np.concatenate([[0], self.words])[self.phrases[kind][rows]]

    def count(self, codes: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, rows of its phrases, codes of the words beside them or 0,
        counts) in one portion whose words have these codes."""
        codes = np.concatenate([[0], codes])
        for kind, pair, times in self.pairs(self.found(codes[1:]), numbers):
            yield kind, pair // len(codes), codes[pair % len(codes)], times

    def found(self, codes: np.ndarray) -> np.ndarray:
        """The words of the phrases that numbers from 0 on stand for, -1 for
        none, if words from 1 on have these codes."""
        found = np.full(len(codes) + 1, -1, dtype=np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, codes), len(self.words) - 1)
            found[1:] = np.where(self.words[at] == codes, at, -1)
        return found

    def pairs(self, found: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(kind, row of a phrase times the length of ``found`` plus the
        number of the word beside it or 0, counts) in one portion."""
        numbers = np.concatenate([[0], numbers, np.zeros(LONGEST, dtype=numbers.dtype)])
        word = found[numbers]
        at = np.flatnonzero(word >= 0)
        node = word[at]
        for level in range(1, self.depth + 1):
            if level > 1:
                following = word[at + level - 1]
                at, node = at[following >= 0], node[following >= 0] * len(self.words) + following[following >= 0]
            keys = self.keys[level]
            if not len(at) or not len(keys):
                return
            place = np.minimum(np.searchsorted(keys, node), len(keys) - 1)
            hit = keys[place] == node
            at, node = at[hit], place[hit]
            for kind, rows in self.rows[level - 1].items():
                row = rows[node].astype(np.int64)
                here, row = at[row >= 0], row[row >= 0]
                beside = np.zeros(len(row), dtype=np.int64)
                if kind != "whole":
                    beside = numbers[here + level if kind == "right" else here - 1].astype(np.int64)
                    row, beside = row[beside > 0], beside[beside > 0]
                pair, times = np.unique(row * len(found) + beside, return_counts=True)
                if len(pair):
                    yield kind, pair, times


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs in order, and their counts."""
    pair, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    return pair[first], np.add.reduceat(n[order], first)


def counted(numbered: DataFrame, codes: Broadcast, least: int, **kinds: np.ndarray) -> tuple[DataFrame, Broadcast]:
    """(kind, c1..c5, beside, n) of the given phrases over all texts, counts
    of ``least`` or more, and the broadcast phrases, to be destroyed once the
    counts are written. A phrase, its kind and the word beside it are shuffled
    as one number, summed up in a task as far as HELD pairs go."""
    shared = numbered.sparkSession.sparkContext.broadcast(Trie(**kinds))
    names = list(kinds)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        found = trie.found(codes.value)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            for numbers in b.column(0):
                for kind, pair, n in trie.pairs(found, np.frombuffer(numbers.as_buffer(), dtype="<i4")):
                    row, beside = np.divmod(pair, len(found))
                    held.append(((row * len(names) + names.index(kind)) * len(found) + beside, n))
                if sum(len(pair) for pair, _ in held) >= HELD:
                    held = [_summed(held)]
                    if len(held[0][0]) > HELD // 2:
                        yield from give(*held.pop())
            pa.default_memory_pool().release_unused()
        if held:
            yield from give(*_summed(held))

    def give(pair: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(pair), GIVEN):
            yield pa.RecordBatch.from_arrays([pa.array(pair[i:i + GIVEN]), pa.array(n[i:i + GIVEN])], names=["pair", "n"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        words = np.concatenate([[0], codes.value])
        for b in batches:
            row, beside = np.divmod(b.column(0).to_numpy(), len(words))
            kind = row % len(names)
            phrase = np.empty((len(row), LONGEST), dtype=np.int64)
            for i, name in enumerate(names):
                phrase[kind == i] = trie.spelled(name, row[kind == i] // len(names))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(names, dtype=object)[kind], pa.string()), *(pa.array(phrase[:, i]) for i in range(LONGEST)),
                                              pa.array(words[beside]), b.column(1)], names=["kind", *_C, "beside", "n"])

    # summed up already: dealt out first, so that no task keeps another map of them before the shuffle; a pair is one row
    # a portion at most, however common
    found = numbered.mapInArrow(find, "pair long, n long").repartition("pair")
    often = found.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return often.mapInArrow(spell, "kind string, " + ", ".join(f"{c} long" for c in _C) + ", beside long, n long"), shared


def _blocks(df: DataFrame, nodes: int) -> Iterator[np.ndarray]:
    """The phrases (c1..c5) of a written table, at most about ``nodes`` at a
    time."""
    n = df.count()
    parts = -(-n // nodes)
    for i in range(parts):
        part = df.select(*_C) if parts == 1 else df.where(F.pmod(F.xxhash64(*_C), F.lit(parts)) == i).select(*_C)
        yield part.toPandas().to_numpy(dtype=np.int64).reshape(-1, LONGEST)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _codes(*named) -> list:
    """Five code columns from up to five expressions, 0 behind them."""
    return [F.coalesce(named[i], F.lit(0).cast("long")).alias(_C[i]) if i < len(named) else F.lit(0).cast("long").alias(_C[i]) for i in range(LONGEST)]


# ---------------------------------------------------------------- growth
class Miner:
    def __init__(self, docs: DataFrame, least: int, best: int, roots: int, nodes: int):
        self.spark = docs.sparkSession
        self.least, self.best, self.nodes, self.take = least, best, nodes, roots
        self.paths: list[str] = []
        self.codes: Broadcast | None = None
        self.files = 2
        words = word_counts(docs).repartition("lang", "word").groupBy("lang", "word").agg(F.sum("n").alias("f"))  # summed up already, as in ``counted``
        # words counted too seldom are one row a language, without a word
        words = words.groupBy("lang", F.when(F.col("f") >= least, F.col("word")).alias("word")).agg(F.sum("f").alias("f"))
        words = self.keep(words.withColumn("code", F.xxhash64("lang", "word")), "words", TEXTS)
        #: a row a language
        self.total = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("f").alias("n")).collect()}
        self.files = max(self.files, sum(self.total.values()) // FILE_WORDS)
        self.words = words.where("word is not null")
        n, different, zero = self.words.agg(F.count(F.lit(1)), F.count_distinct("code"), F.count_if(F.col("code") == 0)).first()
        if n != different or zero:
            raise RuntimeError("two words have one 64-bit code")
        if n:
            #: 8 bytes for each word counted often enough
            self.codes = self.spark.sparkContext.broadcast(np.sort(self.words.select("code").toPandas()["code"].to_numpy(dtype=np.int64)))
            self.numbered = self.keep(numbered_texts(docs, self.codes), "numbered", TEXTS, LAYOUT, dealt=False)
        self.scored: list[DataFrame] = []

    def keep(self, df: DataFrame, name: str, batch: int = BATCH, options: dict | None = None, dealt: bool = True) -> DataFrame:
        # rows of a megabyte: Arrow batches of the usual number of rows would take hundreds
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, batch)
        try:
            df, path = staged(df.repartition(self.files) if dealt else df, f"collocations-{name}", options)
        finally:
            self.spark.conf.set(setting, before)
        self.paths.append(path)
        return df

    def counts(self, kind: str, phrases: np.ndarray) -> DataFrame:
        """``counted``, written before the next phrases are broadcast, so that
        executors hold one trie at a time."""
        df, shared = counted(self.numbered, self.codes, self.least, **{kind: phrases})
        df = self.keep(df, "counts")
        shared.destroy()
        return df

    def per_lang(self, values: dict[str, int], name: str) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(pd.DataFrame({"lang": pd.Series(list(values), dtype=object), name: pd.Series(list(values.values()), dtype="int64")}),
                                                      f"lang string, {name} long"))

    def run(self) -> DataFrame:
        done = dict.fromkeys(self.total, 0)  # first words counted up to so often are grown
        floor: dict[str, int] = {}  # the score to reach, of languages that have enough phrases
        while True:
            left = self.words.join(self.per_lang(done, "done"), "lang").where("f > done")
            if floor:
                reach = {k: 1000 * self.total[k] // floor[k] if floor.get(k) else (1 << 62) for k in self.total}
                left = left.join(self.per_lang(reach, "reach"), "lang").where("f <= reach")
            rank = F.row_number().over(Window.partitionBy("lang").orderBy("f", "code"))
            upto = {r["lang"]: r["f"] for r in left.withColumn("i", rank).where(F.col("i") <= self.take).groupBy("lang").agg(F.max("f").alias("f")).collect()}
            if not upto:
                break
            roots = (self.words.join(self.per_lang(done, "done"), "lang").join(self.per_lang(upto, "upto"), "lang")
                         .where("f > done and f <= upto"))
            done |= upto
            self.take *= 8
            found = self.grow(roots)
            if found is not None:
                self.scored.append(self.score(found, floor))
                floor = self.floors()
        return self.answer(floor)

    def grow(self, roots: DataFrame) -> DataFrame | None:
        """(size, c1..c5, f) of all phrases counted often enough that begin
        with one of the words ``roots``, the words themselves included."""
        level = self.keep(roots.select(F.lit(1).alias("size"), *_codes(F.col("code")), "f"), "level")
        levels = [level]
        for size in range(2, LONGEST + 1):
            steps = []
            for block in _blocks(level, self.nodes):
                more = self.counts("right", block)
                steps.append(more.select(F.lit(size).alias("size"), *_codes(*(F.col(c) for c in _C[:size - 1]), F.col("beside")), F.col("n").alias("f")))
            if not steps:
                break
            level = _union(steps)
            levels.append(level)
        return _union(levels) if len(levels) > 1 else None

    def score(self, found: DataFrame, floor: dict[str, int]) -> DataFrame:
        """Surviving phrases of a round that can reach the floor, with their
        lowest cut."""
        lang = self.words.select(F.col("code").alias("c1"), "lang")
        # a longer phrase as frequent contains one longer by a word as frequent: behind the phrase ...
        grown = found.where("size > 2").select(*_codes_of_prefix(), F.col("f").alias("longer")).groupBy(*_C).agg(F.max("longer").alias("longer"))
        cands = (found.where("size > 1").join(grown, _C, "left").where("longer is null or longer < f").drop("longer")
                      .join(small_or_plain(lang), "c1").join(self.per_lang(self.total, "n"), "lang"))
        last = F.coalesce(*(F.when(F.col("size") == i, F.col(_C[i - 1])) for i in range(2, LONGEST + 1)))
        ends = self.words.select(F.col("code").alias("last"), F.col("f").alias("f_last"))
        cands = cands.withColumn("last", last).join(small_or_plain(ends), "last")
        if floor:  # the last word's count bounds the score as the first one's does
            cands = cands.join(self.per_lang({k: floor.get(k, 0) for k in self.total}, "floor"), "lang").where("n * 1000 div f_last >= floor").drop("floor")
        cands = self.keep(cands.drop("last", "f_last"), "candidates")
        # ... or before it, counted here with the rests of all cuts
        cut = F.explode(F.expr("sequence(1, size - 1)")).alias("k")
        every = F.array(*_C)
        part = lambda a, n: [F.coalesce(F.get(F.slice(every, a, n), F.lit(i)), F.lit(0).cast("long")).alias(c) for i, c in enumerate(_C)]
        cuts = cands.select("size", *_C, cut)
        rests = self.keep(cuts.where("size - k > 1").select(*part(F.col("k") + 1, F.col("size") - F.col("k"))).distinct(), "rests")
        before = cands.where(F.col("size") < LONGEST)
        parts = [self.counts("whole", b) for b in _blocks(rests, self.nodes)] + [self.counts("left", b) for b in _blocks(before, self.nodes)]
        single = self.words.select(*_codes(F.col("code")), "f")
        if parts:
            counts = _union(parts)
            longer = counts.where("kind = 'left'").groupBy(*_C).agg(F.max("n").alias("longer"))
            cands = cands.join(longer, _C, "left").where("longer is null or longer < f").drop("longer")
            known = single.unionByName(counts.where("kind = 'whole'").select(*_C, F.col("n").alias("f")))
        else:
            known = single
        firsts = found.select(*(F.col(c).alias(f"l{c}") for c in _C), F.col("f").alias("l"))
        rest = known.select(*(F.col(c).alias(f"r{c}") for c in _C), F.col("f").alias("r"))
        named = lambda side, cols: [c.alias(f"{side}{name}") for c, name in zip(cols, _C)]
        both = cands.select("lang", "size", *_C, F.col("f").alias("a"), "n", cut).select(
            "*", *named("l", part(F.lit(1), F.col("k"))), *named("r", part(F.col("k") + 1, F.col("size") - F.col("k"))))
        both = both.join(firsts, [f"l{c}" for c in _C]).join(rest, [f"r{c}" for c in _C])
        # up to 1e13 words of a language: 1000 a n below 1e30, l r below 1e26
        wide = lambda c: f"cast({c} as decimal(14,0))"
        value = F.expr(f"cast({wide('a')} * {wide('n')} * cast(1000 as decimal(4,0)) as decimal(38,0)) div cast({wide('l')} * {wide('r')} as decimal(38,0))")
        low = both.withColumn("value", value).groupBy("lang", "size", *_C, "a", "n").agg(F.min(F.struct("value", "k", "l", "r")).alias("low"), F.count(F.lit(1)).alias("cuts"))
        return self.keep(low.select("lang", "size", *_C, "a", "n", "low.l", "low.r", F.col("low.value").alias("score"), "cuts"), "scored")

    def floors(self) -> dict[str, int]:
        """The score of the last place, of languages with enough phrases."""
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
        top = _union(self.scored).select("lang", "score").withColumn("i", rank).where(F.col("i") <= self.best)
        return {r["lang"]: r["score"] for r in top.groupBy("lang").agg(F.max("i").alias("i"), F.min("score").alias("score")).where(F.col("i") == self.best).collect()}

    def answer(self, floor: dict[str, int]) -> DataFrame:
        schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        if not self.scored:
            return self.spark.createDataFrame([], schema)
        top = _union(self.scored).join(self.per_lang({k: floor.get(k, 0) for k in self.total}, "floor"), "lang").where("score >= floor")
        if top.where("cuts <> size - 1").limit(1).count():
            raise RuntimeError("a cut of a phrase was not counted")
        names = small_or_plain(self.words.select("code", "word"))
        for c in _C:
            top = top.join(names.withColumnsRenamed({"code": c, "word": f"w{c}"}), c, "left")
        top = top.withColumn("phrase", F.concat_ws(" ", *(f"w{c}" for c in _C)))
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
        top = top.withColumn("rank", place.cast("long")).where(F.col("rank") <= self.best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        return staged(top, "collocations")[0]


def _codes_of_prefix() -> list:
    """The phrase without its last word."""
    return [F.when(F.col("size") - 1 >= i, F.col(c)).otherwise(0).cast("long").alias(c) for i, c in enumerate(_C, 1)]


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, roots: int = ROOTS, nodes: int = NODES) -> DataFrame:
    """Each language's ``best`` phrases of 2 to 5 words counted ``least``
    times or more: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line
    ends, pieces into words at spaces and tabs; phrases stay within a piece. A
    phrase contained in a longer one as frequent is dropped. Order: score and
    count descending, phrase ascending by its bytes; ties on the last place
    are settled by it. Null texts count as empty, null languages as ``und``;
    repeated rows count each; other columns, whatever their names, are
    ignored; an empty table gives an empty result. ``docs`` is read twice and
    must give the same rows. ``roots`` and ``nodes``
    set the work of a round and change no result. Two words with one 64-bit
    code are an error."""
    ship(docs.sparkSession)
    miner = Miner(docs, least, best, roots, nodes)
    out = miner.run()
    if miner.codes:
        miner.codes.destroy()
    for path in miner.paths:
        drop_path(miner.spark, path)
    return out

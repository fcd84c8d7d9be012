import pickle
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from shelfwise.llm import collocations as K
from shelfwise.llm.oracles import collocations as sql
from shelfwise.llm.queries import op12_collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, best):
    """The ranked phrases by plain counting of every sequence."""
    seen, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for size in range(1, 6):
                seen[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in seen.items():
        cands = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        inside = {p[i:j] for p, n in cands.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if p[i:j] != p and f[p[i:j]] <= n}
        ranked = []
        for p in cands.keys() - inside:
            score, k = min((1000 * f[p] * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:best], 1)]
    return sorted(out)


def corpus(seed=12, n=100):
    rng = random.Random(seed)
    vocab = ["the", "of", "Big", "small", "ñandú", "été", "x1", "zeta", "om", "ra", "lo", "ki", "a\x0bb"] + [f"w{i}" for i in range(60)]
    fixed = ["new york city hall steps are closed", "once upon a time there was", "per se", "of the of the of the of"]
    rows = []
    for i in range(n):
        words = []
        while len(words) < rng.randint(0, 120):
            words += rng.choice(fixed).split() if rng.random() < 0.2 else [min(rng.choices(vocab, k=2), key=vocab.index)]
            if rng.random() < 0.1:
                words[-1] += rng.choice(".,;:!?\n\r")
        rows.append((i, rng.choice([" ", "  ", "\t", " "]).join(words), rng.choice(["en", "fr", None])))
    rows += [(1, "Hot Words Stay " * 300, "en")] * 3 + [(None, None, "de"), (None, "", None), (5, "lone", "it"), (6, ".,;  \t\n", "it")]
    return rows


@pytest.mark.parametrize("least, best, roots, nodes", [(3, 2000, 4000, 400_000), (5, 7, 4, 37)])
def test_phrases_equal_plain_counting(spark, docs_of, least, best, roots, nodes):
    rows = corpus()
    got = K.collocations(docs_of([(i, t, la) for i, t, la in rows]).repartition(5), least, best, roots, nodes)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute([(la, t) for _, t, la in rows], least, best)


def test_search_stops_early_and_keeps_ties(spark, docs_of, monkeypatch):
    """Rare first words settle the ranking; frequent ones are not grown. Many
    phrases share the last place's score."""
    rows = [(i, f"pa{i % 40} qa{i % 40}. " * 3 + "the of and the of and to the of and. " * 9, "en") for i in range(400)]
    grown = []
    monkeypatch.setattr(K.Miner, "grow", lambda self, roots, f=K.Miner.grow: (grown.append(roots.count()), f(self, roots))[1])
    got = K.collocations(docs_of([(i, t, la) for i, t, la in rows]), 10, 25, 40)
    assert sorted(map(tuple, got.collect())) == brute([(la, t) for _, t, la in rows], 10, 25)
    assert sum(grown) < 84  # 40 + 40 rare words, four frequent ones


def test_sql_equals_plain_counting(spark, docs_of):
    rows = corpus(7, 60)
    con = duckdb.connect()
    con.register("documents", docs_of([(i, t, la) for i, t, la in rows]).select("doc_id", "text", "lang").toPandas())
    assert sorted(con.execute(sql(5, 4, 30)).fetchall()) == brute([(la, t) for _, t, la in rows], 4, 30)


def test_counts_pass_64_bits(spark):
    """The score's product of counts near 1e13 is exact."""
    big = 9_000_000_000_019
    expr = ("cast(cast(a as decimal(14,0)) * cast(n as decimal(14,0)) * cast(1000 as decimal(4,0)) as decimal(38,0)) "
            "div cast(cast(l as decimal(14,0)) * cast(r as decimal(14,0)) as decimal(38,0))")
    df = spark.createDataFrame([(big, big - 7, big - 1, big - 3)], "a long, l long, r long, n long")
    assert df.selectExpr(f"{expr} AS x").first()["x"] == 1000 * big * (big - 3) // ((big - 7) * (big - 1))


def test_word_rows_and_trie():
    words, counts, codes, numbers = K.word_rows("en", ["A b  A.\tc", "", "B\r\nÉ"])
    assert words == ["a", "b", "c", "É"] and counts.tolist() == [2, 2, 1, 1]
    pieces = [[words[i - 1] for i in p] for p in _split(numbers.tolist())]
    assert pieces == [["a", "b", "a"], ["c"], ["b"], ["É"]]
    a, b = codes[0], codes[1]
    trie = K.Trie(whole=np.array([[a, b, 0, 0, 0], [b, a, 0, 0, 0]]), right=np.array([[a, 0, 0, 0, 0]]), left=np.array([[a, 0, 0, 0, 0]]))
    got = {(k, int(r), int(x)): int(c) for k, rs, xs, cs in trie.count(codes, numbers) for r, x, c in zip(rs, xs, cs)}
    assert got == {("whole", 0, 0): 1, ("whole", 1, 0): 1, ("right", 0, b): 1, ("left", 0, b): 1}


def _split(numbers):
    out = [[]]
    for i in numbers:
        if i:
            out[-1].append(i)
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def test_word_codes_are_sparks(spark):
    from pyspark.sql import functions as F
    words, _, codes, _ = K.word_rows("été", ["naïve words here"])
    df = spark.createDataFrame([("été", w) for w in words], "lang string, word string")
    assert [r[0] for r in df.select(F.xxhash64("lang", "word")).collect()] == codes.tolist()


def test_empty_tables(spark, docs_of):
    docs = docs_of([(1, "a b a b", "en")])
    assert K.collocations(docs.where("doc_id < 0")).collect() == [] and K.collocations(docs).columns == COLUMNS
    assert K.collocations(docs).collect() == []


def test_small_table_equals_sql(spark):
    from llm.conftest import SF
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, op12_collocations(spark, SF).collect())) == sorted(con.execute(sql()).fetchall())


def test_workers_hold_one_slim_trie(spark, monkeypatch):
    words = np.arange(1, 2001, dtype=np.int64) * 10**12
    phrases = np.stack([words[i:i + 1990] for i in range(5)], axis=1)
    trie = K.Trie(whole=phrases)
    assert (trie.spelled("whole", np.arange(len(phrases))) == phrases).all()
    assert len(pickle.dumps(trie.phrases)) < phrases.nbytes * 0.6
    made, live, plain = [], [], K.counted

    def counted(*args, **kinds):
        live.append(sum(not s._destroyed for s in made))
        df, shared = plain(*args, **kinds)
        shared._destroyed = False
        destroy = shared.destroy
        monkeypatch.setattr(shared, "destroy", lambda: (destroy(), setattr(shared, "_destroyed", True)))
        made.append(shared)
        return df, shared

    monkeypatch.setattr(K, "counted", counted)
    docs = spark.createDataFrame([(i, "red green blue grey " * 3, "en") for i in range(60)], "doc_id long, text string, lang string")
    assert K.collocations(docs, least=100, nodes=2).count() > 0
    assert len(live) > 2 and not any(live)


def _large(seeds, rare):
    """Texts of more than one portion's characters each, of few frequent words
    and rare ones that differ."""
    out = []
    for seed in seeds:
        rng = random.Random(seed)
        words = rng.choices(["a", "b", "c", "d"], k=K.PORTION // 2) + [f"r{seed}x{i}" for i in range(rare)]
        rng.shuffle(words)
        out.append((seed, " ".join(words), "en"))
    return out


def test_pairs_are_summed_up_before_the_shuffle(spark, monkeypatch):
    """A pair is shuffled once a task, not once a portion, and no pair with a
    word counted too seldom is."""
    docs = spark.createDataFrame(_large(range(3), 5000), "doc_id long, text string, lang string").coalesce(1)
    shuffled, plain = [], type(docs).repartition

    def repartition(self, *cols):
        if {"row", "pair"} & set(cols):
            shuffled.append(self.count())
        return plain(self, *cols)

    monkeypatch.setattr(type(docs), "repartition", repartition)
    got = K.collocations(docs, least=100, best=3).collect()
    assert [r["rank"] for r in got] == [1, 2, 3]
    assert shuffled and max(shuffled) <= 4 ** 3 + 4 ** 4 + 4 ** 5  # words before phrases of 2 to 4


def test_texts_are_written_in_small_row_groups(spark, monkeypatch):
    """Readers' and writers' buffers hold a few portions, not a whole file."""
    import pyarrow.parquet as pq
    kept, plain = {}, K.Miner.keep

    def keep(self, df, name, *more, **named):
        kept[name] = plain(self, df, name, *more, **named)
        return kept[name]

    monkeypatch.setattr(K.Miner, "keep", keep)
    docs = spark.createDataFrame(_large(range(10), 0), "doc_id long, text string, lang string").coalesce(1)
    K.Miner(docs, 100, 3, 10, 100)
    (file,) = next(kept[name] for name in ("numbered", "coded") if name in kept).inputFiles()
    meta = pq.ParquetFile(file.removeprefix("file://")).metadata
    sizes = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert sum(sizes) > 19 << 20 and max(sizes) < 18 << 20


def test_phrases_are_written_in_few_files(spark, monkeypatch):
    """However many shuffle partitions there are."""
    files, plain = [], K.staged

    def staged(*args):
        df, path = plain(*args)
        files.append(len(df.inputFiles()))
        return df, path

    monkeypatch.setattr(K, "staged", staged)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame([(i, t, "en") for i, t, _ in corpus()], "doc_id long, text string, lang string").coalesce(1)
        assert K.collocations(docs, least=3).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 5 and max(files) <= 2

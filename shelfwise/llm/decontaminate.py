"""Benchmark decontamination by SimHash of item-sized windows.

For every benchmark item, windows of the item's own length slide over the
documents. A window's 64-bit SimHash (over its 5-word shingles) is looked up
in a multi-index: eight blocks of eight bits, the items listed under every
block value within the block radius, so no fingerprint within the whole radius
can be missed. Candidates are verified by the exact weighted-shingle
similarity (shingle counts: sum of minima over sum of maxima).

Fingerprinting every window of every length would be thousands of hashes per
word. Windows that cannot reach the similarity are skipped by an exact bound:
a window similar by t shares at least t / (1 + t) of both shingle totals with
the item, and moving its start to its first shared shingle only helps. So the
windows are those that start at a shared shingle and hold enough of them.
Equal windows of many documents are fingerprinted and verified once.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import small_or_plain, stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: bit radius of the multi-index. Similarity 0.8 is a cosine of 0.89, about 9.6 expected differing bits (deviation 2.9)
RADIUS = 22
BLOCKS, BLOCK_BITS = 8, 8
#: benchmark shingles broadcast in one pass; more are taken in several passes
PASS_SHINGLES = 500_000
_LANES = 0x0000000100000001


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _shingle(hashes: Column, pos: Column, first: Column, k: int) -> Column:
    return F.xxhash64(first, *[F.get(hashes, pos + i) for i in range(1, k)])


def shingles(df: DataFrame, hashes: str, k: int, *keep: str) -> DataFrame:
    """One row per k-word shingle of the word-hash array ``hashes``: the kept
    columns, pos, sh. The array itself stays usable in ``keep`` without being
    copied, as all of it runs in one generated stage."""
    e = df.select(*dict.fromkeys([*keep, hashes]), F.posexplode(hashes).alias("pos", "first"))
    e = e.where(F.col("pos") <= F.size(hashes) - k)
    return e.select(*keep, "pos", _shingle(F.col(hashes), F.col("pos"), F.col("first"), k).alias("sh"))


def _fingerprints(sh: DataFrame, *keys: str) -> DataFrame:
    """SimHash per key from shingle rows (column ``sh``): 32 sums with two
    32-bit lanes hold the 64 bit counts; a bit is 1 if set in over half."""
    lanes = [F.sum(F.shiftrightunsigned("sh", b).bitwiseAND(F.lit(_LANES))).alias(f"s{b}") for b in range(32)]
    g = sh.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), *lanes)
    bits = []
    for b in range(32):
        for lane in (0, 32):
            n = F.shiftrightunsigned(f"s{b}", lane).bitwiseAND(F.lit(0xFFFFFFFF))
            one = 1 << (b + lane)
            bits.append(F.when(n * 2 > F.col("m"), F.lit(one - (1 << 64) if one >= 1 << 63 else one)).otherwise(F.lit(0).cast("long")))
    return g.select(*keys, "m", reduce(lambda x, y: x.bitwiseOR(y), bits).alias("fp"))


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _flips(radius: int) -> list[int]:
    each = BLOCK_BITS
    masks = [0] + [1 << i for i in range(each)]
    if radius >= 2:
        masks += [1 << i | 1 << j for i in range(each) for j in range(i)]
    if radius >= 3:
        raise ValueError("radius needs more blocks")
    return masks


def _near(items: DataFrame, contents: DataFrame, radius: int) -> DataFrame:
    """(content, item_id, hamming) of all windows and items of equal length
    whose fingerprints differ in at most ``radius`` bits."""
    masks = F.array(*[F.lit(x).cast("long") for x in _flips(radius // BLOCKS)])
    listed = items.select("item_id", "n", F.col("fp").alias("item_fp"), F.posexplode(F.array(*[_block(F.col("fp"), i) for i in range(BLOCKS)])).alias("block", "own"))
    listed = listed.select("item_id", "n", "item_fp", "block", F.explode(F.transform(masks, lambda x: F.col("own").bitwiseXOR(x))).alias("value"))
    probes = contents.select("content", "n", "fp", F.posexplode(F.array(*[_block(F.col("fp"), i) for i in range(BLOCKS)])).alias("block", "value"))
    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    return (probes.join(listed, ["n", "block", "value"]).withColumn("hamming", hamming).where(F.col("hamming") <= radius)
                  .groupBy("content", "item_id").agg(F.min("hamming").alias("hamming")))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
            shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contaminated documents: one row per (doc_id, text_hash, item_id) with
    the best window's start_word, n_words, similarity and hamming.

    ``benchmark``: item_id, text. Items of fewer than ``shingle_words`` words
    count as one shingle of all their words; items without words (null, empty)
    match nothing. Windows at a document's end may be shorter than the item.
    Null and empty documents match nothing; null ids are kept (null) and told
    apart by text_hash; repeated rows give one row; items with the same id
    count as versions of it; other columns are ignored; empty tables give an
    empty result."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("wh")).distinct()
    items = stage(items.where("size(wh) > 0").withColumn("n", F.size("wh")).withColumn("version", F.xxhash64("wh"))
                       .withColumn("k", F.least("n", F.lit(shingle_words))), "bench-items")
    sizes = [r["k"] for r in items.groupBy("k").count().orderBy("k").collect()]  # at most ``shingle_words`` values
    if not sizes:
        return _empty(docs)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"),
                         word_hashes(F.col(text_col)).alias("wh"))
    found = None
    for k in sizes:
        mine = items.where(F.col("k") == k)
        got = _matches_of(source, mine, k, similarity, radius)
        found = got if found is None else found.unionByName(got)
    best = F.max(F.struct("similarity", (-F.col("hamming")).alias("nh"), (-F.col("start_word")).alias("ns"), "n_words")).alias("b")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", (-F.col("b.ns")).cast("long").alias("start_word"), F.col("b.n_words").cast("long").alias("n_words"),
        F.col("b.similarity").alias("similarity"), (-F.col("b.nh")).cast("int").alias("hamming"))


def _empty(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(
        [], "doc_id long, text_hash long, item_id long, start_word long, n_words long, similarity double, hamming int")


def _matches_of(source: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    share = similarity / (1.0 + similarity)
    item_sh = stage(shingles(items, "wh", k, "item_id", "version", "n").select("item_id", "version", "n", "sh"), "bench-shingles")
    size = item_sh.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).first()
    passes = -(-size["rows"] // PASS_SHINGLES)
    seeds = None
    for part in range(passes):
        side = item_sh.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == part) if passes > 1 else item_sh
        # at most about PASS_SHINGLES rows: a checked bound
        side = F.broadcast(side.select("sh", "item_id", "version", "n").distinct())
        hit = shingles(source, "wh", k, "doc_id", "text_hash", "wh").join(side, "sh")
        hit = hit.select("doc_id", "text_hash", "item_id", "version", "n", "pos", (F.size("wh") - F.col("pos")).alias("rest"),
                         F.slice("wh", F.col("pos") + 1, F.col("n")).alias("window"))
        seeds = hit if seeds is None else seeds.unionByName(hit)
    m = F.col("n") - (k - 1)
    own = F.least(m, F.col("rest") - (k - 1))
    # hits within the window's m positions: positions scaled by m, a frame just short of 1
    hits = F.expr("count(1) over (partition by doc_id, text_hash, item_id, version order by place "
                  f"range between current row and {1.0 - 0.5 / max(1, size['n'])!r}D following)")
    held = (seeds.withColumn("place", F.col("pos") / m.cast("double")).withColumn("hits", hits)
                 .where(F.col("hits") >= F.lit(share) * (m + own) - 1e-9))
    held = stage(held.select("doc_id", "text_hash", "pos", F.col("n").alias("n"), F.struct(F.xxhash64("window").alias("h1"), F.hash("window").alias("h2"), F.size("window").alias("words")).alias("content"), "window")
                     .dropDuplicates(["doc_id", "text_hash", "pos", "n"]), "windows")
    contents = stage(held.groupBy("content", "n").agg(F.first("window").alias("window")), "contents")
    parts = shingles(contents, "window", k, "content", "n")
    prints = _fingerprints(parts, "content", "n")
    item_prints = _fingerprints(item_sh, "item_id", "version", "n").withColumn("item_id", F.struct("item_id", "version"))
    near = stage(_near(item_prints, prints, radius), "near")
    counts = parts.groupBy("content", "n", "sh").agg(F.count(F.lit(1)).alias("c"))
    item_counts = item_sh.groupBy(F.struct("item_id", "version").alias("item_id"), "sh").agg(F.count(F.lit(1)).alias("ci"))
    totals = item_prints.select("item_id", "n", F.col("m").alias("mi"))
    pairs = near.join(totals, "item_id")
    common = (pairs.join(counts, ["content", "n"]).join(item_counts, ["item_id", "sh"], "left")
                   .groupBy("content", "n", "item_id", "mi", "hamming")
                   .agg(F.sum(F.least("c", F.coalesce("ci", F.lit(0)))).alias("inter"), F.sum("c").alias("mw")))
    sim = common.withColumn("similarity", F.col("inter") / (F.col("mw") + F.col("mi") - F.col("inter")))
    sure = stage(sim.where(F.col("similarity") >= similarity - 1e-12)
                    .select("content", "n", F.col("item_id.item_id").alias("item_id"), "similarity", "hamming"), "sure")
    return held.select("doc_id", "text_hash", "pos", "n", "content").join(sure, ["content", "n"]).select(
        "doc_id", "text_hash", "item_id", F.col("pos").alias("start_word"), F.col("content.words").alias("n_words"), "similarity", "hamming")


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` (all columns) without contaminated rows."""
    cols = docs.columns
    bad = stage(matches(docs, benchmark, **how).select(F.col("doc_id").alias("x_id"), F.col("text_hash").alias("x_hash")).distinct(), "contaminated")
    d = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    ident, text = d[f"c{cols.index('doc_id')}"], d[f"c{cols.index('text')}"]
    bad = small_or_plain(bad)
    on = ident.cast("long").eqNullSafe(bad["x_id"]) & (F.xxhash64(F.coalesce(text, F.lit(""))) == bad["x_hash"])
    return d.join(bad, on, "left_anti").toDF(*cols)

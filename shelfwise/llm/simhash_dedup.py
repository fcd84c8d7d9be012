"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 two-bit segments; its embedding is the
vector of segment popcounts (0, 1 or 2 each). Flipping one bit changes one
popcount by one, so the Manhattan distance of two embeddings never exceeds the
Hamming distance of the fingerprints: it is a lower bound that loses nothing.

The range join "Manhattan distance at most 3" runs on a grid. The embedding is
held in thermometer form (the bits of each segment sorted), where Manhattan
distance is the bit count of an XOR. Of the two 16-dimensional halves at least
one is at distance 0 or 1 when the whole is at most 3, so each fingerprint is
dealt to its own cell in either half and probes that cell and the cells one
step up (a pair one step apart is met once, from its lower end). Candidates
pass the whole Manhattan bound, then the exact bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfwise.llm.common import connected_components, ship, small_or_plain, stage

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_LOW = 0x5555555555555555
_BLOCK = 1 << 16
#: bits of each byte value, lowest first
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a whole text: bit i is 1 if it is set in over
    half of the XXH64 hashes (seed 42) of its k-word shingles, repeats
    included. Words are runs of non-white-space after lower-casing A-Z. Fewer
    words than k: one shingle of them all; none (or a null text): zero."""
    if not text:
        return 0
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < k:
        w = [b" ".join(w)]
        shingles = iter(w)
        n = 1
    else:
        n = len(w) - k + 1
        shingles = map(b" ".join, zip(*(w[i:] for i in range(k))))
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        octets = hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8)
        if len(octets) < 512:
            ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
        else:
            for j in range(8):
                ones[8 * j:8 * j + 8] += np.bincount(octets[:, j], minlength=256) @ _BYTE_BITS
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def with_fingerprints(df: DataFrame, text_col: str = "text", name: str = "fp",
                      shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with a long column ``name``: the fingerprint of each whole text,
    one Arrow batch at a time. A column called ``name`` is replaced."""
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != name]
    schema = StructType([*(df.schema[c] for c in keep), StructField(name, LongType())])
    out = df.select(*keep, F.col(text_col).alias("__fp_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle_words) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], names=[*keep, name])

    return out.mapInArrow(run, schema)


def embedding(fp: Column) -> Column:
    """Segment popcounts in thermometer form: each two-bit segment sorted."""
    low = F.lit(_LOW)
    high_bit = F.shiftrightunsigned(fp, 1)
    return ((fp.bitwiseOR(high_bit)).bitwiseAND(low)).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(high_bit).bitwiseAND(low), 1))


def _half(emb: Column, h: int) -> Column:
    return F.shiftrightunsigned(emb, 32) if h == 0 else emb.bitwiseAND(F.lit(0xFFFFFFFF))


def _steps_up(cell: Column) -> Column:
    """The cells one step up from a half's cell (16 segments of two bits)."""
    out = []
    for i in range(16):
        lo, hi = 1 << (2 * i), 2 << (2 * i)
        out.append(F.when(cell.bitwiseAND(F.lit(lo)) == 0, cell.bitwiseOR(F.lit(lo)))
                    .when(cell.bitwiseAND(F.lit(hi)) == 0, cell.bitwiseOR(F.lit(hi))))
    return F.array_compact(F.array(*out))


def _probes(emb: Column, h: int) -> Column:
    cell = _half(emb, h)
    return F.transform(F.concat(F.array(cell), _steps_up(cell)),
                       lambda c, i: F.struct(F.lit(h).alias("half"), c.alias("cell"), (i > 0).alias("up")))


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of different fingerprints of ``nodes`` (distinct column
    ``fp``) at ``max_bits`` (at most 3) or fewer differing bits. Pairs that
    the cells' leaders already connect are left out: the result has the same
    connected components as the set of all pairs, not all pairs."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves of radius 1 cover distances up to 3")
    cells = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(h).alias("half"), _half(embedding(F.col("fp")), h).alias("cell")) for h in (0, 1)])).alias("k")
    ).select("fp", "k.half", "k.cell")
    # stars: every fingerprint with the smallest one of its cell
    lead = cells.groupBy("half", "cell").agg(F.min("fp").alias("lead"))
    stars = (cells.join(lead, ["half", "cell"]).where("fp <> lead")
                  .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("lead"))) <= max_bits)
                  .select(F.col("fp").alias("a"), F.col("lead").alias("b")).distinct())
    stars = stage(stars, "stars")
    first = connected_components(stars)
    grouped = stage(nodes.join(first.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", F.coalesce("root", "fp").alias("grp")), "grouped")
    g = grouped.select("fp", "grp", embedding(F.col("fp")).alias("e"))
    base = g.select("fp", "grp", F.explode(F.array(*[
        F.struct(F.lit(h).alias("half"), _half(F.col("e"), h).alias("cell")) for h in (0, 1)])).alias("k")
    ).select(F.col("fp").alias("b"), F.col("grp").alias("gb"), "k.half", "k.cell")
    probe = g.select("fp", "grp", F.explode(F.concat(_probes(F.col("e"), 0), _probes(F.col("e"), 1))).alias("k")).select(F.col("fp").alias("a"), F.col("grp").alias("ga"), "k.half", "k.cell", "k.up")
    ea, eb = embedding(F.col("a")), embedding(F.col("b"))
    pairs = (probe.join(base, ["half", "cell"])
                  .where((F.col("ga") != F.col("gb")) & (F.col("up") | (F.col("a") < F.col("b"))))
                  .where(F.bit_count(ea.bitwiseXOR(eb)) <= max_bits)
                  .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
                  .select("a", "b"))
    return stars.unionByName(pairs)


def components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for every distinct fingerprint in column ``fp`` of ``fps``:
    root is the smallest fingerprint reachable by links of ``max_bits``."""
    nodes = stage(fps.groupBy("fp").count().select("fp"), "fps")
    roots = connected_components(links(nodes, max_bits))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``id_col``, fingerprint (16 hex digits),
    component_id (smallest id reachable by links, the row itself included).

    Exact copies share a fingerprint and count once in the search. Null and
    empty texts have fingerprint zero and link like any other; rows with a
    null id take part, and a component of null ids only has a null
    component_id; repeated rows are returned as often as given; an empty table
    gives an empty result; other columns are ignored.
    """
    fps = stage(with_fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                                  "text", "fp", shingle_words).select("doc_id", "fp"), "fingerprints")
    comp = components(fps, max_bits)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    ids = stage(comp.join(least, "fp"), "components")
    names = ids.join(ids.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return fps.join(names, "fp").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all its columns) that stay when one row of each
    group of near duplicates is kept: the one with the smallest id, a repeated
    row once. Rows are told apart by a row number written with them, so null
    and repeated ids are safe."""
    cols = docs.columns
    tmp = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    text, ident = f"c{cols.index(text_col)}", f"c{cols.index(id_col)}"
    marked = stage(with_fingerprints(tmp, text, "fp", shingle_words)
                   .withColumn("row", F.monotonically_increasing_id()), "marked")
    comp = components(marked.select("fp"), max_bits)
    best = (marked.select("fp", "row", F.col(ident).alias("id")).groupBy("fp")
                  .agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "row")).alias("best")))
    best = comp.join(best, "fp")
    stay = best.groupBy("root").agg(F.min("best").alias("best"))
    stay = best.select("fp", "root").join(stay, "root").select("fp", F.col("best.row").alias("stays"))
    gone = stage(marked.select("fp", "row").join(stay, "fp").where("row <> stays").select(F.col("row").alias("gone")), "gone")
    out = marked.join(small_or_plain(gone), F.col("row") == F.col("gone"), "left_anti")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])

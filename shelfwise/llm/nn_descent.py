"""Embedding near-duplicates by NN-descent.

Equal vectors are one node. A neighbour graph with short lists starts from
random hyperplane codes (every node compared with the next few in the sorted
order of several codes) and is refined by neighbours-of-neighbours joins: the
forward and reverse neighbours of a node are compared with each other, and each
list keeps its best. Refinement works on one-byte coordinates; what it finds is
verified in double precision.

A list is saturated when its last entry is still a link: there may be more
links than it holds. Saturated lists are enlarged to everything reachable
through saturated nodes, and such dense regions are compared completely, in
blocks of bounded size. Full lists can hide links from one region to another,
so two regions are compared as well unless the angle between their pivots,
less both radii, rules a link out. Recall is audited by brute force for a
hashed sample of nodes and of nodes whose best entry is near the threshold, and
by planted copies of sampled vectors, which are searched for with the others
and link with nothing; while it is short, the search is repeated with more
codes, and if the last try is short an error is raised.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import connected_components, ship, small_or_plain, stage

THRESHOLD = 0.9
#: list length, next nodes kept in a code's order, least codes, bits of a code
LIST, AHEAD, CODES, BITS = 16, 3, 20, 30
#: next nodes compared in a code's order: past AHEAD only those that may be links are kept
WIDE = 32
#: share of the links at the threshold that the codes alone may miss
MISS = 0.004
#: slack of one-byte similarities around the threshold
SLACK = 0.02
#: a bound that settled refinement doesn't meet
ROUNDS = 30
#: a round that changes a smaller share of the list entries is the last
SETTLED = 0.01
BLOCK = 1024
#: region pivots compared in a task, and pivots up to which their table is broadcast
PIVOTS, PIVOT_ROWS = 4096, 20_000
AUDIT, MIN_RECALL, TRIES = 512, 0.99, 3
#: distance to the threshold at which a node's best entry makes it worth an audit
NEAR = 0.05


def valid(v: Column) -> Column:
    """Neither null nor empty, no null or non-finite component, not all zero.
    Vectors of any magnitude are scaled before they are squared."""
    endless = F.lit(float("inf"))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < endless))
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in col])


def _unit(m: np.ndarray) -> np.ndarray:
    # by a power of two (exact), to about 1; components too small to count beside the largest become 0
    m = np.ldexp(m, -np.frexp(np.abs(m).max(1, keepdims=True))[1])
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _bytes(col: pd.Series) -> np.ndarray:
    """Unit rows from one-byte coordinates (all of one length)."""
    m = np.frombuffer(b"".join(col), dtype=np.int8).reshape(len(col), -1).astype(np.float32)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """One row per different valid vector (rows: id, v, ok, k1, k2): its key, node, least (smallest id), mult
    (rows), dim, vec (unit length), q (one byte a coordinate)."""
    ship(vectors.sparkSession)
    groups = vectors.where("ok").groupBy("k1", "k2").agg(F.first("v").alias("v"), F.min("id").alias("least"), F.count(F.lit(1)).alias("mult"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, part in f.groupby(f["v"].map(len)):
                unit = _unit(_matrix(part["v"]))
                q = np.rint(unit * (127.0 / np.abs(unit).max(1, keepdims=True))).astype(np.int8)
                yield pd.DataFrame({"k1": part["k1"], "k2": part["k2"], "least": part["least"], "mult": part["mult"], "dim": int(dim), "vec": list(unit),
                                    "q": [x.tobytes() for x in q]})

    made = groups.mapInPandas(run, "k1 long, k2 long, least long, mult long, dim int, vec array<double>, q binary")
    return stage(made.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _streamed(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with equal ``key`` from sorted batches."""
    held = None
    for f in frames:
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        if len(f):
            last = f[key].iloc[-1]
            done = f[key] != last
            if done.any():
                yield f[done]
            held = f[~done]
    if held is not None and len(held):
        yield held


def codes_for(n: int, threshold: float = THRESHOLD) -> int:
    """Codes for ``n`` nodes: two ends of a link at the threshold are close in
    a code's order if its leading bits, about log2(n / WIDE), are equal."""
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    hit = same ** max(0.0, math.log2(max(n, 1) / WIDE) - 0.5)
    return CODES if hit >= 1 else max(CODES, math.ceil(math.log(MISS) / math.log1p(-hit)))


def planted_of(nodes: DataFrame, threshold: float, sample: int) -> DataFrame:
    """Copies of a hashed sample of nodes, turned to a cosine a little over
    the threshold. As nodes, with mult 0; the copy of node n is -1 - n."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for _, part in f.groupby("dim"):
                unit = _matrix(part["vec"])
                turn = np.stack([np.random.default_rng([17, int(k) & (1 << 62) - 1]).standard_normal(unit.shape[1]) for k in part["k1"]])
                turn = _unit(turn - (turn * unit).sum(1, keepdims=True) * unit)
                cos = threshold + (1 - threshold) * (0.05 + 0.45 * (part["k2"].to_numpy() % 1000) / 1000)[:, None]
                vec = cos * unit + np.sqrt(1 - cos * cos) * turn
                q = np.rint(vec * (127.0 / np.abs(vec).max(1, keepdims=True))).astype(np.int8)
                yield part.assign(vec=list(vec), q=[x.tobytes() for x in q], node=-1 - part["node"], mult=0, least=None)[list(f.columns)]

    chosen = nodes.where("dim > 1").orderBy(F.xxhash64("node", F.lit(5)), "node").limit(sample)
    return stage(chosen.mapInPandas(run, nodes.schema), "planted")


def planted_found(planted: DataFrame, near: DataFrame, regions: DataFrame) -> tuple[int, int]:
    """(found, all) planted copies: with an entry of their source, or both in
    regions, which are compared completely."""
    asked = planted.select(F.col("node").alias("copy"), (-1 - F.col("node")).alias("source"))
    pairs = near.select(F.least("u", "v").alias("copy"), F.greatest("u", "v").alias("source"))
    inside = regions.select("node").distinct()
    both = asked.join(inside.withColumnRenamed("node", "copy"), "copy").join(inside.withColumnRenamed("node", "source"), "source").select("copy")
    return asked.join(pairs, ["copy", "source"], "left_semi").select("copy").unionByName(both).distinct().count(), asked.count()


def start_graph(nodes: DataFrame, codes: int, bits: int = BITS, ahead: int = AHEAD, seed: int = 11, keep: float = THRESHOLD - SLACK) -> DataFrame:
    """(u, v, sim) of nodes that are close in the order of a code: the next
    ``ahead``, and of the next WIDE those of ``keep`` or more. The order
    is dealt by range of (code number, dim, code, node), so a crowd with one
    code spreads over tasks."""
    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for f in frames:
            for dim, part in f.groupby("dim"):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((codes, int(dim), bits)).astype(np.float32)
                m = _bytes(part["q"])
                for t in range(codes):
                    yield pd.DataFrame({"t": t, "dim": int(dim), "code": (m @ planes[dim][t] > 0) @ weights, "node": part["node"], "q": part["q"]})

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            group = (f["t"] * (1 << 20) + f["dim"]).to_numpy()
            node, fresh = f["node"].to_numpy(), 0 if held is None else len(held)
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                m = _bytes(f["q"].iloc[at])
                for step in range(1, max(ahead, WIDE) + 1):
                    later = at[step:] >= fresh
                    a, b = np.flatnonzero(later), np.flatnonzero(later) + step
                    sim = np.einsum("ij,ij->i", m[a], m[b]).astype(np.float64)
                    if step > ahead:
                        a, b, sim = a[sim >= keep], b[sim >= keep], sim[sim >= keep]
                    if len(a):
                        yield pd.DataFrame({"u": node[at[a]], "v": node[at[b]], "sim": sim})
            held = f.iloc[-max(ahead, WIDE):]

    coded = nodes.select("node", "dim", "q").mapInPandas(encode, "t int, dim int, code long, node long, q binary")
    keys = ("t", "dim", "code", "node")
    return (coded.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .mapInPandas(compare, "u long, v long, sim double"))


def best_lists(pairs: DataFrame, size: int) -> DataFrame:
    """(u, v, sim): the ``size`` best neighbours of every node, either end of
    each pair; equal similarities by node."""
    both = pairs.select("u", "v", "sim").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"))
    one = both.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return one.withColumn("r", F.row_number().over(order)).where(F.col("r") <= size).drop("r")


def refine(lists: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """One neighbours-of-neighbours join: pairs among the forward and the best
    reverse neighbours of each node that beat the end of either's list."""
    last = lists.groupBy("u").agg(F.min("sim").alias("low"), F.count(F.lit(1)).alias("n"))
    last = last.select(F.col("u").alias("node"), F.when(F.col("n") < size, -2.0).otherwise(F.col("low")).alias("low"))
    back = Window.partitionBy("v").orderBy(F.desc("sim"), "u")
    reverse = lists.withColumn("r", F.row_number().over(back)).where(F.col("r") <= size)
    around = (lists.select(F.col("u").alias("hub"), F.col("v").alias("node"))
                   .unionByName(reverse.select(F.col("v").alias("hub"), F.col("u").alias("node"))).distinct())
    rows = around.join(nodes.select("node", "q"), "node").join(last, "node")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _streamed(frames, "hub"):
            hub = f["hub"].to_numpy()
            m, node, low = _bytes_by_len(f["q"]), f["node"].to_numpy(), f["low"].to_numpy()
            edges = np.flatnonzero(np.diff(hub)) + 1
            us, vs, sims = [], [], []
            for a, b in zip(np.r_[0, edges], np.r_[edges, len(hub)], strict=True):
                part = m[a:b]
                dots = part @ part.T
                i, j = np.triu_indices(b - a, 1)
                s = dots[i, j]
                better = s > np.minimum(low[a + i], low[a + j]) + 1e-6
                us.append(node[a + i[better]])
                vs.append(node[a + j[better]])
                sims.append(s[better].astype(np.float64))
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs), "sim": np.concatenate(sims)})

    return (rows.select("hub", "node", "q", "low").repartition("hub").sortWithinPartitions("hub", "node")
                .mapInPandas(compare, "u long, v long, sim double"))


def _bytes_by_len(col: pd.Series) -> np.ndarray:
    """Neighbours of one node have its length; hubs of several lengths in a
    batch are padded with zeros, which changes no product among equals."""
    width = max(map(len, col))
    return _bytes(col if min(map(len, col)) == width else col.map(lambda x: x.ljust(width, b"\0")))


def neighbour_graph(nodes: DataFrame, codes: int, size: int = LIST, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    lists = stage(best_lists(start_graph(nodes, codes, keep=threshold - SLACK), size), "lists")
    for _ in range(rounds):
        new = stage(best_lists(lists.unionByName(refine(lists, nodes, size)), size), "lists")
        entries = new.count()
        changed = new.join(lists, ["u", "v"], "left_anti").count()
        lists = new
        if changed <= SETTLED * entries:
            break
    return lists


def dense_links(nodes: DataFrame, regions: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Complete comparison inside each region (node, root), in blocks: a task
    gets two blocks at most. Returns (node, links, other): the rows linked to
    a node there, and a node it is connected with (its block pair's component)."""
    sizes = regions.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = regions.join(sizes, "root").join(nodes.select("node", "mult", "vec"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "mult", "vec")

    return (rows.groupBy("root", "i", "j")
                .applyInPandas(lambda f: _compare(f, threshold, f["i"].iloc[0] != f["j"].iloc[0]), "node long, links long, other long"))


def _compare(f: pd.DataFrame, threshold: float, across: bool) -> pd.DataFrame:
    """Rows (node, mult, vec, own) compared with each other, ``across``: only those of different ``own``."""
    f = f.sort_values("node", ignore_index=True)
    m, mult, own = _matrix(f["vec"]), f["mult"].to_numpy(), f["own"].to_numpy()
    near = m @ m.T >= threshold
    np.fill_diagonal(near, False)
    if across:
        near &= own[:, None] != own[None, :]
    label = np.arange(len(f))
    while True:  # smallest reachable row in this pair of blocks
        low = np.minimum(label, np.where(near, label[None, :], len(f)).min(1))
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    return pd.DataFrame({"node": f["node"], "links": near @ mult, "other": f["node"].to_numpy()[label]})


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)


def _angle(x: str, y: str) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(x, y))))


def region_pivots(rows: DataFrame) -> DataFrame:
    """(root, dim, pivot, radius) of regions (rows: root, vec): the direction
    of the sum and the largest angle to it."""
    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [(root, _matrix(part["vec"]).sum(0)) for root, part in f.groupby("root")]
            yield pd.DataFrame({"root": [r for r, _ in got], "v": [v for _, v in got]})

    sums = (rows.select("root", "vec").mapInPandas(partial, "root long, v array<double>")
                .select("root", F.posexplode("v").alias("at", "x")).groupBy("root", "at").agg(F.sum("x").alias("x"))
                .groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda e: e["x"]).alias("v")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # a sum of zero has no direction: a pivot of zeros is at a right angle to all, which the radius must not understate
    pivots = stage(sums.withColumn("norm", norm).select("root", F.size("v").alias("dim"), (F.col("norm") < 1e-9).alias("none"),
                                                        F.transform("v", lambda x: x / F.greatest("norm", F.lit(1e-9))).alias("pivot")), "pivots")
    radius = (rows.join(small_or_plain(pivots, PIVOT_ROWS), "root")
                  .groupBy("root").agg(F.max(F.when(F.col("none"), F.lit(math.pi)).otherwise(_angle("vec", "pivot"))).alias("radius")))
    return stage(pivots.join(radius, "root").select("root", "dim", "pivot", "radius"), "pivots")


def region_pairs(pivots: DataFrame, threshold: float, block: int = PIVOTS) -> DataFrame:
    """(ra, rb), ra < rb: the regions that may hold a link with each other, by
    the angle of their pivots and their radii."""
    blocks = max(1, -(-pivots.count() // block))
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-5
    rows = pivots.withColumn("own", F.pmod(F.xxhash64("root"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.select("dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "root", "pivot", "radius")

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("root", ignore_index=True)
        m, radius, own, root = _matrix(f["pivot"]), f["radius"].to_numpy(), f["own"].to_numpy(), f["root"].to_numpy()
        may = np.triu(np.arccos(np.clip(m @ m.T, -1.0, 1.0)) <= reach + radius[:, None] + radius[None, :], 1)
        if f["i"].iloc[0] != f["j"].iloc[0]:
            may &= own[:, None] != own[None, :]
        a, b = np.nonzero(may)
        return pd.DataFrame({"ra": root[a], "rb": root[b]})

    return rows.groupBy("dim", "i", "j").applyInPandas(compare, "ra long, rb long")


def cross_links(nodes: DataFrame, regions: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """As dense_links, for the links between two regions: every pair of
    regions that the pivots don't rule out, less the nodes that the other
    region's pivot and radius rule out, in pairs of blocks."""
    rows = stage(regions.join(nodes.select("node", "mult", "vec"), "node"), "members")
    pivots = region_pivots(rows)
    pairs = stage(region_pairs(pivots, threshold), "region-pairs")
    if pairs.isEmpty():
        return nodes.sparkSession.createDataFrame([], "node long, links long, other long")
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-5
    far = small_or_plain(pivots.select(F.col("root").alias("facing"), "pivot", "radius"), PIVOT_ROWS)
    sides = (pairs.select("ra", "rb", F.col("ra").alias("root"), F.col("rb").alias("facing"), F.lit(0).alias("own"))
                  .unionByName(pairs.select("ra", "rb", F.col("rb").alias("root"), F.col("ra").alias("facing"), F.lit(1).alias("own"))))
    rows = rows.join(sides, "root").join(far, "facing").where(_angle("vec", "pivot") <= F.col("radius") + F.lit(reach))
    rows = stage(rows.select("ra", "rb", "own", "node", "mult", "vec"), "facing")
    count = [F.ceil(F.sum((F.col("own") == side).cast("int")) / block).cast("int").alias(f"n{side}") for side in (0, 1)]
    rows = rows.join(rows.groupBy("ra", "rb").agg(*count).where("n0 > 0 and n1 > 0"), ["ra", "rb"])
    part = F.pmod(F.xxhash64("node"), F.when(F.col("own") == 0, F.col("n0")).otherwise(F.col("n1"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("own") == 0, F.col("n1")).otherwise(F.col("n0")) - 1))
    rows = rows.withColumn("part", part).withColumn("other", other)
    rows = rows.select("ra", "rb", F.when(F.col("own") == 0, F.col("part")).otherwise(F.col("other")).alias("i"),
                       F.when(F.col("own") == 0, F.col("other")).otherwise(F.col("part")).alias("j"), "own", "node", "mult", "vec")
    return rows.groupBy("ra", "rb", "i", "j").applyInPandas(lambda f: _compare(f, threshold, True), "node long, links long, other long")


def _links(nodes: DataFrame, lists: DataFrame, size: int, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, links, root) of every node with a link; the near entries and the
    regions. Entries of planted copies, which ``nodes`` lacks, make no links."""
    near = lists.where(F.col("sim") >= threshold - SLACK)
    full = near.groupBy("u").count().where(F.col("count") >= size).select(F.col("u").alias("full"))
    # what is reachable through saturated nodes, with the nodes at its rim
    through = near.join(full, F.col("u") == F.col("full")).select(F.col("u").alias("a"), F.col("v").alias("b"))
    back = near.join(full, F.col("v") == F.col("full")).select(F.col("v").alias("a"), F.col("u").alias("b"))
    regions = stage(connected_components(through.unionByName(back)), "regions")
    dense = stage(dense_links(nodes, regions, threshold).unionByName(cross_links(nodes, regions, threshold)), "dense")
    r1 = regions.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    r2 = regions.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    thin = near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    # links of two region members are counted there, of one region or of two
    thin = thin.join(r1, "u", "left").join(r2, "v", "left").where("ru is null or rv is null").select("u", "v")
    a = nodes.select(F.col("node").alias("u"), F.col("vec").alias("x"), F.col("mult").alias("mu"))
    b = nodes.select(F.col("node").alias("v"), F.col("vec").alias("y"), F.col("mult").alias("mv"))
    thin = stage(thin.join(a, "u").join(b, "v").where((F.size("x") == F.size("y")) & (_dot("x", "y") >= threshold)).select("u", "v", "mu", "mv"), "thin")
    edges = thin.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(dense.select(F.col("node").alias("a"), F.col("other").alias("b")))
    roots = connected_components(edges)
    links = (thin.select(F.col("u").alias("node"), F.col("mv").alias("links"))
                 .unionByName(thin.select(F.col("v").alias("node"), F.col("mu").alias("links")))
                 .unionByName(dense.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links")))
    return stage(links.join(roots, "node", "left"), "links"), near, regions


def audit(nodes: DataFrame, links: DataFrame, threshold: float = THRESHOLD, sample: int = AUDIT,
          lists: DataFrame | None = None) -> tuple[int, int]:
    """(found, true) links of a hashed sample of nodes, and of one of the
    nodes whose best entry in ``lists`` is near the threshold, by brute force
    against every node. The samples (``sample`` vectors each) are the bounded
    broadcast."""
    pick = lambda rows: rows.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(sample).select("node", "vec").collect()
    chosen = pick(nodes)
    if lists is not None:
        best = lists.where("u >= 0 and v >= 0").groupBy(F.col("u").alias("node")).agg(F.max("sim").alias("best"))
        chosen += pick(nodes.join(best.where(F.abs(F.col("best") - threshold) <= NEAR), "node"))
        chosen = list({r["node"]: r for r in chosen}.values())
    if not chosen:
        return 0, 0
    spark = nodes.sparkSession
    held = spark.sparkContext.broadcast([(r["node"], np.array(r["vec"])) for r in chosen])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, part in f.groupby(f["vec"].map(len)):
                asked = [(n, v) for n, v in held.value if len(v) == dim]
                if asked:
                    near = np.stack([v for _, v in asked]) @ _matrix(part["vec"]).T >= threshold
                    near &= np.array([n for n, _ in asked])[:, None] != part["node"].to_numpy()[None, :]
                    yield pd.DataFrame({"node": [n for n, _ in asked], "true": near @ part["mult"].to_numpy()})

    true = nodes.select("node", "vec", "mult").mapInPandas(count, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    r = true.join(links, "node", "left").agg(F.sum(F.least("true", F.coalesce("links", F.lit(0)))).alias("found"), F.sum("true").alias("true")).first()
    return int(r["found"] or 0), int(r["true"] or 0)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                    size: int = LIST, codes: int = CODES, min_recall: float = MIN_RECALL) -> DataFrame:
    """One row per input row: ``id_col``, n_links (other rows linked directly,
    cosine of ``threshold`` or more), component_id (smallest id reachable),
    kept (it is its component's smallest id).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and are their own components; vectors of different
    lengths don't link. Rows with equal vectors link with each other; repeated
    rows count as rows; null ids take part but name no component unless all
    its ids are null. Other columns are ignored; an empty table gives an empty
    result."""
    # adding zero makes -0.0 and 0.0 one value; equal vectors meet by a 128-bit key
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"),
                             F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"))
    rows = rows.select("id", "v", valid(F.col("v")).alias("ok"), F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(7), "v").alias("k2"))
    nodes = nodes_of(rows)
    planted = planted_of(nodes, threshold, AUDIT)
    both, n = nodes.unionByName(planted), nodes.count()
    start = max(codes, codes_for(n, threshold))
    for attempt in range(TRIES):
        lists = neighbour_graph(both, start << attempt, size, threshold=threshold)
        links, near, regions = _links(nodes, lists, size, threshold)
        found, true = audit(nodes, links, threshold, lists=lists)
        seen, asked = planted_found(planted, near, regions)
        # no link to find in a sample of the nodes says nothing
        if (true or asked or n <= AUDIT) and found >= min_recall * true and seen >= min_recall * asked:
            break
    else:
        raise RuntimeError(f"near duplicates: {found} of {true} audited links and {seen} of {asked} planted ones found, under {min_recall}")
    named = nodes.join(links, "node", "left").select(
        "least", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"), "node")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("node", "n_links", "component_id")
    keyed = nodes.select("node", F.col("k1").alias("n1"), F.col("k2").alias("n2"))
    found_node = rows.join(keyed, F.col("ok") & (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")), "left")
    out = found_node.select("id", "node").join(named, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))

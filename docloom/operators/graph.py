"""Graphs: connected components, communities by modularity, and their rendering."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions.numbering import numbered
from docloom.plans.checkpoints import kept
from docloom.plans.registry import query, table

#: Links whose components are found together in a task.
CHUNK = 1_000_000
#: A move or a level that adds no more than this to the modularity is none.
LEAST_GAIN = 1e-7
#: Two rounds running that add less than this share of what the level has gained end the level: the next one goes on faster.
LEAST_SHARE = 1e-3
#: Slots of moves for each doubling of the gain per degree, the parts that each is dealt into, and the slot before all others.
SLOTS, SPREAD, FIRST = 4, 64, -(1 << 40)


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of links and the smallest one that each can reach over them."""
    v, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(v))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for end in (x, y):
            np.minimum.at(new, root[end], low)  # the old root hears of it as well
            np.minimum.at(new, end, low)
        while not np.array_equal(up := new[new], new):
            new = up
        if np.array_equal(new, root):
            return v, v[root]
        root = new


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, c, piece): components of links (a, b), a piece of about CHUNK links at a time."""
    task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

    def found() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        v, c = _roots(t.column("a").to_numpy(), t.column("b").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(v), pa.array(c), pa.array(np.full(len(v), (task << 32) + n))], names=["v", "c", "piece"])

    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= CHUNK:
            yield found()
            n, held, size = n + 1, [], 0
    if size:
        yield found()


def connected(links: DataFrame, near: Sequence[str] = ()) -> DataFrame:
    """links (a, b), long -> (v, c): the smallest vertex that can be reached from v. Loops, repeated links and nulls are harmless.

    near: further columns of links; those that agree on them are brought together. First components are found within pieces of links of bounded size; what no other
    piece touches is settled. Only the rest goes through rounds over all of it, with one link a vertex and piece."""
    pairs = links.filter("a IS NOT NULL AND b IS NOT NULL")
    if near:
        pairs = pairs.repartition(*near).sortWithinPartitions(*near)
    stars = kept(pairs.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(_stars, "v long, c long, piece long"))
    shared = stars.groupBy("v").agg(F.min("piece").alias("low"), F.max("piece").alias("high")).filter("low < high").select("v")
    open_ = kept(stars.join(shared, "v", "left_semi").select("piece", "c").distinct())
    if not open_.limit(1).count():
        return stars.select("v", "c")
    settled = stars.join(open_, ["piece", "c"], "left_anti").select("v", "c")
    rest = stars.join(open_, ["piece", "c"], "left_semi")
    return settled.unionByName(_connected(rest.select(F.col("v").alias("a"), F.col("c").alias("b"))))


def _connected(pairs: DataFrame) -> DataFrame:
    """Rounds of joins: vertices hang themselves below the smallest neighbour's label, and labels are replaced by their own labels, so that a path of n vertices
    takes about log n rounds."""
    both = kept(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = kept(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("c")))
    while True:
        around = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        seen = labels.join(around, "v").select("v", "c", F.least("c", "m").alias("m"))
        hung = seen.select("v", "m").union(seen.select(F.col("c").alias("v"), "m")).groupBy("v").agg(F.min("m").alias("m"))  # the old root hears of it as well
        up = hung.select(F.col("v").alias("m"), F.col("m").alias("up"))
        new = hung.join(up, "m", "left").select("v", F.coalesce("up", "m").alias("c"))
        told = kept(new.join(labels.select("v", F.col("c").alias("old")), "v").select("v", "c", (F.col("c") < F.col("old")).alias("moved")))
        labels = told.select("v", "c")
        if not told.filter("moved").limit(1).count():
            return labels


def coin(name: int | Column, turn: int):
    """Heads or tails, the same in Python for an integer as in Spark for a column. The product is there since a checksum alone is linear: two names would agree in all turns."""
    if isinstance(name, int):
        return zlib.crc32(f"{turn}:{name}".encode()) * 40503 >> 20 & 1
    return F.shiftright(F.crc32(F.concat(F.lit(f"{turn}:"), name.cast("string")).cast("binary")) * 40503, 20).bitwiseAND(F.lit(1))


class Level:
    """A weighted graph with a community for each vertex. edges (a, b, w): both directions, and a loop once with the weight of its two ends."""

    def __init__(self, edges: DataFrame, resolution: float):
        self.edges, self.resolution = kept(edges), resolution
        self.labels = kept(self.edges.groupBy(F.col("a").alias("v")).agg(F.sum("w").alias("k")).withColumn("c", F.col("v")))
        s = self.edges.agg(F.sum("w").alias("all"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w"))).alias("loops")).first()
        self.total, self.loops = s["all"] or 0.0, s["loops"] or 0.0

    def look(self, labels: DataFrame) -> tuple[DataFrame, float, Row | None]:
        """(v, k, c, d, gain) for the communities d around v that v alone would add to the modularity by moving to, the modularity as it is, and the best move."""
        m, r = self.total, self.resolution
        sums = labels.groupBy("c").agg(F.sum("k").alias("sum"))
        ends = self.edges.filter("a <> b").join(labels.select(F.col("v").alias("a"), "c"), "a").join(labels.select(F.col("v").alias("b"), F.col("c").alias("d")), "b")
        own = ends.filter("c = d").groupBy(F.col("a").alias("v")).agg(F.sum("w").alias("inner"))
        at = kept(labels.join(own, "v", "left").join(sums, "c").select("v", "k", "c", F.coalesce("inner", F.lit(0.0)).alias("inner"), "sum"))
        near = ends.filter("c <> d").groupBy(F.col("a").alias("v"), "d").agg(F.sum("w").alias("w")).join(at.withColumnRenamed("sum", "left"), "v").join(sums.withColumnRenamed("c", "d"), "d")
        gain = (F.col("w") - F.col("inner") - r * F.col("k") * (F.col("sum") - F.col("left") + F.col("k")) / m) * 2 / m
        moves = kept(near.select("v", "k", "c", "d", F.round(gain, 12).alias("gain")).filter(F.col("gain") > LEAST_GAIN / 1000))
        best = F.max(F.struct("gain", (-F.col("v")).alias("v"), (-F.col("d")).alias("d"), "c")).alias("best")
        s = at.agg(F.sum("inner").alias("inner"), F.sum(F.col("k") * F.col("sum")).alias("square")).crossJoin(moves.agg(best)).first()
        return moves, (s["inner"] + self.loops) / m - r * s["square"] / m**2, s["best"]

    def together(self, moves: DataFrame, first: Column) -> DataFrame:
        """Of moves (v, k, c, d, gain), one a vertex, from some communities to others, those that raise the modularity together. Each is judged as if it came after all those of
        greater gain per degree: two that leave or enter the same community share 2 r k k' / m^2 of what they gain one by one, and nothing else can be lost.
        The order is by slots, a bounded number for each community, so that none is summed up row by row. first: the move that comes before all others."""
        by = -F.floor(F.log2(F.try_divide("gain", "k")) * SLOTS) * SPREAD + F.crc32(F.col("v").cast("string").cast("binary")) % SPREAD
        dealt = moves.withColumn("slot", F.when(first, FIRST).otherwise(F.coalesce(by, F.lit(-FIRST))))
        for side in ("c", "d"):
            mass = dealt.groupBy(side, "slot").agg(F.sum("k").alias("mass"))
            mass = mass.select(side, "slot", F.sum("mass").over(W.partitionBy(side).orderBy("slot")).alias(f"before_{side}"))
            dealt = dealt.join(mass, [side, "slot"])
        lost = F.col("k") * (F.col("before_c") + F.col("before_d") - 2 * F.col("k")) * (2 * self.resolution / self.total**2)
        return dealt.filter(first | (F.col("gain") > lost)).select("v", F.col("d").alias("to"))

    def settle(self) -> bool:
        """Rounds of local moves. In a round about half of the communities send vertices and the others take them up, so that no two swap places; of the moves that
        are good one by one those are made that are good together, so that each round raises the modularity and is made once. (Weights below zero can still spoil a round;
        then the best move is made alone.)"""
        gains, q, best = self.look(self.labels)
        turn, alone, any_moved, began, slow = 0, False, False, q, 0
        while best is not None:
            first = F.col("v") == -best["v"]
            while coin(best["c"], turn) or not coin(-best["d"], turn):  # the best move must be possible
                turn += 1
            fair = gains.filter((coin(F.col("c"), turn) == 0) & (coin(F.col("d"), turn) == 1))
            fair = kept(fair.groupBy("v").agg(F.max(F.struct("gain", (-F.col("d")).alias("d"), "k", "c")).alias("x")).select("v", "x.k", "x.c", (-F.col("x.d")).alias("d"), "x.gain"))
            made = self.together(fair, first).filter(first | F.lit(not alone))
            new = kept(self.labels.join(made, "v", "left").select("v", "k", F.coalesce("to", "c").alias("c")))
            turn += 1
            found = self.look(new)
            if found[1] <= q:
                if alone:  # rounding is all that is left
                    return any_moved
                alone = True
                continue
            rise = found[1] - q
            slow = slow + 1 if rise < LEAST_SHARE * (found[1] - began) else 0
            self.labels, (gains, q, best), alone, any_moved = new, found, False, True
            if rise < LEAST_GAIN or slow == 2:
                break
        return any_moved

    def contracted(self) -> DataFrame:
        """Communities as vertices."""
        c = self.labels.select("v", "c")
        e = self.edges.join(c.select(F.col("v").alias("a"), F.col("c").alias("ca")), "a").join(c.select(F.col("v").alias("b"), F.col("c").alias("cb")), "b")
        return e.groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w"))


def both_ways(edges: DataFrame) -> DataFrame:
    """Links in both directions; absent and zero weights count as 1, repeated links add up, links without an end are left out."""
    e = edges.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b", F.when(F.coalesce("w", F.lit(0.0)) == 0, 1.0).otherwise(F.col("w")).cast("double").alias("w"))
    turned = F.inline(F.array(F.struct("a", "b", "w"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    return e.select(turned).groupBy("a", "b").agg(F.sum("w").alias("w"))


def communities(edges: DataFrame, vertices: DataFrame | None = None, resolution: float = 1.0) -> DataFrame:
    """edges (a, b, w), integer vertices -> (v, c): communities by modularity, named by their smallest vertex. Vertices move to the community around them that gains
    most, then communities become vertices and move in their turn, until a level moves nothing. The modularity rises with every round that is accepted.
    vertices (v): those without links are alone, and links to others are left out."""
    if vertices is not None:
        known = vertices.filter("v IS NOT NULL").select("v").distinct()
        edges = edges.join(known.withColumnRenamed("v", "a"), "a", "left_semi").join(known.withColumnRenamed("v", "b"), "b", "left_semi")
    level = Level(both_ways(edges), resolution)
    out = level.labels.select("v", "c")
    while level.total and level.settle():
        out = kept(out.join(level.labels.select(F.col("v").alias("c"), F.col("c").alias("up")), "c").select("v", F.col("up").alias("c")))
        level = Level(level.contracted(), resolution)
    out = out.join(out.groupBy("c").agg(F.min("v").alias("first")), "c").select("v", F.col("first").alias("c"))
    if vertices is not None:
        out = known.join(out, "v", "left").select("v", F.coalesce("c", "v").alias("c"))
    return out


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Of a division (v, c) of edges (a, b, w)."""
    e = both_ways(edges)
    e = e.join(labels.select(F.col("v").alias("a"), F.col("c").alias("ca")), "a").join(labels.select(F.col("v").alias("b"), F.col("c").alias("cb")), "b")
    per = e.groupBy(F.col("ca").alias("c")).agg(F.sum("w").alias("k"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)).alias("inner"))
    s = per.agg(F.sum("k").alias("m"), F.sum("inner").alias("inner"), F.sum(F.col("k") * F.col("k")).alias("square")).first()
    return (s["inner"] / s["m"] - resolution * s["square"] / s["m"] ** 2) if s["m"] else 0.0


def sizes(labels: DataFrame, least: int = 3) -> DataFrame:
    """Members, least member and place of each community, largest first; places are given before small ones are left out."""
    s = labels.groupBy("c").agg(F.count(F.lit(1)).alias("size"), F.min("v").alias("first"))
    return numbered(s, F.desc("size"), F.col("first"), name="community").withColumn("community", F.col("community") - 1).filter(F.col("size") >= least)


def supply_links(spark, sf_dir) -> DataFrame:
    """Brands and the suppliers (as negative numbers) that ship parts of them, by the number of lines."""
    brand = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.regexp_replace("p_brand", "[^0-9]", "").cast("long").alias("a"))
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", (-F.col("l_suppkey")).cast("long").alias("b"))
    return lines.join(brand, "l_partkey").groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("w"))


@query("o1_f5_communities")
def graph_communities(spark, sf_dir):
    """Communities of brands and suppliers, by size."""
    return sizes(communities(supply_links(spark, sf_dir)), 1).select("community", "size", "first")


@query("c7_o2_render", "WITH m AS (SELECT n_regionkey AS c, n_nationkey AS v, n_name FROM nation) SELECT c, string_agg(CAST(k AS VARCHAR) || ': ' || n_name, chr(10) ORDER BY k) AS body, (SELECT count(*) FROM m a JOIN m b ON a.c = b.c AND a.v < b.v WHERE a.c = x.c AND (a.v + b.v) % 3 = 0) AS inner_edges FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY v) AS k FROM m) x GROUP BY c")
def render(spark, sf_dir):
    """Members numbered within their community, and the edges that stay within it."""
    m = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("c"), F.col("n_nationkey").alias("v"), "n_name")
    k = F.row_number().over(W.partitionBy("c").orderBy("v"))
    body = m.select("c", k.alias("k"), F.concat(k.cast("string"), F.lit(": "), "n_name").alias("t")).groupBy("c").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]), "\n").alias("body"))
    other = m.select(F.col("c"), F.col("v").alias("u"))
    edges = m.join(other, "c").filter("v < u AND (v + u) % 3 = 0").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return body.join(edges, "c", "left").select("c", "body", F.coalesce("n", F.lit(0)).cast("long").alias("inner_edges"))

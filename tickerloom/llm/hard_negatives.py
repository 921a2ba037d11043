"""Hard negatives by a multiway hyperplane tree (GNAT) with distance ranges.

A row's score is its inner product with the anchor.  One more coordinate,
``sqrt(M - |x|^2)`` for a row and 0 for an anchor, gives all rows the same length, and then
``|a - x|^2 = |a|^2 + M - 2 score``: a window of scores is an annulus around the anchor.

Every node of the tree has split points; a row goes to the nearest one.  For each pair of
split point and sibling subtree the least and greatest distance of its rows is stored.  A
sibling whose range, seen from any split point, cannot meet the annulus is left out; leaves
are searched exactly.  The upper tree deals all rows to cells, and its ranges are aggregates over all
rows; a cell is cut into blocks of bounded size, and a task builds the lower tree of a block.

Anchors stream past the blocks that they cannot rule out.  They visit their own cell first,
whose best rows narrow the window for all other cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize, workspace
from .vectors import SAMPLE, is_finite, matrix, sample_vectors, stream_groups

FACTOR = 256
FANOUT, LEAF = 16, 256
#: Rows of a block; a task holds one block of vectors at a time.
BLOCK_ROWS = 16_384
#: Anchors compared with a block at once.
QUERIES = 64
FOUND = "vec_id long, key long, slot int, other_id long, score long"


def quantised(column: pa.Array, width: int) -> np.ndarray:
    return np.floor(FACTOR * matrix(column, width))


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Rows with the coordinate that gives all of them the squared length ``most``."""
    rest = np.sqrt(np.maximum(most - (x * x).sum(1), 0))
    return np.hstack([x, rest[:, None]])


def between(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Distances of lifted rows."""
    return np.sqrt(np.maximum(2 * most - 2 * a @ b.T, 0))


def split_points(x: np.ndarray, fanout: int) -> np.ndarray:
    """Rows far from each other: some candidates at regular places, then greedily the farthest."""
    pool = x[:: max(1, len(x) // (3 * fanout))]
    chosen, far = [0], ((pool - pool[0]) ** 2).sum(1)
    while len(chosen) < min(fanout, len(pool)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((pool - pool[chosen[-1]]) ** 2).sum(1))
    return pool[chosen]


class Queries:
    """Anchors with the annulus that holds all their windows."""

    def __init__(self, a: np.ndarray, low: np.ndarray, high: np.ndarray, most: float):
        """``low``, ``high``: the least and the greatest wanted score of each anchor."""
        self.a, self.most = a, most
        self.square = (a * a).sum(1) + most
        # Distances are roots of differences: their error is the root of the rounding error.
        slack = 1e-6 * (np.sqrt(self.square) + np.sqrt(most)) + 1e-9
        outer = self.square - 2 * low
        self.near = np.sqrt(np.maximum(self.square - 2 * high, 0)) - slack
        self.far = np.where(outer >= -slack * slack, np.sqrt(np.maximum(outer, 0)) + slack, -np.inf)

    def meets(self, which: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which siblings (columns) the annuli of some anchors may meet.

        ``low[i, j]`` and ``high[i, j]``: the distances between split point i and the rows of sibling j.
        """
        to = np.sqrt(np.maximum(self.square[which, None] - 2 * self.a[which] @ points[:, :-1].T, 0))
        reach = np.ones((len(which), low.shape[1]), bool)
        for i in range(len(points)):
            d = to[:, i, None]
            least = np.maximum(d - high[i], low[i] - d)
            reach &= (least <= self.far[which, None]) & (d + high[i] >= self.near[which, None])
        return reach


class Tree:
    """The lower tree over the rows of a block."""

    def __init__(self, x: np.ndarray, most: float, rows: np.ndarray | None = None):
        self.rows = np.arange(len(x)) if rows is None else rows
        self.children: list[Tree] = []
        if len(self.rows) <= LEAF:
            return
        mine = x[self.rows]
        self.points = split_points(mine, FANOUT)
        to = between(mine, self.points, most)
        nearest = to.argmin(1)
        used = np.unique(nearest)
        if len(used) < 2:
            return
        members = [nearest == j for j in used]
        self.low = np.array([to[m].min(0) for m in members]).T
        self.high = np.array([to[m].max(0) for m in members]).T
        self.children = [Tree(x, most, self.rows[m]) for m in members]

    def leaves(self, queries: Queries, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of a leaf, anchors that may find something there)."""
        if not self.children:
            yield self.rows, which
            return
        reach = queries.meets(which, self.points, self.low, self.high)
        for j, child in enumerate(self.children):
            if reach[:, j].any():
                yield from child.leaves(queries, which[reach[:, j]])


class Block:
    """The rows of one block, against anchors that stream past."""

    def __init__(self, width: int, most: float, same: bool, best: int):
        self.width, self.most, self.same, self.best = width, most, same, best
        self.parts: list[tuple] = []
        self.tree: Tree | None = None

    def add(self, part: pa.RecordBatch) -> None:
        ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
        self.parts.append((ids, labels, quantised(part.column("vector"), self.width)))

    def answer(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        if self.tree is None:
            self.ids, self.labels, self.x = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            self.tree = Tree(lifted(self.x, self.most), self.most)
        for start in range(0, part.num_rows, QUERIES):
            yield self._search(part.slice(start, QUERIES))

    def finish(self) -> Iterator[pa.RecordBatch]:
        return iter(())

    def _search(self, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, keys = (part.column(c).to_numpy() for c in ("vec_id", "label", "key"))
        a = quantised(part.column("vector"), self.width)
        slots = int(max(np.asarray(part.column("lows").value_lengths())))
        low, high = matrix(part.column("lows"), slots), matrix(part.column("highs"), slots)
        absent = np.arange(slots) >= np.asarray(part.column("lows").value_lengths())[:, None]
        low[absent], high[absent] = np.inf, -np.inf
        queries = Queries(a, low.min(1), high.max(1), self.most)
        found: list[tuple] = []
        for rows, which in self.tree.leaves(queries, np.arange(len(a))):
            score = a[which] @ self.x[rows].T
            allowed = (labels[which, None] == self.labels[rows]) == self.same
            allowed &= ids[which, None] != self.ids[rows]
            for slot in range(slots):
                q, r = np.nonzero(allowed & (score >= low[which, slot, None]) & (score <= high[which, slot, None]))
                found.append((which[q], np.full(len(q), slot), self.ids[rows][r], score[q, r]))
        q, slot, other, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, int)] * 4
        order = np.lexsort((other, -score, slot, q))
        q, slot, other, score = q[order], slot[order], other[order], score[order]
        group = q * slots + slot
        first = np.searchsorted(group, group)
        kept = np.arange(len(group)) - first < self.best
        limit = float(2**63 - 1024)
        columns = [
            pa.array(ids[q[kept]]),
            pa.array(keys[q[kept]]),
            pa.array(slot[kept].astype(np.int32)),
            pa.array(other[kept].astype(np.int64)),
            pa.array(np.clip(score[kept], -limit, limit).astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["vec_id", "key", "slot", "other_id", "score"])


class UpperTree:
    """Split points of the upper levels, and the distance ranges of all rows below them."""

    def __init__(self, sample: np.ndarray, most: float, n: int):
        x = lifted(sample, most)
        self.most = most
        self.nodes = {0: split_points(x, FANOUT)}
        if n > FANOUT * BLOCK_ROWS // 4:
            nearest = between(x, self.nodes[0], most).argmin(1)
            for i in range(len(self.nodes[0])):
                if (nearest == i).any():
                    self.nodes[1 + i] = split_points(x[nearest == i], FANOUT)
        self.ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def route(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """The cell of each lifted row, and per node its rows' distances and nearest split points."""
        to = between(x, self.nodes[0], self.most)
        upper = to.argmin(1)
        seen, cell = [(0, to, upper)], upper * FANOUT
        for i in np.unique(upper):
            if 1 + i in self.nodes:
                mine = upper == i
                to = between(x[mine], self.nodes[1 + i], self.most)
                cell[mine] += to.argmin(1)
                seen.append((1 + int(i), to, to.argmin(1)))
        return cell, seen

    def cells(self, queries: Queries) -> np.ndarray:
        """Anchors by cells: which cells they may find something in."""
        reach = np.zeros((len(queries.a), FANOUT * FANOUT), bool)
        top = queries.meets(np.arange(len(queries.a)), self.nodes[0], *self.ranges[0])
        for i in range(top.shape[1]):
            which = np.flatnonzero(top[:, i])
            if 1 + i not in self.nodes:
                reach[which, i * FANOUT] = True
            elif len(which) and 1 + i in self.ranges:
                below = queries.meets(which, self.nodes[1 + i], *self.ranges[1 + i])
                reach[which, i * FANOUT : i * FANOUT + below.shape[1]] = below
        return reach

    def add_ranges(self, rows: list) -> None:
        """(node, point, sibling, low, high) rows; siblings without rows meet nothing."""
        for node, points in self.nodes.items():
            self.ranges[node] = (np.full((len(points),) * 2, np.inf), np.full((len(points),) * 2, -np.inf))
        for node, point, sibling, low, high in rows:
            self.ranges[node][0][point, sibling] = low
            self.ranges[node][1][point, sibling] = high


def _summary(rows: DataFrame) -> tuple[int, int, float]:
    """Rows, longest vector, and greatest squared length."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = batch.column("vector")
                x = quantised(v, int(max(np.asarray(v.value_lengths()))))
                yield pa.RecordBatch.from_pydict({"n": [len(x)], "width": [x.shape[1]], "most": [float((x * x).sum(1).max())]})

    made = rows.select("vector").mapInArrow(run, "n long, width long, most double")
    n, width, most = made.agg(F.sum("n"), F.max("width"), F.max("most")).first()
    return n or 0, width or 0, most or 0.0


def _routed(rows: DataFrame, tree: UpperTree, width: int) -> DataFrame:
    """Rows with their cell, and a salt that deals a cell's rows to blocks."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell, _ = tree.route(lifted(quantised(batch.column("vector"), width), tree.most))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

    schema = "vec_id long, label long, vector array<double>, cell int"
    made = rows.mapInArrow(run, schema.replace("double", rows.schema["vector"].dataType.elementType.simpleString()))
    return made.withColumn("salt", F.xxhash64("vec_id", F.monotonically_increasing_id()))


def _ranges(routed: DataFrame, tree: UpperTree, width: int) -> list:
    """Distance ranges of all rows: at most FANOUT * FANOUT numbers per node."""

    def run(batches):
        low: dict[tuple, np.ndarray] = {}
        high: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                _, seen = tree.route(lifted(quantised(batch.column("vector"), width), tree.most))
                for node, to, nearest in seen:
                    for j in np.unique(nearest):
                        key, mine = (node, int(j)), to[nearest == j]
                        low[key] = np.minimum(low.get(key, np.inf), mine.min(0))
                        high[key] = np.maximum(high.get(key, -np.inf), mine.max(0))
        out = [(node, i, j, float(x), float(high[node, j][i])) for (node, j), xs in low.items() for i, x in enumerate(xs)]
        names = ("node", "point", "sibling", "low", "high")
        types = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        arrays = [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    made = routed.select("vector").mapInArrow(run, "node int, point int, sibling int, low double, high double")
    return made.groupBy("node", "point", "sibling").agg(F.min("low"), F.max("high")).collect()


def _visits(asked: DataFrame, tree: UpperTree, width: int, own: bool) -> DataFrame:
    """``asked`` with the cells to visit: the anchor's own, or all others that it cannot rule out."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, QUERIES):
                part = batch.slice(start, QUERIES)
                home = part.column("cell").to_numpy()
                if own:
                    cells = [[c] for c in home.tolist()]
                else:
                    lows, highs = part.column("lows").to_pylist(), part.column("highs").to_pylist()
                    low, high = np.array([min(x) for x in lows]), np.array([max(x) for x in highs])
                    reach = tree.cells(Queries(quantised(part.column("vector"), width), low, high, tree.most))
                    reach[np.arange(len(home)), home] = False
                    cells = [np.flatnonzero(r).tolist() for r in reach]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*part.schema.names, "cells"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema.fields)
    return asked.mapInArrow(run, f"{fields}, cells array<int>").withColumn("cell", F.explode("cells")).drop("cells")


def mine(
    vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 5, least_percent: int = 80
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and vector; ``anchors`` is a condition on them.  A component x
    counts as ``floor(256 * x)``.  An anchor's positives are the best rows of its label; for each one, the
    negatives are the best rows of other labels whose score is at most the positive's and at
    least ``least_percent`` of it.  Ties go to the smaller vec_id.

    Rows with a null vec_id, label or vector, or with a component that is null or not finite,
    take no part.  Of vectors of different lengths the shorter is filled up with zeros.  Rows
    count each, also repeated ones, but rows of one vec_id are no partners of each other, and
    equal anchors count once.  Scores are exact below 2**53.  An anchor without positives, or a positive
    without negatives (always if its score is below 0), has no rows; so has an empty table.

    Split points come from a sample of at most ``SAMPLE`` rows; ranges, cells and leaves cover
    all rows and nothing is left out that could be found.
    """
    spark = vectors.sparkSession
    folder = workspace(spark)
    usable = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite("vector"))
    rows = usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector")
    n, width, most = _summary(rows)
    if not n or not width:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], empty)
    sample = np.floor(FACTOR * np.array([v + [0.0] * (width - len(v)) for v in sample_vectors(rows, "vector", "vec_id", "label")], float))
    tree = UpperTree(sample, most, n)
    routed = materialize(_routed(rows, tree, width), "routed", folder)
    tree.add_ranges(_ranges(routed, tree, width))
    blocks = [1] * FANOUT * FANOUT
    for cell, count in routed.groupBy("cell").count().collect():  # at most FANOUT * FANOUT rows
        blocks[cell] = -(-count // BLOCK_ROWS)
    in_cell = F.element_at(F.lit(blocks), F.col("cell") + 1).cast("long")
    stored = routed.select(
        "cell", F.pmod("salt", in_cell).alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "vector",
        F.lit(None).cast("long").alias("key"), *[F.lit(None).cast("array<double>").alias(c) for c in ("lows", "highs")],
    )

    def search(asked: DataFrame, same: bool, best: int, own: bool) -> DataFrame:
        visits = _visits(asked.select("cell", "vec_id", "label", "vector", "key", "lows", "highs"), tree, width, own)
        visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), in_cell - 1)))
        both = stored.unionByName(visits.withColumn("kind", F.lit(1)))
        return stream_groups(both, ["cell", "block"], lambda _: Block(width, most, same, best), FOUND)

    def best_of(found: DataFrame, best: int) -> DataFrame:
        order = Window.partitionBy("vec_id", "key", "slot").orderBy(F.desc("score"), "other_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)

    def both_passes(asked: DataFrame, same: bool, best: int, name: str) -> DataFrame:
        """The best rows per window; ``asked`` has arrays of the least and greatest wanted scores."""
        near = materialize(best_of(search(asked, same, best, True), best), f"{name}-near", folder)
        reached = near.filter(F.col("rank") == best).groupBy("vec_id", "key").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", F.col("score").cast("double")))).alias("reached")
        )
        raised = F.transform("lows", lambda low, i: F.greatest(low, F.coalesce(F.col("reached")[i], low)))
        rest = asked.join(reached, ["vec_id", "key"], "left")
        rest = rest.withColumn("lows", F.when(F.col("reached").isNull(), F.col("lows")).otherwise(raised))
        other = search(rest, same, best, False)
        return materialize(best_of(near.drop("rank").unionByName(other), best), name, folder)

    asking = routed.filter(anchors).drop("salt").withColumn("key", F.xxhash64("label", "vector"))
    asking = materialize(asking.dropDuplicates(["vec_id", "key"]), "anchors", folder)
    everything = {"lows": F.array(F.lit(float("-inf"))), "highs": F.array(F.lit(float("inf")))}
    chosen = both_passes(asking.withColumns(everything), True, positives, "positives")

    # One window per positive, in the order of their ranks.
    above = chosen.filter("score >= 0").select("vec_id", "key", F.struct("rank", "other_id", "score").alias("positive"))
    windows = above.groupBy("vec_id", "key").agg(F.array_sort(F.collect_list("positive")).alias("positives"))
    windows = windows.withColumns(
        {
            "lows": F.transform("positives", lambda p: F.expr("CAST(1 AS DOUBLE)") * F.ceil(least_percent * p["score"] / F.lit(100.0))),
            "highs": F.transform("positives", lambda p: p["score"].cast("double")),
        }
    )
    windows = materialize(windows, "windows", folder)
    wanted = asking.join(windows.drop("positives"), ["vec_id", "key"])
    hard = both_passes(wanted, False, negatives, "negatives")
    own = F.element_at("positives", F.col("slot") + 1)
    joined = hard.join(windows.select("vec_id", "key", "positives"), ["vec_id", "key"])
    return joined.select(
        F.col("vec_id").alias("anchor_id"),
        own["other_id"].alias("positive_id"),
        "rank",
        F.col("other_id").alias("negative_id"),
        own["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


__all__ = ["BLOCK_ROWS", "SAMPLE", "Block", "Queries", "Tree", "UpperTree", "mine"]

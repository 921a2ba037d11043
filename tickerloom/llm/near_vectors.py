"""Near-duplicate vectors by a pigeonhole join over blocks of a rotated space.

Unit vectors with a cosine of at least t have a squared distance of at most 2 - 2t.  A random
rotation spreads this over all coordinates, which are split into blocks; a block's budget is
its share of the coordinates.  In at least one block, two near vectors are within its budget
(all above would sum to more), so the union of the range joins of all blocks has every pair.

A block's space is cut at medians into cells.  A vector is at home in one cell and visits
every later one that its ball reaches.  Visitors stream past the home vectors of a cell; what
the block's distances admit is verified by the cosine of the whole vectors.  A pair found in
several blocks counts in the first of them.  A task passes on counts and a spanning
forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize, workspace
from .components import connected_components
from .vectors import is_finite, matrix, sample_vectors, stream_groups

COSINE = 0.93
#: Coordinates of a block.
BLOCK = 16
#: Vectors of one label for which a cell is cut no further.
CELL_ROWS = 2048
#: Home vectors that a task holds at once; fuller cells are cut into parts.
HOME_ROWS = 8192
#: Visitors compared with the home vectors at once.
VISITORS = 256
#: Rounding errors of distances and cosines are far below this.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; very large and very small components do no harm."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Space:
    """The rotation, its blocks with their budgets, and where cells are cut."""

    def __init__(self, width: int, cosine: float):
        self.width, self.cosine = width, cosine
        self.rotation = np.ascontiguousarray(np.linalg.qr(np.random.default_rng(7).standard_normal((width, width)))[0].T)
        edges = np.linspace(0, width, max(1, round(width / BLOCK)) + 1).astype(int).tolist()
        self.blocks = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
        self.budgets = [(2 - 2 * cosine) * (s.stop - s.start) / width + SLACK for s in self.blocks]
        self.cuts = np.zeros(width)

    def turned(self, u: np.ndarray, block: int) -> np.ndarray:
        """A block of the rotated vectors; the same vector gives the same bits in any batch."""
        out = [(u[i : i + 256, None, :] * self.rotation[self.blocks[block]]).sum(2) for i in range(0, len(u), 256)]
        return np.concatenate(out)

    def fit(self, sample: np.ndarray) -> None:
        """Cuts at the medians of a sample."""
        u = unit(sample)
        self.cuts = np.concatenate([np.median(self.turned(u, b), axis=0) for b in range(len(self.blocks))])

    def places(self, u: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per block: (block, home codes, visiting rows, visited codes).

        ``bits``: how many coordinates of each block cut the cells of a row's label.  A row visits
        the cells after its own that have points within its budget.
        """
        for b, place in enumerate(self.blocks):
            offset = self.turned(u, b) - self.cuts[place]
            most = min(int(bits.max(initial=0)), offset.shape[1])
            used = np.arange(most) < bits[:, None]
            home = ((offset[:, :most] > 0) & used) @ (1 << np.arange(most, dtype=np.int64))
            row, code, cost = np.arange(len(u)), home.copy(), np.zeros(len(u))
            for k in range(most):
                more = cost + offset[row, k] ** 2
                crossing = (bits[row] > k) & (more <= self.budgets[b])
                row = np.concatenate([row, row[crossing]])
                code = np.concatenate([code, code[crossing] ^ (1 << k)])
                cost = np.concatenate([cost, more[crossing]])
            later = code > home[row]
            yield b, home, row[later], code[later]


class Cell:
    """The home vectors of (a part of) a cell, and the visitors that stream past them."""

    def __init__(self, space: Space, block: int):
        self.space, self.block = space, block
        self.parts: list[tuple] = []
        self.ready = False

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(self._read(part))

    def answer(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from self._own()
        if self.parts:
            for start in range(0, part.num_rows, VISITORS):
                cid, copies, u = self._read(part.slice(start, VISITORS))
                linked = self._linked(u, self.u)
                yield from self._count(cid, copies, linked)

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self._own()
        if self.parts:
            some = self.counts > 0
            yield _found(self.cid[some], self.counts[some], self.cid[self.root[some]])

    def _read(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cid, copies = (part.column(c).to_numpy() for c in ("cid", "copies"))
        return cid, copies, unit(matrix(part.column("vector"), self.space.width))

    def _own(self) -> Iterator[pa.RecordBatch]:
        """Once all home vectors are here: the pairs among them."""
        if self.ready or not self.parts:
            return
        self.ready = True
        self.cid, self.copies, self.u = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.counts = np.zeros(len(self.cid), np.int64)
        self.root = np.arange(len(self.cid))
        for start in range(0, len(self.cid), VISITORS):
            end = min(start + VISITORS, len(self.cid))
            linked = self._linked(self.u[start:end], self.u[:end])
            linked &= np.arange(end) < np.arange(start, end)[:, None]
            self.counts[:end] += linked.T @ self.copies[start:end]
            self.counts[start:end] += linked @ self.copies[:end]
            for i in np.flatnonzero(linked.any(1)):
                self._merge(np.append(np.flatnonzero(linked[i]), start + i))
        yield from ()

    def _merge(self, rows: np.ndarray) -> None:
        """Home vectors that one vector links are in one component."""
        roots = np.unique(self.root[rows])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def _count(self, cid: np.ndarray, copies: np.ndarray, linked: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.counts += linked.T @ copies
        some = np.flatnonzero(linked.any(1))
        if len(some):
            for i in some:
                self._merge(np.flatnonzero(linked[i]))
            yield _found(cid[some], linked[some] @ self.copies, self.cid[self.root[linked[some].argmax(1)]])

    def _linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs within the budget of this block and of none before, verified by their cosine."""
        space, out = self.space, np.zeros((len(a), len(b)), bool)
        x, y = space.turned(a, self.block), self._turned(b, self.block)
        distance = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T
        near = distance <= space.budgets[self.block] + SLACK
        rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(rows):
            return out
        cosine = a[rows] @ b[columns].T
        i, j = np.nonzero(near[np.ix_(rows, columns)] & (cosine >= space.cosine - SLACK))
        close = cosine[i, j] < space.cosine + SLACK
        i, j = rows[i], columns[j]
        kept = np.ones(len(i), bool)
        kept[close] = (a[i[close]] * b[j[close]]).sum(1) >= space.cosine
        i, j = i[kept], j[kept]
        # Whether this is the first block must not depend on the batch, so distances are sums in a fixed order.
        for earlier in range(self.block + 1):
            x, y = space.turned(a[rows], earlier), self._turned(b, earlier)
            place = np.searchsorted(rows, i)
            within = np.concatenate(
                [((x[place[s : s + 65_536]] - y[j[s : s + 65_536]]) ** 2).sum(1) for s in range(0, len(i), 65_536)] or [np.zeros(0)]
            ) <= space.budgets[earlier]
            kept = within if earlier == self.block else ~within
            i, j = i[kept], j[kept]
            if not len(i):
                return out
        out[i, j] = True
        return out

    def _turned(self, b: np.ndarray, block: int) -> np.ndarray:
        """Rotated home vectors, kept for all visitors; ``b`` is a beginning of them."""
        if not hasattr(self, "kept"):
            self.kept: dict[int, np.ndarray] = {}
        if block not in self.kept:
            self.kept[block] = self.space.turned(self.u, block)
        return self.kept[block][: len(b)]


def _found(cid: np.ndarray, linked: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(c.astype(np.int64)) for c in (cid, linked, root)]
    return pa.RecordBatch.from_arrays(columns, names=["cid", "linked", "root"])


def _located(classes: DataFrame, space: Space) -> DataFrame:
    """Classes with the cells where they are at home and those that they visit."""
    place = pa.struct([("b", pa.int32()), ("code", pa.int64()), ("home", pa.bool_())])

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                n, owner, fields = batch.num_rows, [], []
                for b, home, row, code in space.places(unit(matrix(batch.column("vector"), space.width)), batch.column("bits").to_numpy()):
                    owner += [np.arange(n), row]
                    fields.append((np.full(n + len(row), b), np.concatenate([home, code]), np.arange(n + len(row)) < n))
                owner = np.concatenate(owner)
                order = np.argsort(owner, kind="stable")
                values = [np.concatenate(c)[order] for c in zip(*fields, strict=True)]
                entries = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(values, place, strict=True)], fields=list(place))
                offsets = np.searchsorted(owner[order], np.arange(n + 1))
                places = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
                kept = [batch.column(c) for c in ("cid", "label", "copies", "vector")]
                yield pa.RecordBatch.from_arrays([*kept, places], names=["cid", "label", "copies", "vector", "places"])

    vector = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(run, f"cid long, label long, copies long, vector {vector}, places array<struct<b: int, code: bigint, home: boolean>>")


def link_vectors(vectors: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS, home_rows: int = HOME_ROWS) -> DataFrame:
    """Per row of ``vectors`` (vec_id, label, vector): vec_id, n_links, component_id, kept.

    Two rows link if their labels are equal and their cosine, in double precision, is at least
    ``cosine``.  Equal vectors of a label form a class that takes part once; rows count each, also
    repeated ones.  A component's id is its smallest vec_id.

    Rows with a null vec_id, label or vector, a vector of zeros or without components, or with a
    component that is null or not finite link with nothing: no links, their own id as
    component, kept.  Of vectors of different lengths the shorter is filled up with zeros.

    The cuts of cells come from a sample; they decide where a pair is found and not whether.
    """
    spark = vectors.sparkSession
    folder = workspace(spark)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite("vector")
    usable &= F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector")
    rows = rows.withColumn("usable", usable)
    # 128 bits of hash stand for a label with a vector.
    keys = {"k1": F.xxhash64("label", "vector"), "k2": F.xxhash64(F.reverse("vector"), "label")}
    keyed = materialize(rows.withColumns(keys).select("vec_id", "usable", "k1", "k2"), "keys", folder)
    classes = rows.filter("usable").withColumns(keys).groupBy("k1", "k2", "label", "vector")
    classes = classes.agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes", folder)
    width = classes.agg(F.max(F.size("vector"))).first()[0]
    if not width:
        alone = keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    space = Space(width, cosine)
    sample = sample_vectors(classes, "vector", "k1")
    space.fit(np.array([v + [0.0] * (width - len(v)) for v in sample], float))

    # A label's cells are cut in as many coordinates as leave about ``cell_rows`` vectors in each.
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    cuts = F.greatest(F.ceil(F.log2(F.col("n") / F.lit(float(cell_rows)))), F.lit(0))
    sized = classes.join(sizes.select("label", F.least(cuts, F.lit(BLOCK)).cast("int").alias("bits")), "label")
    located = _located(sized.select("cid", "label", "copies", "vector", "bits"), space)
    placed = located.withColumn("place", F.explode("places")).select("cid", "label", "copies", "vector", "place.*")
    homes = located.select("label", F.explode("places").alias("place")).filter("place.home")
    full = homes.groupBy("label", "place.b", "place.code").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(home_rows))).alias("parts"))
    full = full.filter("parts > 1")
    split = placed.join(full, ["label", "b", "code"], "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    first = F.when(F.col("home"), F.pmod(F.xxhash64("cid"), F.col("parts"))).otherwise(F.lit(0).cast("long"))
    split = split.withColumn("first", first).withColumn("part", F.explode(F.sequence("first", F.col("parts") - 1)))
    kind = F.when(F.col("home") & (F.col("part") == F.col("first")), 0).otherwise(1)
    dealt = split.select("label", "b", "code", "part", kind.alias("kind"), "cid", "copies", "vector")
    found = stream_groups(dealt, ["label", "b", "code", "part"], lambda key: Cell(space, key[1]), "cid long, linked long, root long")
    found = materialize(found, "found", folder)

    counts = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    components = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    known = classes.select("cid", "k1", "k2", "rep", "copies").join(counts, "cid", "left")
    known = known.join(components.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.withColumn("component", F.coalesce("component", "cid"))
    smallest = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    links = F.coalesce("linked", F.lit(0).cast("long")) + F.col("copies") - 1
    known = known.join(smallest, "component").select("k1", "k2", links.alias("n_links"), "component_id")
    joined = keyed.filter("usable").select("vec_id", "k1", "k2").join(known, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

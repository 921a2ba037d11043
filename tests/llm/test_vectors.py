"""Hard negatives and near vectors against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import hard_negatives, near_vectors

from .test_join_dedup import union_find

SCHEMA = "vec_id long, label int, vector array<float>"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def vectors(seed, n, width=12, clusters=6):
    """Clustered vectors, exact copies among them."""
    r = np.random.default_rng(seed)
    centres = r.standard_normal((clusters, width))
    rows = []
    for i in range(n):
        if rows and r.random() < 0.15:
            v = rows[int(r.integers(len(rows)))][2]
        else:
            spread = [0.02, 0.1, 0.4, 1.0][int(r.integers(4))]
            v = (centres[int(r.integers(clusters))] + spread * r.standard_normal(width)).astype(np.float32).tolist()
        rows.append((i * 7 + 1 if i % 5 else i * 100, int(r.integers(4)), v))
    return rows


ODD = [
    (None, 1, [1.0, 2.0]),
    (9001, None, [1.0, 2.0]),
    (9002, 1, None),
    (9003, 1, [1.0, None]),
    (9004, 1, [float("nan"), 1.0]),
    (9005, 2, [float("inf"), 1.0]),
    (9006, 2, []),
    (9007, 2, [0.0] * 12),
    (9100, 2, [1e-30] * 12),
    (9200, 2, [0.5]),
    (9300, 3, [-1.0] * 12),
]


def score(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=False))


def mined(rows, positives=5, negatives=5):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and usable(r[2])]
    out = []
    for anchor, label, a in dict.fromkeys((i, x, tuple(v)) for i, x, v in rows if i % 100 == 0):
        scored = sorted((-score(a, v), i, x == label) for i, x, v in rows if i != anchor)
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            found = [(n, i) for n, i, same in scored if not same and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(anchor, pid, rank, i, -p, -n) for rank, (n, i) in enumerate(found[:negatives], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block_rows", [16_384, 24])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)  # small: two levels of cells, several blocks in each
    rows = vectors(3, 500) + ODD
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = mined(rows)
    assert len(want) > 300
    assert got(hard_negatives.mine(df, "vec_id % 100 = 0")) == want


def test_hard_negatives_with_repeated_rows_ties_and_other_columns(spark):
    rows = vectors(4, 60)
    rows += [rows[5], rows[5], rows[0], (rows[0][0], 9, rows[3][2])] + [(5000 + i, 1 + i % 2, rows[0][2]) for i in range(40)]
    rows += [(100 * i + 10_000, 1, [0.0] * 12) for i in range(3)]  # every score is 0
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("cell", "block", "kind", "key", "lows", "highs", "rank", "score", "slot", "salt", "n"):
        df = df.withColumn(name, F.lit(7))
    assert got(hard_negatives.mine(df, "vec_id % 100 = 0")) == mined(rows)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame(ODD[:6], SCHEMA)
    for empty in (df, df.limit(0), spark.createDataFrame([(100, 1, [])], SCHEMA)):
        assert hard_negatives.mine(empty, "vec_id % 100 = 0").count() == 0
    one_label = spark.createDataFrame([(100, 1, [1.0]), (101, 1, [1.0])], SCHEMA)
    assert hard_negatives.mine(one_label, "vec_id % 100 = 0").count() == 0


def test_tree_leaves_out_siblings_and_nothing_else(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    x = np.floor(256 * np.array([v for _, _, v in vectors(9, 3000, clusters=40)]))
    most = float((x * x).sum(1).max())
    tree = hard_negatives.Tree(hard_negatives.lifted(x, most), most)
    anchors = x[::100]
    scores = anchors @ x.T
    high = np.sort(scores, 1)[:, -5]
    low = 0.8 * high
    queries = hard_negatives.Queries(anchors, low, high, most)
    seen = np.zeros(scores.shape, bool)
    for rows, which in tree.leaves(queries, np.arange(len(anchors))):
        seen[np.ix_(which, rows)] = True
    wanted = (scores >= low[:, None]) & (scores <= high[:, None])
    assert wanted.any() and not (wanted & ~seen).any()
    assert seen.mean() < 0.7  # ranges spare the rest
    none = hard_negatives.Queries(anchors, np.full(len(anchors), 4 * most), np.full(len(anchors), 5 * most), most)
    assert list(tree.leaves(none, np.arange(len(anchors)))) == []


def linked(rows, cosine):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    width = max((len(v) for *_, v in rows if v), default=0)
    kept = [k for k, (i, x, v) in enumerate(rows) if i is not None and x is not None and usable(v) and any(v)]
    x = np.array([list(rows[k][2]) + [0.0] * (width - len(rows[k][2])) for k in kept], np.float64).reshape(len(kept), width)
    x /= np.abs(x).max(1, keepdims=True) if len(x) else 1
    x /= np.linalg.norm(x, axis=1, keepdims=True) if len(x) else 1
    near = x @ x.T >= cosine
    links = [(a, b) for p, a in enumerate(kept) for q, b in enumerate(kept[:p]) if near[p, q] and rows[a][1] == rows[b][1]]
    root = union_find(range(len(rows)), links)
    degree = [0] * len(rows)
    least: dict = {}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    for k in kept:
        least[root[k]] = min(rows[k][0], least.get(root[k], rows[k][0]))
    component = [least[root[k]] if k in set(kept) else rows[k][0] for k in range(len(rows))]
    return sorted(((i, degree[k], component[k], component[k] == i) for k, (i, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize("width,cell_rows,home_rows", [(12, 2048, 8192), (40, 12, 7), (33, 4, 1000), (1, 2048, 8192)])
def test_near_vectors_equal_all_pairs(spark, width, cell_rows, home_rows):
    """Small numbers give many cells and several parts of full ones."""
    rows = vectors(width, 400, width) + ODD + [(9301, 3, [-1.0] * 12), (9302, 3, [3e38] * 12), (9303, 3, [-3e38] * 12)]
    rows += [rows[0], rows[1], (rows[0][0], 3, [-1.0] * 12)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("cid", "copies", "rep", "k1", "k2", "b", "code", "home", "part", "kind", "usable", "n", "bits"):
        df = df.withColumn(name, F.lit(7))
    want = linked(rows, 0.93)
    found = sorted((tuple(r) for r in near_vectors.link_vectors(df, 0.93, cell_rows, home_rows).collect()), key=str)
    assert found == want
    assert sum(r[1] for r in want) > 200


def test_near_vectors_of_nothing(spark):
    df = spark.createDataFrame(ODD[:8], SCHEMA)
    rows = near_vectors.link_vectors(df).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in rows) == [(r[0] or 0, 0, True) for r in ODD[:8]]
    assert near_vectors.link_vectors(df.limit(0)).count() == 0


def test_every_near_pair_shares_a_block():
    """The pigeonhole: a visit or a common home in some block, however the space is cut."""
    r = np.random.default_rng(5)
    space = near_vectors.Space(48, 0.9)
    a = near_vectors.unit(r.standard_normal((300, 48)))
    b = near_vectors.unit(a + 0.06 * r.standard_normal(a.shape))
    near = (a * b).sum(1) >= 0.9
    assert near.sum() > 200
    space.fit(a)
    both = np.concatenate([a, b])
    together = np.zeros(len(a), bool)
    for _, home, row, code in space.places(both, np.full(len(both), 6)):
        visits = {(int(i), int(c)) for i, c in zip(row, code, strict=True)} | {(i, int(c)) for i, c in enumerate(home)}
        x, y = home[:300], home[300:]
        together |= [(i, int(y[i])) in visits or (i + 300, int(x[i])) in visits for i in range(300)]
    assert together[near].all()


def test_rotation_does_not_depend_on_the_batch():
    space = near_vectors.Space(64, 0.93)
    u = near_vectors.unit(np.random.default_rng(1).standard_normal((700, 64)))
    for b in range(len(space.blocks)):
        whole = space.turned(u, b)
        for _ in range(5):
            some = np.array(random.sample(range(700), 13))
            assert (space.turned(u[some], b) == whole[some]).all()

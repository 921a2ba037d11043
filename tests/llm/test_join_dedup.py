import hashlib
import random

import numpy as np
import pytest

from tickerloom.llm import jaccard_join, suffix_dedup
from tickerloom.llm.components import connected_components

from .conftest import EDGES, LONG


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    links += [(2000, 2001 + i) for i in range(50)]
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [x for x in links if x[0] != x[1]]
    want = union_find({n for x in real for n in x}, real)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, words):
    parts = jaccard_join.words_of(text).split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def brute(rows, words, percent):
    sets = [(d, shingles(t, words)) for d, t in rows]
    usable = [i for i, (d, s) in enumerate(sets) if s and d is not None]
    links = []
    for x, i in enumerate(usable):
        for j in usable[:x]:
            a, b = sets[i][1], sets[j][1]
            if 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    found = union_find(range(len(sets)), links)
    least: dict = {}
    for i in usable:
        least[found[i]] = min(sets[i][0], least.get(found[i], sets[i][0]))
    return sorted(((d, len(s), least[found[i]] if i in usable else d) for i, (d, s) in enumerate(sets)), key=str)


def near_texts(seed, n):
    r = random.Random(seed)
    common = [f"C{i}" for i in range(60)]
    bases = [[f"w{r.randrange(5000)}" for _ in range(r.choice([4, 12, 40, 150]))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(r.choice(bases))
        if r.random() < 0.3:
            words = common[:40] + words
        for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
            at = r.randrange(len(words))
            words[at : at + r.choice([0, 1])] = [f"n{r.randrange(10**6)}"][: r.choice([0, 1])]
        rows.append((i * 3 + 1, r.choice([" ", "\n"]).join(words)))
    return rows


def test_one_id_with_two_texts_keeps_the_links_of_both(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, one), (5, two), (9, one + " x"), (7, two + " y"), (5, one)]
    got = jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted([(5, 58, 5), (5, 58, 5), (5, 58, 5), (9, 59, 5), (7, 59, 5)])


@pytest.mark.parametrize("words,percent,part_bytes", [(3, 90, 16 << 20), (5, 80, 16 << 20), (3, 80, 3000)])
def test_join_equals_all_pairs(spark, monkeypatch, words, percent, part_bytes):
    monkeypatch.setattr(jaccard_join, "PART_BYTES", part_bytes)  # small: parts are searched block against block
    rows = near_texts(words * percent, 220) + [(5000, None), (5001, ""), (5002, "a"), (5003, "A"), (5004, "a a a a a a"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard_join.link_components(docs, words, percent).collect()), key=str)
    assert got == brute(rows, words, percent)


def test_search_equals_all_pairs():
    r = np.random.default_rng(1)
    for percent in (60, 80, 90):
        base = r.integers(0, 400, 30, dtype=np.uint64)
        sets = [np.unique(np.where(r.random(30) < 0.07, r.integers(400, 900, 30, dtype=np.uint64), base)) for _ in range(60)]
        sets += [np.unique(r.integers(0, 400, 25, dtype=np.uint64)) for _ in range(20)]
        sides = r.integers(0, 2, len(sets))
        for across in (False, True):
            every = [
                (i, j)
                for i in range(len(sets))
                for j in range(i)
                if (not across or sides[i] != sides[j])
                and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))
            ]
            found = jaccard_join.search(sets, sides, percent, across)
            assert {tuple(sorted(x)) for x in found} <= {tuple(sorted(x)) for x in every}
            assert union_find(range(len(sets)), found) == union_find(range(len(sets)), every)


def test_prefixes_share_t():
    """The bound on shared smallest elements, for all pairs of sizes and all overlaps that link."""
    r = np.random.default_rng(3)
    for percent in (80, 90):
        for _ in range(400):
            n = int(r.integers(1, 120))
            a = np.unique(r.integers(0, 1 << 40, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[r.random(len(a)) > 0.06], r.integers(0, 1 << 40, int(r.integers(0, 8)), dtype=np.uint64)]))
            o = len(np.intersect1d(a, b))
            if not len(b) or 100 * o < percent * (len(a) + len(b) - o):
                continue
            pa, pb = (x[: jaccard_join.prefix_length(len(x), percent)] for x in (a, b))
            t = min(jaccard_join.shared_least(len(a), percent), jaccard_join.shared_least(len(b), percent))
            assert len(np.intersect1d(pa, pb)) >= t
            for x in (a, b):
                assert jaccard_join.shared_least(int(jaccard_join.least_overlap(len(x), percent)), percent) <= t


def test_linked_sets_share_buckets():
    """Different sets that link send two equal buckets at least, whatever their sizes."""
    r = np.random.default_rng(4)
    for percent in (60, 80, 90):
        linked = 0
        for _ in range(600):
            a = np.unique(r.integers(0, 1 << 64, int(r.choice([10, 25, 120, 400])) + int(r.integers(0, 9)), dtype=np.uint64))
            changes = len(a) * (100 - percent) // 100 + 1
            b = np.concatenate([r.permutation(a)[int(r.integers(0, changes)) :], r.integers(0, 1 << 64, int(r.integers(0, changes)), dtype=np.uint64)])
            b = np.unique(b)
            o = len(np.intersect1d(a, b))
            if 100 * o >= percent * (len(a) + len(b) - o) and o < max(len(a), len(b)):
                linked += 1
                none, first, second = jaccard_join.bucket_signs([a[:0], a, b], percent)
                assert not len(none) and len(np.intersect1d(first, second)) >= jaccard_join.SHARED
        assert linked > 100


def test_single_shared_shingles_make_no_large_part(spark, monkeypatch):
    """Frequent words bring most texts some shared shingles; that alone puts no two in one part."""
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    rows = [(i, " ".join(r.choices(vocabulary, weights, k=r.randrange(60, 160)))) for i in range(600)]
    rows += [(1000 + i, f"{text} end") for i, text in rows[:40]]
    seen = []
    search_parts = jaccard_join._search_parts
    monkeypatch.setattr(jaccard_join, "_search_parts", lambda texts, parts, *a: seen.extend(parts.groupBy("part").count().collect()) or search_parts(texts, parts, *a))
    got = sorted((tuple(x) for x in jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows, 3, 90)
    assert len(seen) >= 40 and max(x["count"] for x in seen) <= 4


def test_large_groups_are_not_copied_to_all_blocks(spark, monkeypatch):
    """A group of near copies takes many blocks; each text travels a few times and not once a block."""
    r = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[: (k := r.randrange(100))] + [f"x{i}"] + base[k:])) for i in range(120)]
    rows += [(200 + i, " ".join(base[:60] + [f"y{i}", f"z{i}", f"v{i}"] + base[60:])) for i in range(9)]
    rows += [(300 + i, " ".join(base[:30] + [f"q{k}" for k in range(9)] + base[39:] + [f"e{i}"] * (i % 2))) for i in range(2)]
    monkeypatch.setattr(jaccard_join, "PART_BYTES", 4000)
    copies, only_wanted = [], jaccard_join._find_links

    def find_links(texts, placed, *a):
        copies.extend(len(x["units"]) for x in placed.select("units").collect())
        return only_wanted(texts, placed, *a)

    monkeypatch.setattr(jaccard_join, "_find_links", find_links)
    got = sorted((tuple(x) for x in jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows, 3, 90)
    assert max(copies) > 20 and sum(copies) < 8 * len(rows)


def test_join_on_edges(edges, nothing):
    got = sorted((tuple(r) for r in jaccard_join.link_components(edges).collect()), key=str)
    by = {(d, n): c for d, n, c in got}
    assert len(got) == len(EDGES)
    assert by[(2, 8)] == 1 and by[(3, 0)] == 3 and by[(None, 0)] is None
    assert {c for d, _, c in got if d in (6, 7)} == {6}
    assert jaccard_join.link_components(nothing).count() == 0


def brute_cut(texts, length):
    seen: dict = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        covered = set()
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered.update(range(i, i + length))
        out.append((bytes(c for i, c in enumerate(t) if i not in covered), covered))
    return out


def runs(covered):
    return [x for x in sorted(covered) if x - 1 not in covered]


@pytest.mark.parametrize("length,alphabet,seed", [(8, "ab", 1), (12, "abc", 2), (200, "xy é", 3), (16, "a", 4)])
def test_cut_equals_brute_force(spark, length, alphabet, seed):
    r = random.Random(seed)
    shared = ["".join(r.choice(alphabet) for _ in range(r.choice([length // 2, length, length + 3, 2 * length, 5 * length]))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [r.choice([r.choice(shared)[r.randrange(3) :], "".join(r.choice(alphabet + "qwertz") for _ in range(r.randrange(1, 30)))]) for _ in range(r.randrange(5))]
        texts.append("".join(parts))
    texts += [None, "", texts[5], texts[5], texts[7]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: x for x in suffix_dedup.remove_repeats(docs, length=length).collect()}
    for i, (kept, covered) in enumerate(brute_cut([(t or "").encode() for t in texts], length)):
        assert bytes(got[i]["kept"]) == kept
        assert [s["begin"] for s in got[i]["spans"]] == runs(covered)


def test_batches_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 700)
    r = random.Random(9)
    passage = "".join(r.choice("abcdefgh ") for _ in range(330))
    texts = [("".join(r.choice("abcdefgh ") for _ in range(r.randrange(200)))) + passage[k : k + 260] for k in range(0, 70, 7)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {x["doc_id"]: bytes(x["kept"]) for x in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {i: k for i, (k, _) in enumerate(brute_cut([t.encode() for t in texts], 200))}


def test_covers():
    for length in (1, 2, 3, 8, 16, 50, 200, 1000):
        modulus, cover = suffix_dedup.difference_cover(length)
        assert modulus <= length and {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def test_cut_on_edges(edges, nothing):
    got = suffix_dedup.remove_repeats(edges, ("doc_id", "batch", "spans")[:2]).collect()
    assert len(got) == len(EDGES)
    by = {r["doc_id"]: r for r in got}
    assert bytes(by[6]["kept"]) == b"" and len(by[7]["kept"]) == len(" tail")
    assert by[6]["spans"] == [(0, len(LONG))] and by[6]["batch"] == 7
    assert bytes(by[8]["kept"]) == b""  # one letter, 5,000 times
    text = {r["doc_id"]: r["kept"] for r in suffix_dedup.remove_repeats(edges, as_text=True).collect()}
    assert text[-9] == EDGES[-2][1]
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_half_characters_go(spark):
    docs = spark.createDataFrame([(1, "q" + "é" * 150), (2, "Ã" + "é" * 150)], "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in suffix_dedup.remove_repeats(docs, as_text=True).collect()}
    assert got == {1: "q", 2: ""} or got == {1: "q", 2: "Ã"}
    assert hashlib.sha256(b"").hexdigest()

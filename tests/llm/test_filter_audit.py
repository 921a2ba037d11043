"""Filter audit against a walk through every order."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tickerloom.llm import filter_audit
from tickerloom.sources.workspace import workspace

from .conftest import EDGES, LONG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """Letters that each row fails."""
    out = []
    smallest: dict = {}
    for d, text, _ in rows:
        if d is not None:
            smallest[text or ""] = min(d, smallest.get(text or "", d))
    for d, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        out.append(fails + "E" * (d is not None and smallest[text] < d))
    return out


def walked(rows, labels):
    fails = failures(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {p or "" for *_, p in rows}:
        mine = [(d, f) for (d, _, p), f in zip(rows, fails, strict=True) if (p or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, own in enumerate(order, 1):
                gone = [d for d, f in left if own in f]
                left = [(d, f) for d, f in left if own not in f]
                total[own] += len(gone)
                redundant = sum(own in f for _, f in mine) - len(gone)
                figures = (len(left), len(gone), redundant, sum(f == own for _, f in mine), sum(d in good for d in gone), sum(d in toxic for d in gone))
                out[part, "".join(order), step] = figures
        for (p, order, step), figures in list(out.items()):
            if p == part:
                out[p, order, step] = (*figures, total[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def documents():
    texts = [" ".join(f"w{i}x{k}" for i in range(120)) for k in range(3)]
    texts += [texts[0].upper(), texts[1] + " #", "few words", "FEW $ WORDS", "same " * 150, "SAME " * 150 + "|", "", None, " \t\n"]
    rows = []
    for i in range(150):
        rows.append((i % 61 if i % 9 else None, texts[(i * 7) % len(texts)], ["en", "de", None, "x"][i % 4]))
    rows += [(d, t, p) for d, t, p, _ in EDGES] + [(90, LONG.upper(), "en"), (91, "é" * 900 + "A" * 100, "en"), (92, "A" + "é" * 9, "en")]
    return rows


LABELS = [(i, i % 3 % 2, i % 5 == 0) for i in range(0, 61, 2)] + [(4, 1, False), (None, 1, True), (7, None, None), (5000, 1, True)]


@pytest.mark.parametrize("extra", [False, True])
def test_audit_equals_a_walk_through_every_order(spark, extra):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(d, q, int(t) if t is not None else None) for d, q, t in LABELS], "doc_id long, quality int, toxic int")
    if extra:
        for name in ("part", "words", "text_key", "row", "at", "n", "good", "fails_A"):
            docs, labels = docs.withColumn(name, F.lit(7)), labels.withColumn(name, F.lit(7))
    got = sorted(tuple(r) for r in filter_audit.audit(docs, labels).collect())
    assert got == walked(rows, LABELS)
    assert len(got) == 6 * 120 * 5  # parts: en, de, fr, ja, x and none


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "Words.", None)], docs.schema)
    rows = filter_audit.audit(one, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""} and sum(r["good_lost"] + r["toxic_lost"] for r in rows) == 0
    assert sum(r["removed"] for r in rows) == 120


def test_any_filters_by_their_relations(spark):
    rows = spark.range(10).selectExpr("id AS row", "'p' AS part", "1L AS good", "0L AS toxic")
    failing = {"X": spark.range(0, 6).withColumnRenamed("id", "row"), "Y": spark.range(4, 7).withColumnRenamed("id", "row")}
    got = filter_audit.interactions(rows, failing, workspace(spark)).collect()
    assert sorted((r["filter_order"], r["step"], r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in got) == [
        ("XY", 1, 4, 6, 0, 4, 10),
        ("XY", 2, 3, 1, 2, 1, 4),
        ("YX", 1, 7, 3, 0, 1, 4),
        ("YX", 2, 3, 4, 2, 4, 10),
    ]

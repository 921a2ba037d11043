import random

import duckdb
import pytest

import corpus_pipeline
from tests.oracle_compare import compare, duck
from tickerloom.llm import quality_net
from tickerloom.llm.queries import ORACLES, QUERIES

from .conftest import EDGES
from .test_join_dedup import brute, brute_cut

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS).selectExpr("*", "1 AS n", "2 AS rep", "'x' AS kept")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    result, *_ = compare(spark, duck(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name])
    assert result.startswith("ok"), result


def test_stages_are_as_asked():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "pii", "packing"]


def test_near_duplicates_leave_one(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(10**5)}" for _ in range(120)]
    rows = [(9, " ".join(base)), (4, " ".join(base[:60] + ["new"] + base[60:])), (7, " ".join(f"q{i}" for i in range(50))), (8, None), (None, "x"), (2, ""), (1, "a b")]
    got = corpus_pipeline.keep_one_of_near(spark, frame(spark, rows), "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    kept = {r["doc_id"] for r in got.collect()}
    assert kept == {4, 7, 8, None, 2, 1}
    want = brute(rows, 5, 80)
    assert kept == {d for d, _, c in want if d == c}


def test_repeats_are_cut(spark):
    r = random.Random(1)
    passage = "".join(r.choice("abcdefghij é") for _ in range(260))
    rows = [(1, "start " + passage), (2, passage + "ü end"), (3, "clean " * 5), (4, None), (None, passage)]
    got = {x["doc_id"]: x for x in corpus_pipeline.cut_repeats(spark, frame(spark, rows), "").collect()}
    for (doc_id, text), (kept, _) in zip(rows, brute_cut([(t or "").encode() for _, t in rows], 200), strict=True):
        assert got[doc_id]["text"] == (kept.decode("utf-8", "ignore") if text is not None else None)
    assert got[3]["n_chars"] == 30 and got[4]["text"] is None


def test_private_data_goes(spark):
    rows = [(1, "mail the.65@mail7.example.com now"), (2, "nothing"), (3, None)]
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.hide_private(spark, frame(spark, rows), "").collect()}
    assert "mail7" not in got[1] and got[2] == "nothing" and got[3] is None


def test_quality_keeps_clean(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(quality_net, "EPOCHS", 6)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall()
    good = [d in ids for d, q in labels if q == 1]
    assert sum(good) / len(good) > 0.97


def test_stages_on_edges(spark, edges, nothing, monkeypatch, sf_dir):
    monkeypatch.setattr(quality_net, "EPOCHS", 1)
    for rows, n in ((edges, len(EDGES)), (nothing, 0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, rows, sf_dir)
            if name != "packing":
                assert got.columns == list(corpus_pipeline.COLUMNS)
            assert got.count() <= (n if name != "packing" else 10**9)

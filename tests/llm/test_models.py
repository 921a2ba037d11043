import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import language_id as li
from tickerloom.llm import quality_net as qn

from .conftest import EDGES


def corpus(seed, n):
    r = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ten", "ra", "sul", "vo"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(r.randrange(20, 120))]
        good = r.random() < 0.6
        if not good:
            words = [w + r.choice(["###", "%%%", "&&&"]) for w in words] if r.random() < 0.5 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), int(good)))
    return rows


@pytest.fixture(scope="module")
def network():
    rows = corpus(1, 160)
    n = qn.Network()
    n.fit([t for _, t, _ in rows], np.array([y for *_, y in rows]))
    return n


def test_network_separates_unseen_texts(network):
    rows = corpus(2, 200)
    got = network.scores([t for _, t, _ in rows]) >= 0.5
    assert np.mean(got == np.array([y for *_, y in rows], bool)) > 0.97


def test_whole_long_texts_count(network):
    good = " ".join(t for _, t, y in corpus(3, 300) if y)
    bad = " ".join(t for _, t, y in corpus(4, 40) if not y)
    plain, spoiled = network.scores([good, good + " " + bad])
    assert plain > 0.5 and spoiled < plain - 1e-4  # the end of a long text is read


def test_scores_do_not_depend_on_company_or_blocks(network, monkeypatch):
    texts = [t for _, t, _ in corpus(5, 20)] + ["", None, "é" * 7, "x" * 3000]
    together = network.scores(texts)
    assert np.allclose(together, [network.scores([t])[0] for t in texts], atol=1e-6)
    monkeypatch.setattr(qn, "BLOCK", 3)
    assert np.allclose(together, network.scores(texts), atol=1e-6)
    assert np.all((together >= 0) & (together <= 1))


def test_gradient_equals_differences():
    r = np.random.default_rng(0)
    texts, labels = ["abc def " * 40, "xyz", "q" * 130, "mixed Text 12" * 9], np.array([1, 0, 1, 0], np.float32)
    n = qn.Network()
    n.p = {k: v.astype(np.float64) for k, v in n.p.items()}
    x = qn.Layout(texts)

    def loss():
        z = n._top(x, n.chunk_features(x))[2].astype(np.float64)
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    gradient = n._gradient(x, labels)
    for name in ("w", "c", "u", "d", "bias"):
        flat, g = n.p[name].reshape(-1), gradient[name].reshape(-1)
        for i in r.integers(0, len(flat), 4):
            before, step = flat[i], 1e-2
            flat[i] = before + step
            up = loss()
            flat[i] = before - step
            down = loss()
            flat[i] = before
            assert abs((up - down) / (2 * step) - g[i]) < 0.02 + 0.1 * abs(g[i]), name


def test_quality_rows(spark, edges, nothing, monkeypatch):
    monkeypatch.setattr(qn, "EPOCHS", 4)
    rows = corpus(6, 120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (5, None, 0), (7, 9, 0)], "doc_id long, quality int, toxic int")
    network = qn.train(docs, labels, lambda d: d % 5 != 0)
    got = {r["doc_id"]: r for r in qn.score(docs, network).collect()}
    assert len(got) == 120 and all((r["score"] >= 0.3) == bool(r["predicted"]) for r in got.values())
    held = [(got[i]["predicted"], y) for i, _, y in rows if i % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.85
    assert qn.score(edges, network).count() == len(EDGES)
    assert qn.score(nothing, network).count() == 0
    untrained = qn.train(docs, labels.limit(0), lambda d: F.lit(True))
    assert qn.score(edges, untrained).count() == len(EDGES)


def languages(seed, n):
    r = random.Random(seed)
    kinds = {"aa": ["the", "ing", "and", "er"], "bb": ["que", "ción", "los", "ñ"], "cc": ["sch", "ung", "ein", "ü"]}
    out = []
    for i in range(n):
        lang = r.choice(list(kinds))
        out.append((i, " ".join("".join(r.choice(kinds[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(3, 40))), lang))
    return out


def brute_model(texts):
    """Interpolated Kneser-Ney by the book: a function from four characters to a probability."""
    level = {4: Counter()}
    for t in texts:
        level[4].update(int(g) for g in li.grams(t))
    for k in (3, 2, 1):
        level[k] = Counter(g & ((1 << 16 * k) - 1) for g in level[k + 1])
    discount, total, kinds = {}, {}, {}
    for k, counts in level.items():
        n1, n2 = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        discount[k] = min(0.95, max(0.05, n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5))
        total[k], kinds[k] = defaultdict(int), defaultdict(int)
        for g, c in counts.items():
            total[k][g >> 16] += c
            kinds[k][g >> 16] += 1

    def p(g, k=4):
        g &= (1 << 16 * k) - 1
        rest = p(g, k - 1) if k > 1 else 1 / 65536
        context = g >> 16
        if not total[k][context]:
            return rest
        return max(level[k][g] - discount[k], 0) / total[k][context] + discount[k] * kinds[k][context] / total[k][context] * rest

    return p


def test_models_equal_brute_force(spark):
    rows = languages(1, 60)
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    texts = [t for _, t, _ in languages(2, 10)] + ["zzz the que", "Ω"]
    got = model.cross_entropies(texts)
    for column, lang in enumerate(model.languages):
        p = brute_model([t for _, t, x in rows if x == lang])
        for i, t in enumerate(texts):
            g = [int(x) for x in li.grams(t)]
            want = -sum(math.log(p(x)) for x in g) / len(g)
            # Hashing may merge a few of the entries.
            assert abs(got[i, column] - want) < 0.02, (lang, t)


def test_sequences_are_told_apart_by_themselves(spark, monkeypatch):
    """Unseen sequences back off whatever places they share with seen ones, in arrays and in a table."""
    rows = languages(1, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    shared = li.train(docs)
    seen = {int(g) for _, t, _ in rows for g in li.grams(t)}
    taken = set(li.place(np.array(sorted(seen), np.uint64)).tolist())
    r = random.Random(5)
    letter = lambda: chr(r.randrange(0x4E00, 0x9FA5))
    words = ["".join(letter() for _ in range(4)) for _ in range(60_000)]
    keys = np.array([int(li.grams(w)[1]) for w in words], np.uint64)
    hits = [w for w, x in zip(words, li.place(keys).tolist(), strict=True) if x in taken][:5]
    assert hits
    texts = [*hits, "the que sch", "Ω", "12", None]
    monkeypatch.setattr(li, "SHARED_CELLS", 0)
    table = li.train(docs)
    assert shared.table is None and table.table is not None
    tried = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["entropies"] for x in li.entropies(tried, table, ["doc_id"]).collect()}
    arrays = shared.cross_entropies(texts)
    for column, lang in enumerate(shared.languages):
        p = brute_model([t for _, t, x in rows if x == lang])
        for i, t in enumerate(texts[:-2]):
            want = -sum(math.log(p(int(g))) for g in li.grams(t)) / len(li.grams(t))
            assert abs(arrays[i, column] - want) < 1e-4 and abs(got[i][column] - want) < 1e-4, (lang, t)
    assert got[len(texts) - 1] is None and got[len(texts) - 2] is None
    decided = [{x["doc_id"]: (x["lang_pred"], x["rejected"]) for x in li.identify(tried, m).collect()} for m in (shared, table)]
    assert decided[0] == decided[1] and len(decided[0]) == len(texts)


def test_any_number_of_languages(spark, monkeypatch):
    rows = [(i, f"{chr(0x4E00 + i) * 3} {chr(0x5E00 + i) * 2}", f"l{i:02d}") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for cells in (li.SHARED_CELLS, 0):
        monkeypatch.setattr(li, "SHARED_CELLS", cells)
        model = li.train(docs)
        assert len(model.languages) == 70 and (model.table is None) == (cells > 0)
        got = {r["doc_id"]: r["lang_pred"] for r in li.identify(docs, model).collect()}
        assert got == {i: lang for i, _, lang in rows}


def test_rejection_limits_come_from_all_training_rows(spark, monkeypatch):
    monkeypatch.setattr(li, "CALIBRATION", 10)
    rows = languages(4, 120)
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for i, lang in enumerate(model.languages):
        own = model.cross_entropies([t for _, t, x in rows if x == lang])[:, i]
        assert len(own) >= 20 and abs(model.limits[i] - 1.2 * own.max()) < 1e-6  # of so few, the quantile is the maximum


def test_probabilities_sum_to_one():
    p = brute_model([t for _, t, x in languages(1, 60) if x == "aa"])
    context = int(li.grams("the and")[2]) >> 16
    assert abs(sum(p(context << 16 | c) for c in range(65536)) - 1) < 1e-6


def test_languages_are_told_apart(spark, edges, nothing):
    rows = languages(3, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = li.train(docs.filter(~held))
    got = {r["doc_id"]: r for r in li.identify(docs, model).collect()}
    test = [(got[i]["lang_pred"], x) for i, _, x in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(a == b for a, b in test) / len(test) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    odd = {r["doc_id"]: r for r in li.identify(edges, model).collect()}
    for i in (3, 4, 5):
        assert (odd[i]["lang_pred"], odd[i]["score"], odd[i]["rejected"]) == ("und", 0.0, True)
    assert odd[-9]["rejected"] and odd[-9]["lang_pred"] in model.languages
    assert li.identify(edges, model).count() == len(EDGES) and li.identify(nothing, model).count() == 0
    none = li.train(nothing)
    assert {r["lang_pred"] for r in li.identify(edges, none).collect()} == {"und"}


def test_grams():
    assert len(li.grams("1 2 !")) == 0 and len(li.grams("")) == 0
    assert li.grams("A1b").tolist() == li.grams(" a  b ").tolist()
    sequences = np.array([1, 2**40 + 77, 2**63 + 12345], np.uint64)
    assert li.place(sequences).max() < li.PLACES


def test_places_agree(spark):
    values = [0, 77, 2**40 + 5, 2**62 + 9, -3]
    got = [r["p"] for r in spark.createDataFrame([(v,) for v in values], "g long").select(li.place_sql(F.col("g")).alias("p")).collect()]
    assert got == li.place(np.array(values, np.int64).view(np.uint64)).tolist()

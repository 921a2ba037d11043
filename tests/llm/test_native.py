import hashlib
import random
import re
from datetime import date, timedelta

import xxhash
from pyspark.sql import functions as F

from tickerloom.llm import order_minhash as om
from tickerloom.llm import pseudonyms as ps

from .conftest import EDGES

PYTHON = re.compile(ps.PATTERN.replace("++", "+").replace("}+", "}"))


def _f(kind, number, value, modulus):
    digest = hashlib.sha256(f"{ps.KEY}/{kind}/{number}/{value}".encode()).hexdigest()
    return int(digest[:13], 16) % modulus


def _feistel(a, b, size_a, size_b, kind):
    for i in range(1, ps.ROUNDS + 1):
        a = (a + _f(kind, i, b, size_a)) % size_a
        b = (b + _f(kind, -i, a, size_b)) % size_b
    return a, b


def _permute(digits, kind):
    n, left = len(digits), len(digits) // 2
    a, b = _feistel(int(digits[:left]), int(digits[left:]), 10**left, 10 ** (n - left), f"{kind}-{n}")
    return f"{a:0{left}d}{b:0{n - left}d}"


def _check(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c)
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 == 0 else d
    return str((10 - total % 10) % 10)


def _put(shape, digits):
    it = iter(digits)
    return "".join(next(it) if c.isascii() and c.isdigit() else c for c in shape)


def _replace(x):
    d = re.sub("[^0-9]", "", x)
    digest = lambda kind: hashlib.sha256(f"{ps.KEY}/{kind}/{x}".encode()).hexdigest()
    if "@" in x:
        return f"u{digest('mail')[:16]}@mail.invalid"
    if re.fullmatch("[0-9a-f]{32,64}", x):
        return (digest("secret") + digest("more"))[: len(x)]
    if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", x):
        o = [int(p) for p in x.split(".")]
        a, b = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "address")
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)|(\d\d)[./](\d\d)[./](\d{4})", x):
        y, mo, da = (m[1], m[2], m[3]) if m[1] else (m[6], m[5], m[4])
        try:
            day = date(int(y), int(mo), int(da))
        except ValueError:
            return x
        n = (day - date(1900, 1, 1)).days
        a, b = _feistel(n // ps.DAYS_B, n % ps.DAYS_B, ps.DAYS_A, ps.DAYS_B, "day")
        new = date(1900, 1, 1) + timedelta(a * ps.DAYS_B + b)
        return new.isoformat() if m[1] else new.strftime(f"%d{x[2]}%m{x[2]}%Y")
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", x):
        return _put(x, _permute(d, "social"))
    if re.fullmatch(r"\d{13,19}|\d{4}([ -]\d{4}){3}", x):
        if _check(d[:-1]) != d[-1]:
            return x
        p = _permute(d[:-1], "card")
        return _put(x, p + _check(p))
    return _put(x, d[:-10] + _permute(d[-10:], f"telephone{d[:-10]}"))


CASES = [
    "card 4403671232340912 and 4403671232340912, not 6636245707781942.",
    "4403-6712-3234-0912 in groups; 12345678901234567890 is too long",
    "mail the.65@mail7.example.com, a@b or x@y.z; (the.65@mail7.example.com)",
    "call +1 (459) 555-9246 or 459-555-9246 or (459) 555-9246 or 459.555.9246",
    "at 177.77.100.86 not 300.1.1.1 nor 1.2.3.4.5 v1.2.3",
    'token = "027aea05eb92c454086e6575cd38d76a884aab12", plain deadbeefdeadbeefdeadbeefdeadbeefdead',
    "born 1987-02-28 not 1987-02-30 or 28.02.1987 or 31/12/1999; 2100-01-01",
    "ssn 123-45-6789 and 1123-45-67890",
    "nothing here, 12 items for 3.50 at 10:30",
    "4403671232340912é 日本 4403671232340912",
]


def test_pseudonyms_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in ps.pseudonymise(docs).collect()}
    for i, text in enumerate(CASES):
        found = PYTHON.findall(text)
        assert got[i]["text"] == PYTHON.sub(lambda m: _replace(m[0]), text), text
        assert got[i]["n_replaced"] == sum(_replace(x) != x for x in found)
    assert got[0]["n_replaced"] == 2 and "6636245707781942" in got[0]["text"] and "4403671232340912" not in got[0]["text"]
    assert got[8]["text"] == CASES[8]


def test_capitals_hide_nothing_and_keep_links(spark):
    secret, mail = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b", "the.65@mail7.example.com"
    texts = [f'token = "{secret}" of {mail}', f'TOKEN = "{secret.upper()}" OF {mail.upper()}', f"{secret.capitalize()} A{secret[1:]}", "DEADBEEF" * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in ps.pseudonymise(docs).collect()}
    new, address = _replace(secret), _replace(mail)
    assert got[0]["text"] == f'token = "{new}" of {address}'
    assert got[1]["text"] == f'TOKEN = "{new.upper()}" OF {address}'
    assert got[2]["text"] == f"{new} {_replace('a' + secret[1:])}"
    assert [got[i]["n_replaced"] for i in range(4)] == [2, 2, 2, 0] and got[3]["text"] == texts[3]


def test_permutations_are_one_to_one(spark):
    digits = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    out = digits.select(ps.permute_digits(F.col("d"), "k", F.lit("t")).alias("x"))
    assert out.distinct().count() == 10_000 and out.filter("x rlike '^[0-9]{4}$'").count() == 10_000
    days = spark.range(73_170).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("d"))
    moved = days.select(ps._day(F.col("d"), "k").alias("x"))
    assert moved.distinct().count() == 73_170 and moved.filter("try_to_date(x) is null").count() == 0


def test_pseudonyms_on_edges(edges, nothing):
    got = ps.pseudonymise(edges)
    assert got.columns == [*edges.columns, "n_replaced"]
    assert sorted(map(str, (r["text"] for r in got.collect()))) == sorted(str(t) for _, t, *_ in EDGES)
    assert ps.pseudonymise(nothing).count() == 0


def _xx(*values, size=None):
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(size if isinstance(size, int) else 8, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, h)
    return h


def _occurrence(value, k):
    return xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(value.to_bytes(8, "little"), 42))


def sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
    if not words:
        return [om.EMPTY] * om.TUPLES
    made = [(_xx(*words[i : i + om.RUN]) >> 25, i) for i in range(max(1, len(words) - om.RUN + 1))]
    seen: dict = {}
    runs = []
    for value, place in sorted(made):
        k = seen.get(value, 0)
        seen[value] = k + 1
        # The second occurrence is the first that is renumbered, from 0.
        runs.append((value, place) if k == 0 else (_occurrence(value, k - 1) >> 25, place))
    runs.sort()
    out = []
    for i in range(om.TUPLES):
        point = i * (1 << 39) // om.TUPLES
        ring = [r for r in runs if r[0] >= point] + [r for r in runs if r[0] < point]
        picked = sorted(ring[:2], key=lambda r: r[1])
        h = 42
        for value, _ in picked:
            h = xxhash.xxh64_intdigest(value.to_bytes(8, "little"), h)
        out.append(h >> (64 - om.BITS))
    return out


def test_fingerprints_equal_brute_force(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice(["a", "bb", "é", "word", f"w{r.randrange(99)}"]) for _ in range(n)) for n in (0, 1, 2, 3, 5, 40, 300)]
    texts += ["x" * 100, "  lead  and trail \n", "a a a a a a", "日本語 テキスト"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", om.fingerprint(F.col("text")).alias("s"))
    for row in rows.collect():
        assert row["s"] == sketch(texts[row["i"]]), texts[row["i"]][:40]


def test_order_counts(spark):
    a = [f"w{i}" for i in range(400)]
    texts = [" ".join(a), " ".join(a[200:] + a[:200]), " ".join(a[:200] + [f"z{i}" for i in range(200)]), " ".join(reversed(a))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", om.fingerprint(F.col("text")).alias("s"))
    s = {r["i"]: r["s"] for r in rows.collect()}
    near = lambda i: sum(x == y for x, y in zip(s[0], s[i], strict=True)) / om.TUPLES
    assert 0.3 < near(1) < 0.8 and 0.02 < near(2) < 0.5 and near(3) < 0.1


def test_neighbours(spark, edges, nothing, monkeypatch):
    monkeypatch.setattr(om, "BUCKET_ROWS", 3)
    r = random.Random(8)
    ids = r.sample(range(-50, 10**6), 40)
    rows = [(i, "".join(r.choice("ab é\n🎉 ") for _ in range(r.randrange(40))) or None) for i in ids]
    got = {x["doc_id"]: x for x in om.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["fingerprint"] == "".join(f"{x:06x}" for x in sketch(t))
        assert got[i]["edited_fingerprint"] == "".join(f"{x:06x}" for x in sketch(edited))
        assert got[i]["near_edited"] == sum(x == y for x, y in zip(sketch(t), sketch(edited), strict=True)) / om.TUPLES
        assert got[i]["near_next"] == sum(x == y for x, y in zip(sketch(t), sketch(after), strict=True)) / om.TUPLES
    assert om.compare_neighbours(edges).count() == len(EDGES)
    assert om.compare_neighbours(nothing).count() == 0
    one = om.compare_neighbours(edges.filter("doc_id = 2")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0

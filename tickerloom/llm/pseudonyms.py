"""Format-preserving pseudonyms for personal data, in DataFrame functions.

Card numbers, telephone numbers, social security numbers, network addresses and dates are
validated and then permuted within their format by a keyed Feistel network: the result has the
same length, separators and check digit or calendar validity, different values stay different,
and equal values stay equal in all documents.  Mail addresses and long hexadecimal secrets,
which have no small number format, become keyed digests of the same kind, equal for all
spellings in capitals or not; a secret without small letters gets a digest in capitals.  What
fails its check stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let

#: Replace in production; whoever has it can undo the permutations.
KEY = "pseudonym-key-1"
#: Rounds of each half.
ROUNDS = 5

MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
SECRET = r"(?<![A-Za-z0-9])(?=[0-9]*[a-fA-F])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,64}+(?![A-Za-z0-9])"
ADDRESS = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"
DAY = r"(?<![0-9-])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])"
DAY_FIRST = r"(?<![0-9./])(?:0[1-9]|[12][0-9]|3[01])[./](?:0[1-9]|1[0-2])[./](?:19|20)[0-9]{2}(?![0-9./]*[0-9])"
TELEPHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9A-Za-z.-])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{13,19})(?![0-9A-Za-z-])"
PATTERN = "|".join((MAIL, SECRET, ADDRESS, DAY, DAY_FIRST, SOCIAL, TELEPHONE, CARD))

#: The days that are permuted among themselves: DAYS_A * DAYS_B of them from FIRST_DAY.
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 271, 270


def _round(key: str, kind: Column, number: Column, value: Column, modulus: Column) -> Column:
    digest = F.sha2(F.concat_ws("/", F.lit(key), kind, number.cast("string"), value.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % modulus


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: Column, then: Callable[[Column, Column], Column]) -> Column:
    """``then`` of the permuted pair of ``a`` below ``size_a`` and ``b`` below ``size_b``.

    Each half in turn gets a keyed function of the other one added, modulo its size, which
    is a permutation of the pairs whatever the sizes.
    """
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def one(state: Column, number: Column) -> Column:
        new = (state["a"] + _round(key, kind, number, state["b"], size_a)) % size_a
        return let(
            new,
            lambda x: F.struct(x.alias("a"), ((state["b"] + _round(key, kind, -number, x, size_b)) % size_b).alias("b")),
        )

    numbers = F.array(*(F.lit(i) for i in range(1, ROUNDS + 1)))
    return F.aggregate(numbers, start, one, lambda s: then(s["a"], s["b"]))


def permute_digits(digits: Column, key: str, kind: Column) -> Column:
    """A string of 2 to 36 digits to another one of its length."""
    length = F.char_length(digits)
    left = F.floor(length / 2).cast("int")
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    kind = F.concat_ws("-", kind, length.cast("string"))
    return feistel(
        F.substring(digits, F.lit(1), left),
        F.substring(digits, left + 1, length),
        power(left),
        power(length - left),
        key,
        kind,
        lambda a, b: F.concat(F.lpad(a.cast("string"), left, "0"), F.lpad(b.cast("string"), length - left, "0")),
    )


def check_digit(payload: Column) -> Column:
    """Luhn's digit for a string of digits."""
    n = F.char_length(payload)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(payload, n - i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _put_back(shape: Column, digits: Column) -> Column:
    """The digits of ``shape`` replaced in order."""
    characters = F.split(shape, "")

    def character(c: Column, i: Column) -> Column:
        before = F.char_length(_digits(F.substring(shape, F.lit(1), i + 1)))
        return F.when(c.rlike("^[0-9]$"), F.substring(digits, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(characters, character), "")


def _number(found: Column, key: str) -> Column:
    """A card keeps a valid check digit; a number whose check digit is wrong is no card and stays."""

    def of(digits: Column) -> Column:
        n = F.char_length(digits)
        payload = F.substring(digits, F.lit(1), n - 1)
        valid = check_digit(payload) == F.substring(digits, n, F.lit(1))
        card = let(permute_digits(payload, key, F.lit("card")), lambda x: F.concat(x, check_digit(x)))
        return F.when(valid, card).otherwise(digits)

    return _put_back(found, let(_digits(found), of))


def _telephone(found: Column, key: str) -> Column:
    """The last ten digits are permuted; a country code stays."""

    def of(digits: Column) -> Column:
        n = F.char_length(digits)
        code = F.substring(digits, F.lit(1), n - 10)
        return F.concat(code, permute_digits(F.substring(digits, n - 9, F.lit(10)), key, F.concat(F.lit("telephone"), code)))

    return _put_back(found, let(_digits(found), of))


def _address(found: Column, key: str) -> Column:
    parts = F.split(found, r"\.")
    pair = lambda i: F.get(parts, F.lit(i)).cast("long") * 256 + F.get(parts, F.lit(i + 1)).cast("long")
    size = F.lit(65536).cast("long")
    octets = lambda x: [F.floor(x / 256).cast("string"), (x % 256).cast("string")]
    return feistel(pair(0), pair(2), size, size, key, F.lit("address"), lambda a, b: F.concat_ws(".", *octets(a), *octets(b)))


def _day(found: Column, key: str) -> Column:
    """A calendar day within the domain; text that is no day there stays."""
    first = F.to_date(F.lit(FIRST_DAY))
    iso = found.rlike("^[0-9]{4}-")
    separator = F.substring(found, 3, 1)
    day = F.when(iso, F.try_to_date(found, "yyyy-MM-dd")).otherwise(F.try_to_date(F.translate(found, "./", "--"), "dd-MM-yyyy"))
    number = F.datediff(day, first).cast("long")

    def written(a: Column, b: Column) -> Column:
        new = F.date_add(first, (a * DAYS_B + b).cast("int"))
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.replace(F.date_format(new, "dd-MM-yyyy"), F.lit("-"), separator))

    size = lambda n: F.lit(n).cast("long")
    moved = feistel(F.floor(number / DAYS_B), number % DAYS_B, size(DAYS_A), size(DAYS_B), key, F.lit("day"), written)
    return F.when((number >= 0) & (number < DAYS_A * DAYS_B), moved).otherwise(found)


def pseudonym(found: Column, key: str = KEY) -> Column:
    """The pseudonym of one match of ``PATTERN``."""
    digest = lambda kind: F.sha2(F.concat_ws("/", F.lit(key), F.lit(kind), F.lower(found)).cast("binary"), 256)
    secret = F.substring(F.concat(digest("secret"), digest("more")), F.lit(1), F.char_length(found))
    whole = lambda p: found.rlike(f"^(?:{p})$")
    return (
        F.when(found.contains("@"), F.concat(F.lit("u"), F.substring(digest("mail"), 1, 16), F.lit("@mail.invalid")))
        .when(whole(r"[0-9a-fA-F]{32,64}"), F.when(found.rlike("[a-f]"), secret).otherwise(F.upper(secret)))
        .when(whole(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"), _address(found, key))
        .when(whole(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4}"), _day(found, key))
        .when(whole(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), _put_back(found, permute_digits(_digits(found), key, F.lit("social"))))
        .when(whole(r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}"), _number(found, key))
        .otherwise(_telephone(found, key))
    )


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_replaced``.

    All rows and other columns stay.  Null text stays null with nothing replaced.  Each text
    is handled by itself, without shuffle; equal values get equal pseudonyms everywhere
    because they are a function of the key and the value alone.
    """
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))

    def spliced(matches: Column) -> Column:
        between = F.split(text, PATTERN, -1)
        return let(F.transform(matches, lambda m: pseudonym(m, key)), lambda new: joined(matches, between, new))

    def joined(matches: Column, between: Column, new: Column) -> Column:
        parts = F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        changed = F.zip_with(matches, new, lambda a, b: (a != b).cast("long"))
        n = F.aggregate(changed, F.lit(0).cast("long"), lambda s, x: s + x)
        made = F.struct(F.array_join(parts, "").alias("text"), n.alias("n"))
        kept = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
        return F.when(F.coalesce(F.size(matches), F.lit(0)) > 0, made).otherwise(kept)

    done = docs.withColumn("_made", let(found, spliced))
    return done.withColumn("text", F.col("_made")["text"]).withColumn("n_replaced", F.coalesce(F.col("_made")["n"], F.lit(0))).drop("_made")

"""Universe exclusion rules over security names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .flags import any_of

# Exclusion reasons and their patterns, in the order they are reported, each
# with the lower-case literals of which one occurs in every match.
UNIVERSE_RULES = (
    ("redeemable marker", r"(^|\s)-REDH\b|\bREDH\b", ("redh",)),
    ("redeemable security", r"\bREDEEM(?:ABLE)?\b", ("redeem",)),
    ("warrant security", r"\bWARRANTS?\b", ("warrant",)),
    ("rights security", r"\bRIGHTS?\b", ("right",)),
    ("unit security", r"\bUNITS?\b", ("unit",)),
    (
        "SPAC/acquisition company",
        r"\bACQUISITION\b|\bACQ(?:\.|\s|$)|\bACQUTN\b|\bBLANK CHECK\b|\bSPAC\b",
        ("acq", "blank check", "spac"),
    ),
)

# Letters that match an ASCII letter regardless of case but do not lower to it.
ODD_CASE = ("\u0130", "\u0131", "\u017f")

REASON_SEPARATOR = "; "


def search_text(ticker: str, name: str, iid: str) -> Column:
    """Ticker, name and issue joined by single spaces; NULL becomes empty, separators stay."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (ticker, name, iid)]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2])


def exclusion_reason(text: Column, folded: Column) -> Column:
    """Matching reasons in rule order joined by ``"; "``; empty when none match.

    ``folded`` is the lower-cased text.  A rule's expression only runs on texts that hold one
    of its literals, which a byte search finds much faster.  ``(?iU)``: case-insensitive, and
    word boundaries follow Unicode letters.
    """
    odd = any_of([F.contains(text, F.lit(c)) for c in ODD_CASE])
    hits = []
    for reason, pattern, literals in UNIVERSE_RULES:
        possible = any_of([F.contains(folded, F.lit(x)) for x in literals])
        hits.append(F.when((possible | odd) & text.rlike("(?iU)" + pattern), reason))
    return F.concat_ws(REASON_SEPARATOR, *hits)

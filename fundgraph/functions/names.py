"""Company-name expressions: cleaning, person test, token-sort similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import BLANK, _col, strip

# Legal and industry words removed from company names.
LEGAL_WORDS = (
    "LLC", "INC", "CORP", "LTD", "LP", "NA", "CO", "GROUP", "ADVISORS", "ADVISORY",
    "MANAGEMENT", "TRUST", "SERVICES", "FINANCIAL", "INVESTMENTS", "CAPITAL",
)

# Substrings that mark a name as a company.
COMPANY_MARKS = (
    "LLC", "INC", "CORP", "TRUST", "FUND", "MANAGEMENT", "ADVISORS", "FINANCIAL",
    "CAPITAL", "SERVICES", "GROUP", "INSURANCE", "RETIREMENT", "PENSION", "INVESTMENT",
)

#: Bits per word in the similarity: sums of two words and a carry stay below 2^63.
WORD_BITS = 62


def clean_name(c: Column | str) -> Column:
    """Upper-case letters, digits and single blanks, without legal and industry words."""
    words = r"\b(" + "|".join(LEGAL_WORDS) + r")\b"
    outer = f"^{BLANK}+|{BLANK}+$"
    steps = ((outer, ""), (words, ""), (r"[^A-Z0-9 ]", ""), (outer, ""), (f"{BLANK}+", " "))
    x = F.upper(_col(c))
    for pattern, replacement in steps:
        x = F.regexp_replace(x, pattern, replacement)
    return x


def is_person(c: Column | str) -> Column:
    """At most three words and no company mark anywhere in the name."""
    x = strip(c)
    words = F.when(x == "", F.lit(0)).otherwise(F.size(F.split(x, f"{BLANK}+")))
    return (words <= 3) & ~F.upper(_col(c)).rlike("|".join(COMPANY_MARKS))


def threshold(c: Column | str, by_length: bool = False) -> Column:
    """Similarity threshold: 85, or optionally 95 for names of up to five characters."""
    if not by_length:
        return F.lit(85)
    return F.when(F.length(strip(c)) <= 5, F.lit(95)).otherwise(F.lit(85))


def token_sort(c: Column | str) -> Column:
    """White-space tokens in sorted order, joined by one blank."""
    tokens = F.filter(F.split(_col(c), f"{BLANK}+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside lambdas.

    A lambda body evaluates what it captures for every element; a bound variable
    is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Longest common subsequence by the bit-parallel recurrence, for any length.

    Bit i of the state is 0 once position i of ``a`` is matched.  Each character
    of ``b`` updates the state with one addition, done in words of 62 bits with
    a carry so nothing overflows a BIGINT.
    """
    a, b = _col(a), _col(b)
    full = F.lit((1 << WORD_BITS) - 1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")

    def mask(chars: Column, sym: Column) -> Column:
        bits = F.transform(chars, lambda x, i: F.when(x == sym, F.call_function("shiftleft", one, i)).otherwise(zero))
        return F.aggregate(bits, zero, lambda s, v: s.bitwiseOR(v))

    def update(s: Column, m: Column, carry: Column) -> tuple[Column, Column]:
        total = s + s.bitwiseAND(m) + carry
        return total, total.bitwiseAND(full).bitwiseOR(s.bitwiseAND(F.bitwise_not(m)))

    def table(chars: Column) -> Column:
        """Distinct characters of a and their position masks."""
        syms = F.array_distinct(chars)
        return F.struct(syms.alias("syms"), F.transform(syms, lambda c: mask(chars, c)).alias("masks"))

    def short(t: Column) -> Column:
        def fold(s: Column, ch: Column) -> Column:
            at = F.array_position(t["syms"], ch).cast("int")
            return update(s, F.coalesce(F.get(t["masks"], at - 1), zero), zero)[1]

        # positions beyond the end of a stay 1, so the zeros count the matches
        return F.lit(WORD_BITS) - F.bit_count(F.aggregate(_chars(b), full, fold))

    def long(parts: Column) -> Column:
        """parts: the position masks of each 62-character piece of a."""

        def fold(state: Column, ch: Column) -> Column:
            init = F.struct(F.array().cast("array<bigint>").alias("out"), zero.alias("carry"))

            def word(acc: Column, t: Column) -> Column:
                at = F.array_position(t["syms"], ch).cast("int")
                s = F.get(state, F.size(acc["out"]))
                total, new = update(s, F.coalesce(F.get(t["masks"], at - 1), zero), acc["carry"])
                carry = F.call_function("shiftright", total, F.lit(WORD_BITS))
                return F.struct(F.concat(acc["out"], F.array(new)).alias("out"), carry.alias("carry"))

            return F.aggregate(parts, init, word, lambda acc: acc["out"])

        left = F.aggregate(_chars(b), F.transform(parts, lambda t: full), fold)
        return F.aggregate(left, F.lit(0), lambda n, w: n + F.lit(WORD_BITS) - F.bit_count(w))

    starts = F.sequence(F.lit(1), F.length(a), F.lit(WORD_BITS))
    pieces = F.transform(starts, lambda i: table(_chars(F.substr(a, i, F.lit(WORD_BITS)))))
    return (
        F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0))
        .when(F.length(a) <= WORD_BITS, _let(_chars(a), lambda ca: _let(table(ca), short)))
        .otherwise(_let(pieces, long))
    )


def sorted_ratio(a: Column | str, b: Column | str) -> Column:
    """Indel similarity 0..100 of two token-sorted strings; 100 when both are empty."""
    a, b = _col(a), _col(b)
    total = F.length(a) + F.length(b)
    return (
        F.when(a == b, F.lit(100.0))
        .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0))
        .otherwise(F.lit(200.0) * lcs_length(a, b) / total)
    )


def sorted_ratio_at_least(a: Column | str, b: Column | str, threshold: float) -> Column:
    """The ratio where it reaches the threshold, else null.

    The built-in edit distance never exceeds the Indel distance, so it settles
    most pairs before the longer computation.
    """
    a, b = _col(a), _col(b)
    room = F.floor((F.length(a) + F.length(b)) * (1 - threshold / 100.0) + 1e-9)
    score = F.when(F.levenshtein(a, b) <= room, sorted_ratio(a, b))
    return F.when(score >= threshold, score)


def token_sort_ratio(a: Column | str, b: Column | str) -> Column:
    return sorted_ratio(token_sort(a), token_sort(b))

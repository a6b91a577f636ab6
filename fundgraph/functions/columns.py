"""Cleaning and coercion expressions (all JVM-side)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a default CSV reader takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Plan entity codes.
FUND_TYPES = {1: "Single Employer", 2: "Multi Employer", 3: "Multiple Employer", 4: "DFE"}


#: White space as the original cleaning strips it: that of Unicode, and four separators of ASCII.
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

#: A decimal number: no type suffix, no hexadecimal form, no word.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

INTEGERS = ("int", "bigint")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_markers(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Turn the missing-value texts of the given string columns into nulls."""
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in names})


def computed(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` for values that rows are then filtered by: each is computed once per row.

    A filter on a plain column is moved below the projection with a copy of its whole expression, in
    which every text that it names is built again; no filter is moved below the one-row ``inline``.
    """
    kept = [c for c in df.columns if c not in cols]
    values = F.inline(F.array(F.struct(*[v.alias(c) for c, v in cols.items()])))
    return df.select(*kept, values).select(*df.columns, *[c for c in cols if c not in df.columns])


def normalize_ein(c: Column | str) -> Column:
    """Digits of an EIN without leading zeros or a ``.0`` tail; null when not numeric."""
    x = _col(c).cast("string")
    # short runs of digits, nearly all EINs, need none of the general steps
    plain = F.substring_index(x, ".", 1).try_cast("bigint").cast("string")
    return F.when(x.rlike(r"^[0-9]{1,15}([.]0)?$"), plain).otherwise(number(x).try_cast("bigint").cast("string"))


def strip(c: Column | str) -> Column:
    x = _col(c)
    # between two visible ASCII characters there is nothing to strip
    bare = F.ascii(x).between(33, 126) & F.ascii(F.substr(x, F.lit(-1))).between(33, 126)
    return F.when(bare, x).otherwise(F.regexp_replace(x, f"^{BLANK}+|{BLANK}+$", ""))


def number(c: Column | str) -> Column:
    """Text as a double; null unless all of it is a decimal number."""
    x = strip(_col(c).cast("string"))
    return F.when(x.rlike(NUMBER), x.try_cast("double"))


def to_int(c: Column | str, kind: str = "bigint") -> Column:
    """Whole number, also from text with a ``.0`` tail, exact in the whole range; null for anything else."""
    x = strip(_col(c).cast("string"))
    exact = F.when(x.rlike(NUMBER), x.try_cast("decimal(38,9)"))
    return F.when(exact == F.floor(exact), exact.try_cast(kind))


def pad_ein(c: Column | str) -> Column:
    """Nine-digit form of a normalised EIN (lost leading zeros put back)."""
    return F.when(_col(c).isNotNull(), F.lpad(_col(c), 9, "0"))


def norm_name(c: Column | str) -> Column:
    """Upper-case with all outer white space removed (``trim`` drops only blanks)."""
    return F.upper(strip(c))


def map_code(c: Column | str, names: Mapping[int, str] = FUND_TYPES, default: str = "Unknown") -> Column:
    pairs = [F.lit(v) for kv in names.items() for v in kv]
    return F.coalesce(F.create_map(*pairs)[to_int(c, "int")], F.lit(default))


def as_key(c: Column | str) -> Column:
    return _col(c).cast("string")


def to_num(c: Column | str, default: float | None = None) -> Column:
    """Number or default; text that is no number, NaN and infinities count as missing."""
    x = number(c)
    ok = F.when(F.abs(x) != float("inf"), x)
    return ok if default is None else F.coalesce(ok, F.lit(float(default)))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; null and NaN stay missing instead of becoming a bound."""
    x = _col(c).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.lit(float(lo)), F.least(x, F.lit(float(hi)))))


def guarded_ratio(top: Column | str, total: Column | str) -> Column:
    """top/total limited to [0,1] where x/0 is +-infinity before the limit and 0/0 is missing."""
    t, n = _col(top).cast("double"), _col(total).cast("double")
    zero = F.when(t > 0, F.lit(1.0)).when(t < 0, F.lit(0.0))
    return F.when(n == 0, zero).otherwise(clip(F.try_divide(t, n), 0, 1))


def fee_sum(c: Column | str) -> Column:
    """Exact decimal total; 0, not null, when every value is null."""
    return F.coalesce(F.sum(_col(c)), F.lit(0).cast("decimal(28,2)"))

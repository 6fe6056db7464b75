"""Column expressions shared by the operators.

All of these compile to built-in Catalyst expressions so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagelens.rules import FALSE_TOKENS, TRUE_TOKENS, TierRule


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def false_if_null(pred: Column) -> Column:
    """pandas comparisons are False on NaN; SQL's are NULL.  Pin to False
    before any negation so ``~cond`` behaves like the reference."""
    return F.coalesce(pred, F.lit(False))


# Any run of (Unicode) whitespace, as Python's ``\s`` matches it.
WHITESPACE_RUN = r"(?U)\s+"
# The characters ``str.strip()`` removes (for regex-free trimming).
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
                    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def normalize_text(c: str | Column) -> Column:
    """Collapse every (Unicode) whitespace run to one space, trim, blank -> null."""
    return F.nullif(F.trim(F.regexp_replace(col(c).cast("string"), WHITESPACE_RUN, " ")), F.lit(""))


def normalized_key(c: str | Column, lowercase: bool = True, already_normalized: bool = False) -> Column:
    """Whitespace-normalised text, null -> '', optionally lower-cased.
    ``already_normalized`` skips the regex for columns that went through
    ``normalize_strings`` (normalisation is idempotent)."""
    base = col(c) if already_normalized else F.trim(F.regexp_replace(col(c).cast("string"), WHITESPACE_RUN, " "))
    text = F.coalesce(base, F.lit(""))
    return F.lower(text) if lowercase else text


def coerce_double(c: str | Column) -> Column:
    """``pd.to_numeric(errors='coerce')``: unparseable -> null (ANSI-safe)."""
    return col(c).try_cast("double")


def parse_bool(c: str | Column) -> Column:
    """true/false/1/0/yes/no (any case, padded) -> boolean; anything else null."""
    token = F.lower(F.trim(col(c).cast("string")))
    return (F.when(token.isin(*TRUE_TOKENS), F.lit(True))
            .when(token.isin(*FALSE_TOKENS), F.lit(False)))


def isclose(a: str | Column, b: str | Column, rtol: float, atol: float) -> Column:
    """numpy.isclose: |a-b| <= atol + rtol*|b| (asymmetric in b)."""
    a, b = col(a), col(b)
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def right_closed_bucket(c: str | Column, tier: TierRule) -> Column:
    """``pd.cut`` semantics: bins (e0,e1], (e1,e2], ...; values outside -> null
    (or the tier's missing label).  ``ml.Bucketizer`` is left-closed, so the
    buckets are spelled out as a CASE chain instead."""
    x = col(c)
    edges, labels = tier.edges, tier.labels
    lowest = (x >= edges[0]) if tier.include_lowest else (x > edges[0])
    expr = None
    for i, label in enumerate(labels):
        lo_ok = lowest if i == 0 else (x > edges[i])
        cond = lo_ok & (x <= edges[i + 1])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if tier.missing_label is not None:
        expr = expr.otherwise(F.lit(tier.missing_label))
    return expr


# An item of a Python literal: a quoted string (with escapes), a number, or a
# named constant.  The repeats are possessive, so matching stays linear.
_ITEM = (r"""'(?:[^'\\\n]++|\\.)*+'|"(?:[^"\\\n]++|\\.)*+\""""
         r"""|[+-]?[0-9]++(?:\.[0-9]*+)?|True|False|None""")
_ITEMS = rf"(?:{_ITEM})(?:\s*,\s*(?:{_ITEM}))*+\s*,?"
# A whole list, set or tuple of such items; a tuple of one needs its comma.
_LITERAL = (rf"(?s)^\s*(?:\[\s*(?:{_ITEMS})?\s*\]|\{{\s*{_ITEMS}\s*\}}"
            rf"|\(\s*(?:(?:{_ITEM})\s*,\s*(?:{_ITEMS})?)?\s*\))\s*$")


def parse_skill_list(c: str | Column, sorted_distinct: bool = True) -> Column:
    """Text of a Python list, tuple or set -> array<string> of lower-cased,
    stripped, non-empty items; malformed or null text -> empty array.

    ``sorted_distinct`` gives the strict form (sorted set); without it the
    order and repeats of the source are kept (capstone / beginner)."""
    text = F.trim(col(c).cast("string"))
    items = F.regexp_extract_all(text, F.lit(_ITEM), 0)
    quoted = lambda s: F.regexp_replace(
        F.replace(F.replace(F.substring(s, F.lit(2), F.length(s) - 2), F.lit("\\n"), F.lit("\n")),
                  F.lit("\\t"), F.lit("\t")), r"\\(.)", "$1")
    value = lambda s: F.when(F.substring(s, 1, 1).isin("'", '"'), quoted(s)).otherwise(s)
    cleaned = F.transform(items, lambda s: F.lower(F.btrim(value(s), F.lit(WHITESPACE_CHARS))))
    cleaned = F.filter(cleaned, lambda s: F.length(s) > 0)
    if sorted_distinct:
        cleaned = F.array_sort(F.array_distinct(cleaned))
    is_list = F.coalesce(text.rlike(_LITERAL), F.lit(False))
    return F.when(is_list, cleaned).otherwise(F.array().cast("array<string>"))


def sum_columns(names: Iterable[str]) -> Column:
    names = list(names)
    total = F.lit(0)
    for n in names:
        total = total + F.col(n)
    return total


def attach_scalars(df, scalars):
    """Attach the columns of a global (un-grouped) aggregate to every row.

    Each column becomes a scalar subquery: Spark runs the one-row aggregate
    once (merging the subqueries of one aggregate into a single job), then
    reads it as a constant inside the projection.  No join of ``df`` at all,
    so no shuffle, no broadcast exchange and no nested-loop join."""
    return df.select("*", *[scalars.select(c).scalar().alias(c) for c in scalars.columns])


def attach_row(df, row):
    """``attach_scalars`` for a one-row table that is no plain aggregate: its
    plan runs once, as one struct, however many columns it has."""
    one = row.select(F.struct(*row.columns).alias("_row")).scalar()
    return df.withColumn("_row", one).select("*", *[F.col("_row")[c].alias(c) for c in row.columns]).drop("_row")


def g1_skew_correction(n: Column) -> Column:
    """Factor turning population skewness g1 into the bias-corrected G1."""
    return F.sqrt(n * (n - 1)) / (n - 2)

"""Spans of regular expressions as Spark SQL expressions.

A span is ``struct<start, end, kind, hit>``: code points, end exclusive, the
kind's number, and the matched string.  Matches are leftmost and do not
overlap; their places follow from the lengths of the pieces between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,kind:int,hit:string>"
NO_SPANS = f"array<{SPAN}>"


def no_spans() -> Column:
    return F.array().cast(NO_SPANS)


def span(start, end, kind, hit) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"),
                    kind.cast("int").alias("kind"), hit.alias("hit"))


def add_spans(df: DataFrame, text: str, kinds: dict[str, tuple[str, Column | None]], out: str) -> DataFrame:
    """Add column ``out``: the spans of every kind ``name -> (pattern, guard)``,
    numbered in the given order.  A guard is a cheap condition on the text
    without which the pattern cannot match."""
    hits = {f"_hits_{out}_{k}": (p, g) for k, (p, g) in enumerate(kinds.values())}
    none = F.array().cast("array<string>")
    df = df.withColumns({
        name: F.when(guard, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) if guard is not None
        else F.regexp_extract_all(text, F.lit(p), F.lit(0))
        for name, (p, guard) in hits.items()})
    df = df.withColumn(out, F.concat(*(_places(text, name, p, k) for k, (name, (p, _)) in enumerate(hits.items()))))
    return df.drop(*hits)


def _places(text: str, hits: str, pattern: str, kind: int) -> Column:
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(hits)).alias("gap"), F.col(hits).alias("hit"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span(start, end, F.lit(kind), x["hit"]))).alias("out"))

    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), no_spans().alias("out")), step, lambda acc: acc["out"])
    return F.when(F.size(hits) > 0, found).otherwise(no_spans())


def joined(spans: Column, names: list[str], by_kind: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined, by start then kind or
    by kind then start."""
    order = (lambda s: F.struct(s["kind"], s["start"], s["end"])) if by_kind else (
        lambda s: F.struct(s["start"], s["kind"], s["end"]))
    kinds = F.array(*map(F.lit, names))
    return F.array_join(F.transform(F.array_sort(F.transform(spans, order)), lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span (overlaps merged) replaced by ``mask``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        piece = F.when(fresh, F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.struct(
        acc["at"].alias("at"), acc["out"].alias("out")))
    return F.concat(done["out"], F.substr(text, done["at"] + 1))

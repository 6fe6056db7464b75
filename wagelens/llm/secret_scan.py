"""Secret scans (op2), Spark SQL expressions only.

Three fixed kinds are found by pattern.  The scan adds kind ``entropy``: over
every long candidate string a window slides along and its Shannon entropy
follows from incremental counts (one symbol enters, one leaves).  The symbols
in a window give its class, the last class takes all; a candidate with windows
that reach their class's threshold gives a span from the first to the last of
them, unless the allow list knows it.  Of a candidate that meets spans of a
fixed kind, the parts outside them are candidates.  One narrow pass, no shuffle.

Defined results: null text is empty and has no spans; repeated rows each give
a row; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import id_and_text
from wagelens.llm.spans import add_spans, count_kind, joined, masked, no_spans, span

ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind -> pattern.  The two runs have their least length in the pattern: a
#: shorter maximal run holds no longer one.
KINDS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
NAMES = [*KINDS, "entropy"]

WINDOW = 20
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Counted in a window: name -> first and last place in ``SYMBOLS``, from 1.
COUNTED = {"upper": (1, 26), "lower": (27, 52), "digit": (53, 62), "upper_hex": (1, 6), "lower_hex": (27, 32)}
#: Class -> (symbols, what a window must hold, bits it must reach); the first
#: that fits decides.  Few digits among letters of one case ask for more bits.
CLASSES = {
    "hex": (SYMBOLS, lambda n: (n["digit"] > 0) & (n["digit"] < WINDOW) & (
        n["digit"] + F.greatest(n["upper_hex"], n["lower_hex"]) == WINDOW), 3.0),
    "base64": (SYMBOLS, lambda n: (n["digit"] > 0) & (n["lower"] > 0) & (n["upper"] > 0), 3.8),
    "upper": (SYMBOLS, lambda n: (n["digit"] > 2) & (n["upper"] > 0), 3.5),
    "few_upper": (SYMBOLS, lambda n: (n["digit"] > 0) & (n["upper"] > 0), 3.6),
    "mixed": (SYMBOLS, lambda n: (n["digit"] > 2) & (n["lower"] > 0), 3.6),
    "few_mixed": (SYMBOLS, lambda n: (n["digit"] > 0) & (n["lower"] > 0), 3.75),
    "any": (SYMBOLS, lambda n: F.lit(True), 4.0),
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Strings of high entropy that are no secrets: identifiers in 8-4-4-4-12
#: form, paths and joined words of which every segment is a short word with at
#: most four digits, and runs through an alphabet.
ALLOWED = (r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$"
           r"|^[/_=-]*(?:(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15})[0-9]{0,4}|[0-9]{1,4})(?:[/_=-]+(?:(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15})[0-9]{0,4}|[0-9]{1,4}))*[/_=-]*$"
           r"|(?i:example|0123456789|abcdefgh|placeholder|xxxxx)")
#: Fewer different symbols cannot reach any class's bits.
LEAST_SYMBOLS = math.ceil(2 ** min(bits for _, _, bits in CLASSES.values()))


def _weighted(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def window_bits(n: Column) -> Column:
    """Bits that a window must reach, from its counts of ``COUNTED``."""
    out = F.lit(math.inf)
    for _, holds, bits in reversed(CLASSES.values()):
        out = F.when(holds(n), F.lit(bits)).otherwise(out)
    return out


def hot_windows(hit: Column, symbols: str = SYMBOLS, bits: float | None = None, window: int = WINDOW) -> Column:
    """First start and last end of the windows of ``hit`` with at least
    ``bits`` of entropy (none given: those of the window's class), as a struct
    (null ends: none)."""
    codes = F.transform(F.split(hit, ""), lambda c: F.instr(F.lit(symbols), c))
    # Spark's split by "" leaves an empty string at the end in some versions.
    codes = F.filter(codes, lambda c: c > 0)
    zero = F.struct(
        F.array_repeat(F.lit(0), len(symbols)).alias("n"), F.lit(0.0).alias("s"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
        F.struct(*(F.lit(0).alias(c) for c in COUNTED)).alias("held"))

    def step(acc, i, codes):
        enters, leaves = codes[i], F.when(i >= window, codes[i - window]).otherwise(F.lit(0))
        up = F.element_at(acc["n"], enters)
        n = F.transform(acc["n"], lambda v, k: v + (k + 1 == enters).cast("int"))
        # Sum of c log c over the counts: entropy is log2(window) - s / window.
        s = acc["s"] + _weighted(up + 1) - _weighted(up)
        down = F.when(leaves > 0, F.element_at(n, F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
        s = s + F.when(leaves > 0, _weighted(down - 1) - _weighted(down)).otherwise(F.lit(0.0))
        n = F.transform(n, lambda v, k: v - (k + 1 == leaves).cast("int"))
        held = F.struct(*((acc["held"][c] + enters.between(a, b).cast("int") - leaves.between(a, b).cast("int")).alias(c) for c, (a, b) in COUNTED.items()))
        need = window_bits(held) if bits is None else F.lit(bits)
        hot = (i >= window - 1) & (F.lit(math.log2(window)) - s / window >= need)
        return F.struct(
            n.alias("n"), s.alias("s"),
            F.when(hot, F.coalesce(acc["first"], i - window + 1)).otherwise(acc["first"]).alias("first"),
            F.when(hot, i + 1).otherwise(acc["last"]).alias("last"), held.alias("held"))

    walked = F.transform(F.array(codes), lambda codes: F.aggregate(
        F.sequence(F.lit(0), F.size(codes) - 1), zero, lambda acc, i: step(acc, i, codes),
        lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last"))))
    return F.when(F.length(hit) >= window, walked[0])


def outside(candidates: Column, base: Column) -> Column:
    """The parts of candidate spans that lie outside the base spans."""
    ordered = F.array_sort(F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))

    def parts(c):
        piece = lambda a, z: span(a, z, F.lit(0), F.substring(c["hit"], a - c["start"] + 1, z - a))

        def step(acc, b):
            ahead = (b["start"] < c["end"]) & (b["end"] > c["start"])
            gap = F.when(ahead & (b["start"] > acc["at"]), F.array(piece(acc["at"], b["start"]))).otherwise(no_spans())
            return F.struct(F.when(ahead, F.greatest(acc["at"], b["end"])).otherwise(acc["at"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

        return F.aggregate(ordered, F.struct(c["start"].alias("at"), no_spans().alias("out")), step, lambda acc: F.concat(
            acc["out"], F.when(acc["at"] < c["end"], F.array(piece(acc["at"], c["end"]))).otherwise(no_spans())))

    return F.filter(F.flatten(F.transform(candidates, parts)), lambda c: F.length(c["hit"]) >= WINDOW)


def entropy_spans(candidates: Column, base: Column) -> Column:
    """Spans of kind ``entropy`` among the parts of candidates outside the base spans."""
    free = F.filter(outside(candidates, base), lambda c: ~F.regexp_like(c["hit"], F.lit(ALLOWED)) & (
        F.size(F.array_distinct(F.split(c["hit"], ""))) >= LEAST_SYMBOLS))
    hot = F.filter(F.transform(free, lambda c: F.struct(c["start"].alias("at"), c["hit"].alias("hit"), hot_windows(c["hit"]).alias("found"))),
                   lambda x: x["found"]["first"].isNotNull())
    return F.transform(hot, lambda x: span(
        x["at"] + x["found"]["first"], x["at"] + x["found"]["last"], F.lit(len(KINDS)), x["hit"]))


def scan(docs: DataFrame) -> DataFrame:
    """Columns ``doc_id``, ``base`` and ``spans`` (arrays of spans)."""
    return id_and_text(docs).transform(with_secrets, F.coalesce("text", F.lit(""))).select("doc_id", "base", "spans")


def with_secrets(df: DataFrame, text: Column) -> DataFrame:
    df = df.withColumn("_text", text)
    df = add_spans(df, "_text", {k: (p, None) for k, p in KINDS.items()}, "_base")
    whole = F.filter("_base", lambda s: (s["kind"] != 0) | (
        F.length(F.regexp_extract(s["hit"], "^" + ASSIGN, 1)) >= 6))
    df = df.withColumn("base", whole)
    df = add_spans(df, "_text", {"candidate": (CANDIDATE, F.regexp_like("_text", F.lit(CANDIDATE)))}, "_long")
    added = F.when(F.size("_long") > 0, entropy_spans(F.col("_long"), F.col("base"))).otherwise(no_spans())
    return df.withColumn("spans", F.concat("base", added)).drop("_text", "_base", "_long")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans,
    and all spans as text."""
    found = scan(docs)
    base = F.col("base")
    return found.select(
        "doc_id", *(count_kind(base, k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(joined(base, NAMES, by_kind=False), 256).alias("base_sha256"),
        joined(F.col("spans"), NAMES, by_kind=False).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` are masked and
    ``n_chars`` follows where the text changed."""
    df = docs.select(F.struct("*").alias("_row"), F.col("text").cast("string").alias("_raw"))
    df = with_secrets(df, F.coalesce("_raw", F.lit("")))
    changed = F.size("spans") > 0
    df = df.withColumn("_new", F.when(changed, masked(F.col("_raw"), F.col("spans"), mask)).otherwise(F.col("_raw")))
    new = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("_new")).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return df.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))

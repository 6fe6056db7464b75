"""Personal data by weak supervision (op10), Spark SQL expressions only.

Four fixed kinds are found by pattern and always stay.  Loose patterns give
further candidates.  On every span, strict or loose, labelers vote yes, no or
nothing: a shape labeler, a gazetteer labeler, a cue-word labeler before the
span and one against it.  Equal vote patterns are counted over the whole
corpus; expectation-maximisation on those counts (at most 3^4 patterns a
kind, whatever the corpus) estimates each labeler's reliability and the
posterior of every pattern.  A logistic span classifier is then trained on
the posteriors as soft labels, over votes and length features, again on
counted feature patterns, and adds the loose candidates that it accepts.

One pass over the texts; its spans (no text) are written to the shared folder
and read by both the counting and the final step.

Defined results: null text is empty and has no spans; repeated rows each give
a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import id_and_text, store
from wagelens.llm.spans import NO_SPANS, add_spans, count_kind, joined

#: Possessive repeats and the look-behinds keep matching linear in very long
#: runs; they match exactly what the plain patterns match.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOOSE_PHONE = r"(?<![\w.+-])\(?0[0-9]{1,4}\)?[\x20./-][0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![\w-])"
LOOSE_EMAIL = r"(?i)(?<![\w.-])[a-z0-9._-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]{1,63}\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[a-z]{2,10}(?!\w)"
NATIONAL = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"

BASE = ["email", "ip", "card", "phone"]
ADDED = ["loose_phone", "loose_email", "national_id", "iban"]
NAMES = BASE + ADDED
PATTERNS = [EMAIL, IP, CARD, PHONE, LOOSE_PHONE, LOOSE_EMAIL, NATIONAL, IBAN]

PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IP_VALID = rf"^{PART}(?:\.{PART}){{3}}$"
#: Gazetteers: frequent top-level domains and countries with IBANs.
DOMAIN_ENDS = r"(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$"
IBAN_COUNTRIES = r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"
CUES = (r"(?i)(?:call|phone|tel|mobile|fax|mail|contact|reach|card|visa|iban|account|ssn|social security"
        r"|telefon|anruf|konto|appel|courriel|llama|correo|address|host|ip)\W{0,12}$")
AGAINST = r"(?i)(?:version|release|section|chapter|order|item|isbn|invoice|article|page|figure|rev|no)\W{0,6}$|[$€£#]\x20?$"
CONTEXT = 40
LABELERS = ["shape", "gazetteer", "cue", "against"]
#: A loose candidate is added from this classifier score on.
ACCEPT = 0.5
EM_ROUNDS = 50


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where a digit string passes the Luhn check."""
    backwards = F.reverse(number)

    def step(total, i):
        d = F.substr(backwards, i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step) % 10 == 0


def valid(s: Column) -> Column:
    """Whether a match of a fixed kind's pattern counts."""
    hit, n = s["hit"], F.length(digits(s["hit"]))
    return (F.when(s["kind"] == 0, F.lit(True))
            .when(s["kind"] == 1, F.regexp_like(hit, F.lit(IP_VALID)))
            .when(s["kind"] == 2, F.when(n.between(13, 19), luhn(digits(hit))).otherwise(F.lit(False)))
            .when(s["kind"] == 3, n.between(9, 15)).otherwise(F.lit(True)))


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(s: Column, text: Column) -> Column:
    """A span with its labeler votes and a length feature; no text beyond it."""
    hit, kind = s["hit"], s["kind"]
    n = F.length(digits(hit))
    before = F.substr(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
    shape = (F.when(kind.isin(0, 5), vote(F.length(hit) <= 60, F.length(hit) > 100))
             .when(kind == 1, vote(F.regexp_like(hit, F.lit(r"[0-9]{2,}\..*[0-9]{2,}")), F.regexp_like(hit, F.lit(r"^[0-9](?:\.[0-9])+$"))))
             .when(kind == 2, vote(n.isin(15, 16), n > 16))
             .when(kind.isin(3, 4), vote(n.between(10, 13), ~n.between(8, 15)))
             .when(kind == 6, vote(~F.regexp_like(hit, F.lit("^(?:000|666|9)|-00-|-0000$")), F.lit(True)))
             .otherwise(vote(F.length(hit).between(15, 42), F.lit(True))))
    gazetteer = (F.when(kind.isin(0, 5), vote(F.regexp_like(hit, F.lit(DOMAIN_ENDS)), F.lit(False)))
                 .when(kind == 1, vote(~F.regexp_like(hit, F.lit(r"^(?:0|127|255)\.")), F.lit(True)))
                 .when(kind == 2, vote(F.regexp_like(hit, F.lit("^(?:4|5[1-5]|2[2-7]|3[47]|6)")), F.lit(False)))
                 .when(kind == 3, vote(F.regexp_like(hit, F.lit(r"^\+(?:1|7|2[07]|3[0-69]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")), F.lit(False)))
                 .when(kind == 7, vote(F.regexp_like(hit, F.lit(IBAN_COUNTRIES)), F.lit(True)))
                 .otherwise(F.lit(0)))
    return F.struct(
        s["start"], s["end"], kind.alias("kind"), hit.alias("hit"), shape.alias("shape"), gazetteer.alias("gazetteer"),
        F.when(F.regexp_like(before, F.lit(CUES)), 1).otherwise(0).alias("cue"),
        F.when(F.regexp_like(before, F.lit(AGAINST)), -1).otherwise(0).alias("against"))


def candidates(docs: DataFrame) -> DataFrame:
    """Per document the fixed spans and the loose ones outside them, with votes."""
    text = F.col("_text")
    digit = F.regexp_like(text, F.lit(r"[0-9][\x20-]?[0-9]"))
    at_sign, dotted = F.contains(text, F.lit("@")), F.regexp_like(text, F.lit(r"[0-9]\.[0-9]"))
    guards = [at_sign, dotted, digit, F.contains(text, F.lit("+")), digit,
              F.regexp_like(text, F.lit(r"(?i)[\[(]\x20?at\x20?[\])]")), F.regexp_like(text, F.lit("[0-9]-[0-9]{2}-[0-9]")),
              F.regexp_like(text, F.lit(r"[A-Z]{2}[0-9]{2}"))]
    df = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    df = add_spans(df, "_text", {n: (p, g) for n, p, g in zip(NAMES, PATTERNS, guards)}, "_all")
    df = df.withColumn("_fixed", F.filter("_all", lambda s: (s["kind"] < len(BASE)) & valid(s)))
    df = df.withColumn("_loose", F.filter("_all", lambda s: (s["kind"] >= len(BASE)) & ~F.exists(
        "_fixed", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    return df.select("doc_id", F.transform(F.concat("_fixed", "_loose"), lambda s: votes(s, text)).alias("found"))


def reliabilities(patterns: list[tuple], rounds: int = EM_ROUNDS) -> dict[tuple, float]:
    """Expectation-maximisation over counted vote patterns ``(votes, n)``:
    posterior of "personal" for each pattern.  A labeler has, for each class,
    a distribution over yes / nothing / no; they vote independently."""
    if not patterns:
        return {}
    k = len(patterns[0][0])
    # Start: labelers are right more often than not.
    prob = [{c: {c: 0.6, 0: 0.3, -c: 0.1} for c in (1, -1)} for _ in range(k)]
    prior, post = 0.5, {}
    for _ in range(rounds):
        for v, _n in patterns:
            odds = {c: math.log(prior if c == 1 else 1 - prior) + sum(math.log(prob[j][c][v[j]]) for j in range(k)) for c in (1, -1)}
            top = max(odds.values())
            a, b = math.exp(odds[1] - top), math.exp(odds[-1] - top)
            post[v] = a / (a + b)
        total = sum(n for _, n in patterns)
        prior = min(0.98, max(0.02, sum(n * post[v] for v, n in patterns) / total))
        for j in range(k):
            for c in (1, -1):
                w = {x: 1.0 * (2 if x == c else 1) for x in (1, 0, -1)}  # smoothing that keeps the classes apart
                for v, n in patterns:
                    w[v[j]] += n * (post[v] if c == 1 else 1 - post[v])
                s = sum(w.values())
                prob[j][c] = {x: y / s for x, y in w.items()}
    return post


def features(kind: int, v: tuple) -> list[float]:
    return [1.0, *map(float, v), *(float(kind == k) for k in range(len(NAMES)))]


def train(patterns: list[tuple], posterior: dict, rounds: int = 200, rate: float = 0.5, l2: float = 1e-3) -> list[float]:
    """Logistic weights by gradient descent on the counted patterns
    ``(kind, votes, n)`` with the posteriors as soft labels."""
    w = [0.0] * len(features(0, (0,) * len(LABELERS)))
    total = sum(n for *_, n in patterns) or 1
    for _ in range(rounds):
        g = [l2 * x for x in w]
        for kind, v, n in patterns:
            x = features(kind, v)
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, a in enumerate(x):
                g[i] += n / total * (p - posterior[kind, v]) * a
        w = [a - rate * b for a, b in zip(w, g)]
    return w


def score(s: Column, w: list[float]) -> Column:
    z = F.lit(w[0])
    for j, name in enumerate(LABELERS):
        z = z + F.lit(w[1 + j]) * s[name]
    kinds = F.array(*(F.lit(x) for x in w[1 + len(LABELERS):]))
    return 1 / (1 + F.exp(-(z + F.element_at(kinds, s["kind"] + 1))))


def find(docs: DataFrame) -> DataFrame:
    """Columns ``doc_id``, ``base`` and ``spans`` (arrays of spans)."""
    found = store(candidates(docs), "pii")
    one = found.select(F.explode("found").alias("s")).select("s.kind", *(f"s.{x}" for x in LABELERS))
    # At most 3^4 rows a kind, whatever the corpus.
    rows = [tuple(r) for r in one.groupBy("kind", *LABELERS).count().orderBy("kind", *LABELERS).collect()]
    patterns = [(r[0], r[1:-1], r[-1]) for r in rows]
    posterior = {}
    for kind in {p[0] for p in patterns}:
        own = [(v, n) for k, v, n in patterns if k == kind]
        posterior |= {(kind, v): p for v, p in reliabilities(own).items()}
    w = train(patterns, posterior)
    plain = lambda s: F.struct(s["start"], s["end"], s["kind"].alias("kind"), s["hit"].alias("hit"))
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    kept = F.filter("found", lambda s: (s["kind"] < len(BASE)) | (score(s, w) >= ACCEPT))
    return found.select("doc_id", F.transform(base, plain).cast(NO_SPANS).alias("base"),
                        F.transform(kept, plain).cast(NO_SPANS).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the fixed kinds, the digest of the fixed spans,
    and all spans as text."""
    base = F.col("base")
    return find(docs).select(
        "doc_id", *(count_kind(base, k).alias(f"n_{name}") for k, name in enumerate(BASE)),
        F.sha2(joined(base, NAMES, by_kind=True), 256).alias("base_sha256"),
        joined(F.col("spans"), NAMES, by_kind=True).alias("spans"))

"""Bronze sources: the postings table and the FX reference table.

``postings_from_orders`` derives a deterministic job-postings table (the
17 source columns) from the driver's ``orders`` table, row for row, so its
size grows with the scale factor.  Every rule branch of the cleaning,
deduplication and status logic is exercised by it (see FIXTURES.md §3).

``read_postings_csv`` reads a real postings export (UTF-8, header, quoted
multi-line text) with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens.rules import ALL_SKILLS, COUNTRY_FX

POSTINGS_SCHEMA = T.StructType([
    T.StructField("job_id", T.LongType(), False),
    T.StructField("job_title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("salary_min", T.DoubleType()),
    T.StructField("salary_max", T.DoubleType()),
    T.StructField("description", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("experience_required", T.DoubleType()),
    T.StructField("degree_required", T.StringType()),
    T.StructField("skills", T.StringType()),
    T.StructField("num_skills", T.IntegerType()),
    T.StructField("job_level", T.StringType()),
    T.StructField("is_remote", T.BooleanType()),
    T.StructField("salary_avg", T.DoubleType()),
    T.StructField("has_salary", T.BooleanType()),
])

# Fixed values of the synthetic view (FIXTURES.md §3).
FIXTURE_COUNTRIES = ["USA", "UK", "Canada", "India", "Australia"]
FIXTURE_KEYWORDS = ["data scientist", "data engineer", "data analyst",
                    "business analyst", "machine learning engineer"]
FIXTURE_DEGREES = ["Bachelor", "Master", "PhD", "Not specified"]

# pandas reads these strings as missing values.
PANDAS_NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                     "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                     "n/a", "nan", "null"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_table(spark: SparkSession) -> DataFrame:
    """country -> currency, rate, year, strict floor.  Five rows: a proven
    size bound, so joins against it are broadcast."""
    schema = "country string, currency string, lcu_per_usd double, reference_year int, floor_usd double"
    return spark.createDataFrame(COUNTRY_FX, schema)


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _fdiv(x: Column, d: int) -> Column:
    return F.floor(x / F.lit(float(d))).cast("bigint")


def postings_from_orders(orders: DataFrame) -> DataFrame:
    """Synthetic Bronze postings, one per order (narrow projections only:
    no shuffle).  Built in stages so shared intermediate values (g, the
    salary base, the bounds) are columns computed once rather than
    expression trees repeated inside later expressions."""
    k = F.col("k")
    g = F.col("g")
    s1 = orders.select(F.col("o_orderkey").cast("bigint").alias("k")) \
        .withColumn("g", F.when(k % 40 == 1, k - 1).otherwise(k))
    country = _pick(_fdiv(g, 7) % 5, FIXTURE_COUNTRIES)
    fx = F.lit(None).cast("double")
    for c, _, rate, _, _ in COUNTRY_FX:
        fx = F.when(country == c, F.lit(rate)).otherwise(fx)
    lv = (F.when(g % 20 == 0, "Junior").when(g % 20 < 10, "Mid")
          .when(g % 20 < 18, "Senior").otherwise("Lead"))
    s2 = s1.select(
        "k", "g", country.alias("country"),
        _pick(_fdiv(g, 3) % 5, FIXTURE_KEYWORDS).alias("kw"),
        ((g * 31) % 256).alias("h"),
        (F.when(k % 73 == 0, F.lit(10)).otherwise(F.lit(1)) * (F.lit(30000) + (g * 7919) % 120000))
        .cast("double").alias("b"),
        (((_fdiv(g, 7) % 5) >= 2) & (g % 4 != 0) | (k % 80 == 41)).alias("nosal"),
        lv.alias("lv"))
    s2 = s2.withColumn("fx", fx)
    nosal, b, fxc, h, kw, lvc = (F.col(c) for c in ("nosal", "b", "fx", "h", "kw", "lv"))
    bump = F.when(k % 120 == 1, F.lit(5000.0)).otherwise(F.lit(0.0))
    smin = (F.when(nosal, F.lit(None).cast("double"))
            .when(k % 97 == 0, F.lit(0.0)).when(k % 89 == 0, F.lit(10000.0))
            .when(k % 83 == 0, F.lit(40.0)).when(k % 71 == 0, F.lit(0.0))
            .otherwise(F.round(b * 0.9 * fxc, 2) + bump))
    smax = (F.when(nosal, F.lit(None).cast("double"))
            .when(k % 89 == 0, F.lit(None).cast("double"))
            .when(k % 83 == 0, F.lit(60.0))
            .when((k % 97 != 0) & (k % 71 == 0), F.lit(0.0))
            .otherwise(F.round(b * 1.1 * fxc, 2) + bump))
    s3 = s2.select("*", smin.alias("salary_min"), smax.alias("salary_max"))
    smin, smax = F.col("salary_min"), F.col("salary_max")
    mid = (smin + smax) / 2
    skew_mid = (k % 79 == 0) & (k % 97 != 0) & (k % 83 != 0) & (k % 71 != 0)
    savg = (F.when(nosal, F.lit(None).cast("double"))
            .when(smax.isNull(), F.lit(10000.0))
            .when(skew_mid, mid * 1.01).otherwise(mid))
    bits = [F.when(F.shiftright(h, i) % 2 == 1, F.lit(f"'{s}'")) for i, s in enumerate(ALL_SKILLS)]
    skills = (F.when(g % 500 == 8, F.lit("not a list"))
              .when(g % 10 >= 7, F.concat(F.lit("["), F.concat_ws(", ", *bits), F.lit("]")))
              .otherwise(F.lit("[]")))
    title = F.when(g % 11 == 0, F.concat(F.lit(" "), F.upper(kw), F.lit("   "), lvc, F.lit(" "))) \
             .otherwise(F.concat(kw, F.lit(" "), F.lower(lvc)))
    return s3.select(
        k.alias("job_id"),
        title.alias("job_title"),
        F.when(g % 1000 == 999, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Company "), (g % 97).cast("string"))).alias("company"),
        F.concat(F.lit("City "), (g % 53).cast("string")).alias("location"),
        smin.alias("salary_min"),
        smax.alias("salary_max"),
        F.concat(F.lit("Posting "), g.cast("string")).alias("description"),
        F.col("country"),
        kw.alias("search_keyword"),
        F.when(g % 10 == 0, (_fdiv(g, 10) % 45).cast("double")).alias("experience_required"),
        _pick(g % 4, FIXTURE_DEGREES).alias("degree_required"),
        skills.alias("skills"),
        F.when(g % 10 >= 7, F.bit_count(h)).otherwise(F.lit(0)).cast("int").alias("num_skills"),
        F.when(k % 200 == 1, F.lit("Lead")).otherwise(lvc).alias("job_level"),
        ((g % 3 == 0) != (k % 280 == 1)).alias("is_remote"),
        savg.alias("salary_avg"),
        ((~nosal) & smax.isNotNull()).alias("has_salary"),
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Bronze postings table for a scale-factor folder.  Only the order
    key is read; an under-split scan is spread over the cluster before the
    per-row string generation (see ``session.spread``)."""
    from wagelens.session import spread
    return postings_from_orders(spread(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey"))


def read_postings_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: read a postings CSV export with the declared schema.  pandas'
    default NA strings become null; numeric text that does not parse stays
    null (the reader is in PERMISSIVE mode)."""
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in POSTINGS_SCHEMA])
    raw = (spark.read.schema(raw_schema)
           .option("header", True).option("multiLine", True)
           .option("escape", '"').option("encoding", "UTF-8")
           .csv(path))
    from wagelens.functions.columns import parse_bool
    out = []
    for f in POSTINGS_SCHEMA:
        c = F.col(f.name)
        c = F.when(~F.coalesce(c.isin(*PANDAS_NA_STRINGS), F.lit(False)), c)
        if isinstance(f.dataType, T.BooleanType):
            c = parse_bool(c)
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    return raw.select(*out)

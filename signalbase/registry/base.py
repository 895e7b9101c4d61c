"""Registration, access to the given tables, and SQL pieces shared by the twins."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed
from ..functions.text import SPACE_CHARS
from ..operators.resolve import catalogue_entries
from ..session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RUN_TS = datetime(2024, 6, 5, tzinfo=timezone.utc)
CUTOFF = datetime(2024, 6, 3, 12, tzinfo=timezone.utc)
CUTOFF_SQL = "TIMESTAMP '2024-06-03 12:00:00'"


class Tables:
    """The given tables as attributes. Times without a zone are UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        zoneless = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
        return df.withColumns(zoneless) if zoneless else df


def query(sql: str | None = None):
    """Register a function of Tables under its own name."""
    def register(fn):
        def call(spark: SparkSession, folder: str) -> DataFrame:
            use_utc(spark)
            return fn(Tables(spark, folder))

        QUERIES[fn.__name__] = call
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def list_sql(values) -> str:
    return "(" + ", ".join(text_sql(v) for v in values) + ")"


def strip_sql(e: str) -> str:
    return f"trim({e}, {text_sql(SPACE_CHARS)})"


def squash_sql(e: str) -> str:
    return strip_sql(f"regexp_replace({e}, '[{SPACE_CHARS}]+', ' ', 'g')")


def norm_sql(e: str) -> str:
    return (f"lower(array_to_string(list_filter(string_split(regexp_replace({e}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), "
            f"' '), lambda w: w <> '' AND lower(w) NOT IN {list_sql(fixed.SUFFIX_WORDS)}), ' '))")


def capital_sql(e: str) -> str:
    return f"(upper({e}[1]) || lower({e}[2:]))"


def title_sql(e: str) -> str:
    words = f"array_to_string(list_transform(string_split({norm_sql(e)}, ' '), lambda w: {capital_sql('w')}), ' ')"
    runs = (f"array_to_string(list_transform(regexp_extract_all({strip_sql(e)}, '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda w: {capital_sql('w')}), '')")
    return f"coalesce(nullif({words}, ''), {runs})"


def hash_sql(*parts: str) -> str:
    joined = " || '_' || ".join(f"coalesce({p}, '')" for p in parts)
    return f"sha256(lower({strip_sql(f'({joined})')}))"


def iso_sql(e: str) -> str:
    return (f"(strftime({e}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN extract(microsecond FROM {e}) % 1000000 = 0 THEN '' "
            f"ELSE strftime({e}, '.%f') END || '+00:00')")


def any_keyword_sql(exprs, keywords) -> str:
    return "(" + " OR ".join(
        f"contains(lower(coalesce({e}, '')), {text_sql(k)})" for e in exprs for k in keywords) + ")"


CATALOGUE = catalogue_entries()
CAT_SQL = "cat(alias, canonical, priority) AS (VALUES " + ", ".join(
    f"({text_sql(a)}, {text_sql(c)}, {i})" for i, (a, c) in enumerate(CATALOGUE)) + ")"


def resolve_sql(source: str, name: str = "raw_name") -> str:
    """Tables of a WITH list that end in ``res(raw_name, canonical, method, confidence)`` for ``source``."""
    return f"""{CAT_SQL},
    d AS (SELECT DISTINCT {name} AS raw_name, lower({strip_sql(f"coalesce({name}, '')")}) AS lo FROM {source}),
    e AS (SELECT *, {norm_sql("lo")} AS nm FROM d),
    inside AS (SELECT lo, arg_min(canonical, priority) AS ct FROM (SELECT DISTINCT lo FROM e) x JOIN cat
               ON length(alias) > 3 AND contains(' ' || lo || ' ', ' ' || alias || ' ') GROUP BY lo),
    h AS (SELECT e.*, c1.canonical AS ex, c2.canonical AS nz, inside.ct FROM e
          LEFT JOIN cat c1 ON c1.alias = lo LEFT JOIN cat c2 ON c2.alias = nm LEFT JOIN inside ON inside.lo = e.lo),
    res AS (SELECT raw_name,
              CASE WHEN lo = '' THEN 'Unknown' ELSE coalesce(ex, nz, ct, {title_sql("raw_name")}) END AS canonical,
              CASE WHEN lo = '' THEN 'NONE' WHEN ex IS NOT NULL THEN 'SEED_EXACT'
                   WHEN nz IS NOT NULL THEN 'SEED_NORMALIZED' WHEN ct IS NOT NULL THEN 'SEED_SUBSTRING'
                   ELSE 'RULE_NORMALIZATION' END AS method,
              CAST(CASE WHEN lo = '' THEN 0.0 WHEN ex IS NOT NULL THEN 1.0 WHEN nz IS NOT NULL THEN 0.95
                   WHEN ct IS NOT NULL THEN 0.90 ELSE 0.80 END AS DOUBLE) AS confidence FROM h)"""


# Company names from customers: every alias in eight spellings.
_FORMS = len(CATALOGUE)
NAMES_SQL = f"""names AS (SELECT c_custkey, CASE c_custkey % 8
    WHEN 0 THEN alias WHEN 1 THEN upper(alias) WHEN 2 THEN alias || ', Inc.' WHEN 3 THEN 'The ' || alias || ' team'
    WHEN 4 THEN alias || ' GmbH' WHEN 5 THEN c_name WHEN 6 THEN '   ' ELSE c_name || ' Labs Inc.' END AS raw_name
    FROM customer JOIN (VALUES {", ".join(f"({i}, {text_sql(a)})" for i, (a, _) in enumerate(CATALOGUE))})
    spell(n, alias) ON n = (c_custkey // 8) % {_FORMS})"""


def company_names(t: Tables) -> DataFrame:
    aliases = F.split(F.lit("|".join(a for a, _ in CATALOGUE)), r"\|")
    key = F.col("c_custkey")
    alias = F.element_at(aliases, (F.floor(key / 8) % _FORMS + 1).cast("int"))
    form = key % 8
    raw = (F.when(form == 0, alias).when(form == 1, F.upper(alias)).when(form == 2, F.concat(alias, F.lit(", Inc.")))
           .when(form == 3, F.concat(F.lit("The "), alias, F.lit(" team")))
           .when(form == 4, F.concat(alias, F.lit(" GmbH"))).when(form == 5, F.col("c_name"))
           .when(form == 6, F.lit("   ")).otherwise(F.concat("c_name", F.lit(" Labs Inc."))))
    return t.customer.select("c_custkey", raw.alias("raw_name"))

"""Company names and their resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import resolve
from .base import (
    CAT_SQL, NAMES_SQL, RUN_TS, Tables, company_names, iso_sql, norm_sql, query, resolve_sql, strip_sql, title_sql,
)

_LOWER = f"lower({strip_sql('raw_name')})"


@query(f"WITH {NAMES_SQL} SELECT c_custkey, {norm_sql('raw_name')} AS name FROM names")
def normalize_name(t: Tables):
    return company_names(t).select("c_custkey", text.normalize_name("raw_name").alias("name"))


@query(f"WITH {NAMES_SQL} SELECT c_custkey, {title_sql('raw_name')} AS name FROM names")
def title_name(t: Tables):
    return company_names(t).select("c_custkey", text.title_name("raw_name").alias("name"))


@query(f"""WITH {CAT_SQL}, {NAMES_SQL} SELECT c_custkey, canonical AS exact FROM names
    LEFT JOIN cat ON alias = {_LOWER}""")
def seed_exact(t: Tables):
    return resolve.seed_exact(company_names(t), "raw_name", resolve.Catalogue.built_in(t.spark)).select(
        "c_custkey", "exact")


@query(f"""WITH {CAT_SQL}, {NAMES_SQL} SELECT c_custkey, canonical AS normalized FROM names
    LEFT JOIN cat ON alias = {norm_sql(_LOWER)}""")
def seed_normalized(t: Tables):
    return resolve.seed_normalized(company_names(t), "raw_name", resolve.Catalogue.built_in(t.spark)).select(
        "c_custkey", "normalized")


@query(f"""WITH {CAT_SQL}, {NAMES_SQL} SELECT c_custkey, arg_min(canonical, priority) AS contained FROM names
    LEFT JOIN cat ON length(alias) > 3 AND contains(' ' || {_LOWER} || ' ', ' ' || alias || ' ') GROUP BY c_custkey""")
def seed_substring(t: Tables):
    return resolve.seed_substring(company_names(t), "raw_name", resolve.Catalogue.built_in(t.spark)).select(
        "c_custkey", "contained")


_RESOLVED = f"""WITH {NAMES_SQL}, {resolve_sql('names')}
    SELECT c_custkey, canonical, method, confidence FROM names JOIN res USING (raw_name)"""


@query(_RESOLVED)
def resolve_entities(t: Tables):
    return resolve.resolve_entities(company_names(t), "raw_name", resolve.Catalogue.built_in(t.spark)).select(
        "c_custkey", "canonical", "method", "confidence")


@query(_RESOLVED)
def resolve_entities_large_catalogue(t: Tables):
    """The same result with an alias of several words for each part besides, which no name holds."""
    more = t.part.select(F.concat_ws(" ", F.lit("part"), F.lower("p_name"), F.lit("number"), "p_partkey").alias("alias"),
                         F.col("p_brand").alias("canonical"), (F.col("p_partkey") + 1_000_000).cast("int").alias("priority"))
    catalogue = resolve.Catalogue.from_frame(resolve.Catalogue.built_in(t.spark).frame.unionByName(more))
    return resolve.resolve_entities(company_names(t), "raw_name", catalogue).select(
        "c_custkey", "canonical", "method", "confidence")


@query(f"""WITH {NAMES_SQL}, {resolve_sql('names')} SELECT raw_name, canonical AS canonical_name, method, confidence,
    {iso_sql("TIMESTAMP '2024-06-05 00:00:00'")} AS resolved_at FROM names JOIN res USING (raw_name)""")
def resolution_log(t: Tables):
    resolved = resolve.resolve_entities(company_names(t), "raw_name", resolve.Catalogue.built_in(t.spark))
    log = resolve.resolution_log(resolved, "raw_name", F.lit(RUN_TS))
    return log.withColumn("resolved_at", F.date_format("resolved_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def flagship(t: Tables):
    """Names to companies, one row per hash key, counted by company and method."""
    from ..functions.keys import hash_key
    from ..operators.dedup import first_wins

    resolved = resolve.resolve_entities(company_names(t), "raw_name", resolve.Catalogue.built_in(t.spark))
    keyed = resolved.withColumn("hash_key", hash_key("canonical", "raw_name"))
    return first_wins(keyed, "hash_key", "c_custkey").groupBy("canonical", "method").agg(F.count("*").alias("rows"))


@query(f"""WITH {NAMES_SQL}, {resolve_sql('names')},
    keyed AS (SELECT canonical, method, row_number() OVER (PARTITION BY sha256(lower({strip_sql(
        "canonical || '_' || raw_name")})) ORDER BY c_custkey) AS rn FROM names JOIN res USING (raw_name))
    SELECT canonical, method, count(*) AS rows FROM keyed WHERE rn = 1 GROUP BY canonical, method""")
def companies_by_method(t: Tables):
    return flagship(t)

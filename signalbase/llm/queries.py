"""The queries of this subpackage over the given tables, and DuckDB SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (clusters, language, mixing, neighbours, packing, quality, quotes, repair, secrets, simhash, suffixes, tokens,
               weighted)
from .common import documents, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k"


def vocabulary() -> tuple[str, str]:
    """Paths of the vocabulary and of the same one as ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{VOCABULARY}.json"), public_tokenizers.path(f"{VOCABULARY}.tiktoken")


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its own name."""
    def register(fn):
        def call(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = call
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


@query()
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


@query(r"""WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
 totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
 weighed AS (SELECT *, rank, CAST(1 + (rank - 1) % 3 AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS cap
   FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM totals)),
 levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, rank
     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
 targets AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, (cap / weight, rank)) FROM levels
     WHERE level <= cap / weight) * weight, cap)) AS target FROM levels),
 ordered AS (SELECT s.doc_id, s.source, s.size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
     coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('0:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
   FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
 cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM ordered)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken FROM cut""")
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query("""WITH good AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
   WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v),
     lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
   FROM good q JOIN good c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
 ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query()
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(documents(spark, folder))


@query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, folder), *vocabulary())


@query()
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffixes.remove_repeats(documents(spark, folder))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by text, declared language and source; pages by text, markup language, address suffix and host."""
    docs, pages = documents(spark, folder), spark.read.parquet(f"{folder}/pages.parquet")
    none = F.lit(None).cast("long")
    texts = language.identify(docs.select(*language.evidence(
        [F.col("doc_id"), none.alias("page_id")], F.col("text"), F.col("lang"), host=F.col("source"))))
    tag = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    marked = language.identify(pages.select(*language.evidence(
        [none.alias("doc_id"), F.col("page_id")], F.col("html"), tag, F.col("url"))), markup=True)
    return texts.union(marked).withColumn("rejected", language.is_rejected())


@query(r"""WITH told AS (SELECT *, row_number() OVER w - 1 AS i, lag(turn) OVER w AS up, first_value(turn) OVER w AS root
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body, CAST(least(i, 2) AS BIGINT) AS depth,
  CAST(least(i, 2) AS BIGINT) AS n_passages, CAST(least(i, 2) AS BIGINT) AS n_linked,
  CASE WHEN i > 0 THEN conv_id END AS parent_conv, up AS parent_turn, root AS root_turn, CAST(i AS BIGINT) AS reply_depth,
  CAST(i + 1 AS BIGINT) AS place FROM told""")
def op8_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations with mail quotes of whole messages and of single lines added, and taken apart again."""
    return quotes.thread(quotes.with_quotes(spark.read.parquet(f"{folder}/conversations.parquet")))


@query()
def op9_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return weighted.edited_pairs(documents(spark, folder))


@query()
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), *vocabulary())


@query()
def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.damage_and_repair(spark.read.parquet(f"{folder}/conversations.parquet"))


def _rounds(k: int, rounds: int) -> str:
    """SQL for ``rounds`` of assignment and update from the ``k`` vectors whose ids hash smallest, then one assignment."""
    steps = [f"""good AS (SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v
   FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS cluster, v AS c
   FROM good QUALIFY cluster < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (SELECT r, vec_id, v, unnest(arg_min(struct_pack(cluster := cluster, distance := d), (d, cluster)))
   FROM (SELECT r, vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
     FROM good, c{i}) GROUP BY r, vec_id, v)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c
   FROM (SELECT cluster, j, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS j FROM a{i}) GROUP BY cluster, j)
   GROUP BY cluster), c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",\n ".join(steps) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


@query(_rounds(40, 5))
def op12_bit_plane_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = clusters.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def _rule(rule: quality.Rule) -> str:
    sign, order = ("-", ">=") if rule.bound == "at least" else ("+", "<=")
    return f"100 * {rule.measure} {order} {rule.per_cent} * {rule.of or 1} {sign} {rule.slack}"


_QUALITY = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM documents),
 g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
 twice AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1)),
 repeated AS (SELECT r, sum(least(5, coalesce(next - i, 5))) AS n FROM twice GROUP BY r),
 m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
   CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(list_filter(w, lambda x: lower(x) IN (STOPS))) AS BIGINT) AS n_stop_words,
   CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
   CAST(len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
   CAST(len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*\z'))) AS BIGINT) AS n_cut_lines,
   CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN repeated USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, NOT (BASE) AS base_failed, (BASE AND RULES) AS kept FROM m"""


@query(_QUALITY.replace("STOPS", ", ".join(f"'{w}'" for w in quality.STOP_WORDS))
       .replace("BASE", " AND ".join(map(_rule, quality.BASE))).replace("RULES", " AND ".join(map(_rule, quality.RULES))))
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                          "base_failed", "kept")

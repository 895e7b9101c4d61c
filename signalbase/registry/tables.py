"""Deduplication, limits, lookups, records, validation, counts and export over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import content_hash as content_hash_of, hash_key
from ..operators import audit, dedup, extraction, limits, lookups, prefilter, records, validate
from ..session import fresh_path, stage
from ..sinks.export import tab, write_tab
from ..sinks.tables import load_tables, read_table
from ..sources.landed import union_sources as union_of
from .base import RUN_TS, Tables, hash_sql, iso_sql, norm_sql, query, text_sql
from .columns import ABSTRACTS_SQL, PARAGRAPHS_SQL, REPO_KEY_SQL, REPO_SQL, REPO_URL_SQL, abstracts

# Documents by text: exact copies share a key. Stored: the French ones.
_KEYED = f"keyed AS (SELECT doc_id, lang, {hash_sql('text')} AS hash_key FROM documents)"
_WINNERS = """winners AS (SELECT doc_id, lang, hash_key FROM (SELECT *, row_number() OVER (PARTITION BY hash_key
    ORDER BY doc_id) AS rn FROM keyed) x WHERE rn = 1)"""
_STORED = "stored AS (SELECT DISTINCT hash_key FROM keyed WHERE lang = 'fr')"


def _keyed(t: Tables):
    return t.documents.select("doc_id", "lang", hash_key("text").alias("hash_key"))


@query(f"WITH {_KEYED}, {_WINNERS} SELECT doc_id, hash_key FROM winners")
def first_wins(t: Tables):
    return dedup.first_wins(_keyed(t), "hash_key", "doc_id").select("doc_id", "hash_key")


@query(f"WITH {_KEYED}, {_STORED} SELECT doc_id, hash_key FROM keyed WHERE hash_key NOT IN (SELECT * FROM stored)")
def anti_existing(t: Tables):
    keyed = _keyed(t)
    return dedup.anti_existing(keyed, keyed.filter(F.col("lang") == "fr")).select("doc_id", "hash_key")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 500 AS id FROM orders")
def assign_ids(t: Tables):
    return dedup.assign_ids(t.orders.select("o_orderkey"), "o_orderkey", 500)


@query(f"""WITH {_KEYED}, {_WINNERS}, {_STORED} SELECT doc_id, hash_key, row_number() OVER (ORDER BY doc_id) AS id
    FROM winners WHERE hash_key NOT IN (SELECT * FROM stored)""")
def insert_or_ignore(t: Tables):
    keyed = _keyed(t)
    return dedup.insert_or_ignore(keyed, keyed.filter(F.col("lang") == "fr"), "doc_id").select(
        "doc_id", "hash_key", "id")


@query(f"""WITH {_KEYED}, {_WINNERS}, {_STORED} SELECT doc_id, hash_key FROM winners
    WHERE hash_key NOT IN (SELECT * FROM stored)""")
def prefiltered_keys(t: Tables):
    """New keys by the filter of the stored ones: those it has never seen, and those of the others that are not stored."""
    firsts, stored = _keyed(t).groupBy("hash_key").agg(F.min("doc_id").alias("doc_id")), _keyed(t).filter("lang = 'fr'")
    segments = prefilter.segments_for(stored.count())
    probed = prefilter.with_maybe(firsts, "hash_key", prefilter.build(stored, "hash_key", segments), segments)
    probed = stage(probed, "probed")
    doubtful = dedup.anti_existing(probed.where("maybe_stored"), stored)
    return probed.where("NOT maybe_stored").unionByName(doubtful).select("doc_id", "hash_key")


@query(f"""WITH keyed AS (SELECT c_custkey, c_nationkey < 10 AS early, 'Firm ' || c_custkey % 997 AS entity_name,
    {hash_sql("'Firm ' || c_custkey % 997", "'https://example.org/' || c_custkey % 7")} AS hash_key FROM customer),
    one AS (SELECT hash_key, min(c_custkey) AS c_custkey FROM keyed WHERE early GROUP BY 1),
    two AS (SELECT hash_key, min(c_custkey) AS c_custkey FROM keyed WHERE hash_key NOT IN (SELECT hash_key FROM one) GROUP BY 1)
    SELECT hash_key, entity_name, row_number() OVER (ORDER BY load, c_custkey) AS id FROM (SELECT 1 AS load, * FROM one
    UNION ALL SELECT 2, * FROM two) x JOIN keyed USING (hash_key, c_custkey)""")
def two_loads(t: Tables):
    """The startups table after a load of some companies, then of all: first rows kept, ids going on."""
    rows = _companies(t).withColumns({"entity_name": F.concat(F.lit("Firm "), F.col("c_custkey") % 997),
                                      "source_url": F.concat(F.lit("https://example.org/"), F.col("c_custkey") % 7)})
    root = fresh_path(t.spark, "tables")
    early = rows.join(t.customer.select("c_custkey", "c_nationkey").filter("c_nationkey < 10"), "c_custkey")
    for batch in (early, rows):
        nested = records.to_record(batch.withColumn("ingest_seq", F.col("c_custkey")), "startups", ("ingest_seq",))
        load_tables(t.spark, root, {"startups": records.flatten(nested, "startups", ("ingest_seq",))})
    return read_table(t.spark, root, "startups").select("hash_key", "entity_name", "id")


@query(f"SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT {fixed.TARGET_ROWS}")
def cap_rows(t: Tables):
    return limits.cap_rows(t.customer, "c_custkey", fixed.TARGET_ROWS).select("c_custkey", "c_name")


@query(f"""SELECT name, seq, source_no FROM (SELECT s_name AS name, s_suppkey AS seq, 0 AS source_no FROM supplier
    UNION ALL SELECT c_name, c_custkey, 1 FROM customer) x ORDER BY source_no, seq LIMIT {fixed.TARGET_ROWS}""")
def backfill(t: Tables):
    first = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("seq"))
    second = t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("seq"))
    return limits.backfill(first, second, "seq", fixed.TARGET_ROWS)


@query(f"""SELECT event_id, {iso_sql('ts')} AS ts FROM (SELECT * FROM events ORDER BY ts DESC, event_id
    LIMIT {fixed.TARGET_ROWS}) x""")
def newest_n(t: Tables):
    from ..functions.dates import py_isoformat
    return limits.newest_n(t.events, "ts", "event_id", fixed.TARGET_ROWS).select("event_id", py_isoformat("ts").alias("ts"))


@query("""SELECT 'customer' AS source, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""")
def union_sources(t: Tables):
    """Three sources, of which one is missing."""
    return union_of({
        "customer": lambda: t.customer.select(
            F.lit("customer").alias("source"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment")),
        "absent": lambda: t.spark.read.parquet(f"{t.folder}/no-such-source"),
        "supplier": lambda: t.supplier.select(
            F.lit("supplier").alias("source"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
    })


@query("""SELECT 'customer' AS "table", count(*) AS rows FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
    UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents""")
def table_counts(t: Tables):
    return audit.table_counts({
        name: getattr(t, name) for name in ("customer", "supplier", "part", "orders", "events", "documents")})


@query(f"""WITH {ABSTRACTS_SQL},
    stats AS (SELECT 'org' || s_suppkey || '/repo' || s_suppkey % 10 AS repo,
              CAST(abs(round(s_acctbal)) AS INTEGER) AS stars FROM supplier),
    keyed AS (SELECT doc_id, {REPO_URL_SQL} AS github_url,
              nullif(regexp_extract(summary, {REPO_SQL}, 1), '') || '/' || {REPO_KEY_SQL} AS repo FROM abstracts)
    SELECT doc_id, github_url, coalesce(stars, 0) AS github_stars FROM keyed LEFT JOIN stats USING (repo)""")
def paper_stars(t: Tables):
    stats = t.supplier.select(
        F.concat(F.lit("org"), "s_suppkey").alias("owner"),
        F.concat(F.lit("repo"), F.col("s_suppkey") % 10).alias("repo"),
        F.abs(F.round("s_acctbal")).cast("int").alias("stars"))
    return lookups.paper_stars(abstracts(t), stats).select("doc_id", "github_url", "github_stars")


_POPULAR = "https://popular.example/"


@query(f"""WITH {PARAGRAPHS_SQL}, entries AS (SELECT event_id, 'about ' || event_type AS summary,
    CASE WHEN event_id % 3 = 0 THEN '{_POPULAR}' ELSE 'https://nowhere.example/' || event_id END AS link
    FROM events UNION ALL SELECT page_id + 100000000, NULL, url FROM pages),
    one AS (SELECT CASE WHEN page_id = 0 THEN '{_POPULAR}' ELSE url END AS url, arg_min(body, page_id) AS body
            FROM bodies GROUP BY 1)
    SELECT event_id, sha256(coalesce(nullif(body, ''), nullif(summary, ''), '')) AS digest
    FROM entries LEFT JOIN one ON url = link""")
def news_body(t: Tables):
    """Entries of which a third link to one page, some to no page, and one to each page."""
    entries = t.events.select(
        "event_id", F.concat(F.lit("about "), "event_type").alias("summary"),
        F.when(F.col("event_id") % 3 == 0, F.lit(_POPULAR)).otherwise(
            F.concat(F.lit("https://nowhere.example/"), "event_id")).alias("link"))
    entries = entries.unionByName(t.pages.select(
        (F.col("page_id") + 100000000).alias("event_id"), F.lit(None).cast("string").alias("summary"),
        F.col("url").alias("link")))
    pages = t.pages.withColumn("url", F.when(F.col("page_id") == 0, F.lit(_POPULAR)).otherwise(F.col("url")))
    found = lookups.news_body(entries, lookups.page_bodies(pages, "page_id"))
    return found.select("event_id", F.sha2("full_text", 256).alias("digest"))


# Flat company rows that the record queries share.
_COMPANIES = """companies AS (SELECT c_custkey, c_name AS entity_name, CASE WHEN c_nationkey > 3 THEN c_nationkey END
    AS employee_count, 'Y Combinator' AS source_name, 'https://example.org/' || c_custkey % 700 AS source_url,
    '2024-06-05T00:00:00+00:00' AS collected_at FROM customer)"""


def _companies(t: Tables):
    from ..functions.dates import collected_at
    return t.customer.select(
        "c_custkey", F.col("c_name").alias("entity_name"),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("employee_count"),
        F.lit(fixed.DIRECTORY_NAME).alias("source_name"),
        F.concat(F.lit("https://example.org/"), F.col("c_custkey") % 700).alias("source_url"),
        collected_at(RUN_TS).alias("collected_at"))


@query(f"""WITH {_COMPANIES} SELECT c_custkey, {hash_sql('entity_name', 'source_url')} AS hash_key, entity_name,
    employee_count, source_name, source_url, collected_at FROM companies""")
def record_flatten(t: Tables):
    nested = records.to_record(_companies(t), "startups", ("c_custkey",))
    return records.flatten(nested, "startups", ("c_custkey",)).drop("raw_payload")


@query(f"""WITH {_COMPANIES} SELECT c_custkey, CAST(to_json({{'schemaVersion': '1.0', 'recordType': 'STARTUP',
    'source': {{'name': source_name, 'url': source_url}}, 'content': {{'entityName': entity_name,
    'data': {{'employeeCount': employee_count}}}}, 'collectedAt': collected_at}}) AS VARCHAR) AS payload
    FROM companies""")
def raw_payload(t: Tables):
    nested = records.to_record(_companies(t), "startups", ("c_custkey",))
    return records.flatten(nested, "startups", ("c_custkey",)).select("c_custkey", F.col("raw_payload").alias("payload"))


@query(f"""WITH {_COMPANIES} SELECT c_custkey, 'startup' AS record, source_name, employee_count, NULL AS pricing_model
    FROM companies UNION ALL SELECT c_custkey, 'product', 'Y Combinator Directory', NULL, 'FREEMIUM' FROM companies""")
def startup_product_pair(t: Tables):
    from ..plans.entities import product_rows, startup_rows
    resolved = _companies(t).select(
        F.col("entity_name").alias("canonical"), "employee_count", "source_url", F.lit(0).alias("source_no"),
        F.col("c_custkey").alias("ingest_seq"))
    startups = startup_rows(resolved, RUN_TS).withColumn("record", F.lit("startup"))
    products = product_rows(resolved, RUN_TS).withColumn("record", F.lit("product"))
    return startups.unionByName(products, allowMissingColumns=True).select(
        F.col("ingest_seq").alias("c_custkey"), "record", "source_name", "employee_count", "pricing_model")


@query("""SELECT o_orderkey, array_to_string(list_filter([
    CASE WHEN o_orderkey % 7 = 0 THEN 'missing content.startupName' END,
    CASE WHEN o_orderkey % 6 = 5 THEN 'missing content.pricingModel' END,
    CASE WHEN o_orderkey % 11 = 0 THEN 'missing source.url' END,
    CASE WHEN o_orderkey % 6 = 4 THEN 'unknown content.pricingModel' END], lambda r: r IS NOT NULL), '; ') AS reasons
    FROM orders""")
def validate_records(t: Tables):
    key = F.col("o_orderkey")
    models = F.array(*[F.lit(m) for m in [*fixed.PRICING_MODELS, "TRIAL"]], F.lit(None).cast("string"))
    flat = t.orders.select(
        "o_orderkey", F.when(key % 7 != 0, F.col("o_orderpriority")).alias("startup_name"),
        F.get(models, (key % 6).cast("int")).alias("pricing_model"), F.lit(fixed.SPACES_NAME).alias("source_name"),
        F.when(key % 11 != 0, F.concat(F.lit("https://example.org/"), key)).alias("source_url"),
        F.lit("2024-06-05T00:00:00+00:00").alias("collected_at"))
    good, bad = validate.validate(records.to_record(flat, "products", ("o_orderkey",)), "products")
    return good.select("o_orderkey", F.lit("").alias("reasons")).unionByName(
        bad.select("o_orderkey", F.array_join("reasons", "; ").alias("reasons")))


@query("""WITH responses AS (SELECT o_orderkey AS doc_id, tier, CASE (o_orderkey + tier) % 4 WHEN 0 THEN 200 WHEN 1 THEN
    200 WHEN 2 THEN 429 ELSE 500 END AS status, CASE WHEN (o_orderkey * tier) % 3 = 0 THEN '{"name": "x'
    ELSE '{"name": "' || o_orderpriority || '", "n": ' || tier || '}' END AS body
    FROM orders, (VALUES (1), (2), (3)) v(tier)),
    best AS (SELECT doc_id, min(tier) AS tier, arg_min(body, tier) AS body FROM responses
             WHERE status = 200 AND json_valid(body) GROUP BY doc_id)
    SELECT o_orderkey AS doc_id, tier, json_extract_string(body, '$.name') AS name,
    CAST(json_extract_string(body, '$.n') AS INTEGER) AS n FROM orders LEFT JOIN best ON doc_id = o_orderkey""")
def first_valid_tier(t: Tables):
    key = F.col("o_orderkey")
    responses = t.orders.select(
        key.alias("doc_id"), "o_orderpriority", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("tier"))
    status = F.get(F.array(*[F.lit(s) for s in (200, 200, 429, 500)]), ((F.col("doc_id") + F.col("tier")) % 4).cast("int"))
    body = F.when(F.col("doc_id") * F.col("tier") % 3 == 0, F.lit('{"name": "x')).otherwise(F.concat(
        F.lit('{"name": "'), "o_orderpriority", F.lit('", "n": '), "tier", F.lit("}")))
    responses = responses.select("doc_id", "tier", status.alias("status"), body.alias("body"))
    parsed, failed = extraction.first_valid_tier(
        t.orders.select(key.alias("doc_id")), responses, "name string, n int")
    return parsed.select("doc_id", "tier", "result.name", "result.n").unionByName(
        failed, allowMissingColumns=True)


@query(f"""SELECT page_id, sha256(entity || {norm_sql('title')} || coalesce(lower(nullif(regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')), '')) AS digest FROM (SELECT page_id, url,
    'Entity ' || page_id % 50 AS entity, coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title
    FROM pages) x""")
def content_hash(t: Tables):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    entity = F.concat(F.lit("Entity "), F.col("page_id") % 50)
    return t.pages.select("page_id", content_hash_of(entity, title, "url").alias("digest"))


@query(f"""WITH hosts AS (SELECT lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)',
    1), '')) AS host FROM pages) SELECT md5(host)[1] AS bucket, count(DISTINCT host) AS hosts, CAST(count(*) AS BIGINT)
    AS urls FROM hosts WHERE host IS NOT NULL GROUP BY 1""")
def domain_buckets(t: Tables):
    from ..operators.domains import domain_buckets as buckets
    return buckets(t.pages, "url")


@query("""SELECT host, slice, CAST(1 AS BIGINT) AS places, CAST(count(*) AS BIGINT) AS urls FROM (
    SELECT lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host,
    page_id // 100 AS slice FROM pages) x GROUP BY ALL""")
def partition_by_domain(t: Tables):
    """In how many partitions the pages of a host and slice lie: in one each."""
    from ..functions.links import host
    from ..operators.domains import partition_by_domain as dealt
    spread = dealt(t.pages, "url", 64, "page_id", slice_rows=100).withColumn("place", F.spark_partition_id())
    return spread.groupBy(host("url").alias("host"), F.floor(F.col("page_id") / 100).alias("slice")).agg(
        F.count_distinct("place").alias("places"), F.count("*").alias("urls"))


@query("""SELECT 'page "' || page_id || '", new' AS "Title", url AS "Source URL", page_id % 2 AS "Even" FROM pages""")
def export_csv(t: Tables):
    """A tab with quotes and commas in its cells, written as CSV files and read back."""
    path = fresh_path(t.spark, "tab")
    write_tab(t.pages.select(F.concat(F.lit('page "'), "page_id", F.lit('", new')).alias("Title"),
                             F.col("url").alias("Source URL"), (F.col("page_id") % 2).alias("Even")), path)
    return (t.spark.read.schema('Title string, `Source URL` string, Even bigint').option("header", True)
            .option("escape", '"').csv(path))


# Stored rows of each table for the export tabs.
_AT = "2024-06-05T00:00:00+00:00"


def _export(name: str, source: str, columns: dict[str, tuple]):
    """Register ``export_<table>``: stored columns given as (Spark SQL, DuckDB SQL) under the tab's headers."""
    table, headers = fixed.EXPORT_TABS[name]

    def run(t: Tables):
        stored = getattr(t, source).select(*[F.expr(c).alias(n) for n, (c, _) in columns.items()])
        return tab(stored, name)

    run.__name__ = f"export_{table}"
    shown = ", ".join(f'{columns[c][1]} AS "{header}"' for c, header in headers)
    query(f"SELECT {shown} FROM {source}")(run)


def _register_exports() -> None:
    url = "concat('https://example.org/', {})"
    at = (text_sql(_AT), text_sql(_AT))
    _export("Startups", "customer", {
        "entity_name": ("c_name", "c_name"), "employee_count": ("c_nationkey", "c_nationkey"),
        "source_name": (f"'{fixed.DIRECTORY_NAME}'", f"'{fixed.DIRECTORY_NAME}'"),
        "source_url": (url.format("c_custkey"), url.format("c_custkey")), "collected_at": at})
    _export("Products", "part", {
        "startup_name": ("p_brand", "p_brand"), "pricing_model": ("'FREE'", "'FREE'"),
        "source_name": ("p_type", "p_type"), "source_url": (url.format("p_partkey"), url.format("p_partkey")),
        "collected_at": at})
    _export("Research_Papers", "documents", {
        "title": ("source", "source"), "authors": ("to_json(array(lang, source))", "to_json([lang, source])::VARCHAR"),
        "paper_url": (url.format("doc_id"), url.format("doc_id")),
        "github_url": ("if(lang = 'en', source, null)", "CASE WHEN lang = 'en' THEN source END"),
        "github_stars": ("cast(n_chars as int)", "CAST(n_chars AS INTEGER)"), "published_date": at})
    _export("Jobs", "orders", {
        "company": ("o_orderpriority", "o_orderpriority"), "date": at,
        "is_remote": ("o_orderstatus = 'O'", "CAST(o_orderstatus = 'O' AS INTEGER)"),
        "role_family": (f"'{fixed.ROLE_FAMILY}'", f"'{fixed.ROLE_FAMILY}'"),
        "source_url": (url.format("o_orderkey"), url.format("o_orderkey"))})
    _export("News", "pages", {
        "title": ("concat('page ', page_id)", "concat('page ', page_id)"),
        "source_name": (f"'{fixed.NEWS_FEED_NAMES[0]}'", f"'{fixed.NEWS_FEED_NAMES[0]}'"),
        "source_url": ("url", "url"), "published_date": at, "collected_at": at})
    _export("Entity_Mapping_Log", "events", {
        "raw_name": ("event_type", "event_type"), "canonical_name": ("initcap(event_type)",
                                                                        "upper(event_type[1]) || event_type[2:]"),
        "method": ("'SEED_EXACT'", "'SEED_EXACT'"), "confidence": ("value", "value"),
        "resolved_at": ("ts", "strftime(ts, '%Y-%m-%d %H:%M:%S')")})


_register_exports()

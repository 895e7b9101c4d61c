"""Chunks, health, graph and retrieval over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions.html import page_text
from ..functions.text import chunk_paragraphs as chunks_of
from ..operators import graph, health, retrieve, search
from ..operators.resolve import Catalogue
from .base import NAMES_SQL, Tables, company_names, iso_sql, query, resolve_sql, squash_sql
from .columns import clean_sql

_MAX = 2000
_BLANK_LINE = r"\n[ \t\r]*\n[ \t\r\n]*"


def _chunks_sql(most: int, boundary: str) -> str:
    """Greedy packing by a fold over piece lengths: i = piece number, used = length of the open chunk."""
    return f"""texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    pieces AS (SELECT doc_id, text, flatten(list_transform(list_filter(regexp_split_to_array(text, '{boundary}'),
        lambda p: p <> ''), lambda p: list_transform(range(0, CAST((length(p) - 1) // {most} + 1 AS BIGINT)),
        lambda k: p[(k * {most} + 1):((k + 1) * {most})]))) AS ps FROM texts),
    folded AS (SELECT doc_id, text, ps, list_reduce(
        list_transform(ps, lambda p: {{'i': 0, 'used': CAST(length(p) AS BIGINT), 'starts': []::INTEGER[]}}),
        lambda s, x: {{'i': s.i + 1,
            'used': CASE WHEN s.i = 0 OR s.used + 1 + x.used > {most} THEN x.used ELSE s.used + 1 + x.used END,
            'starts': CASE WHEN s.i = 0 OR s.used + 1 + x.used > {most} THEN list_append(s.starts, s.i + 1)
                      ELSE s.starts END}},
        {{'i': 0, 'used': 0::BIGINT, 'starts': []::INTEGER[]}}).starts AS st FROM pieces),
    chunks AS (SELECT doc_id, CASE WHEN length(text) <= {most} THEN [text] ELSE list_transform(range(1, len(st) + 1),
        lambda k: array_to_string(ps[st[k]:coalesce(st[k + 1] - 1, len(ps))], chr(10))) END AS cs FROM folded)"""


def _chunk_rows_sql(most: int, boundary: str) -> str:
    return f"""WITH {_chunks_sql(most, boundary)},
    rows AS (SELECT doc_id, unnest(range(0, len(cs))) AS chunk, unnest(cs) AS body FROM chunks)
    SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(length(body) AS INTEGER) AS n, sha256(body) AS digest
    FROM rows"""


def _chunk_rows(texts, most: int, boundary: str):
    rows = texts.select("doc_id", F.posexplode(chunks_of("text", most, boundary)).alias("chunk", "body"))
    return rows.select("doc_id", "chunk", F.char_length("body").alias("n"), F.sha2("body", 256).alias("digest"))


@query(_chunk_rows_sql(_MAX, r"\n+"))
def chunk_paragraphs(t: Tables):
    return _chunk_rows(t.documents, _MAX, r"\n+")


@query(_chunk_rows_sql(fixed.MAX_TEXT_CHARS, _BLANK_LINE))
def chunk_blank_lines(t: Tables):
    """Paragraphs end at blank lines only, and chunks hold what one request takes."""
    return _chunk_rows(t.documents, fixed.MAX_TEXT_CHARS, _BLANK_LINE)


def _page_text_sql() -> str:
    """The given pages' bars and drawings are closed and not nested, so patterns can cut them out."""
    text = clean_sql("html", ["script", "style", *fixed.BOILERPLATE_TAGS])
    text = rf"regexp_replace({text}, '(?i)</?({'|'.join(fixed.INLINE_TAGS)})(\s[^>]*)?/?>', '', 'g')"
    text = f"regexp_replace({text}, '<[A-Za-z/!?][^>]*>', chr(10), 'g')"
    lines = f"list_transform(string_split({text}, chr(10)), lambda l: {squash_sql('l')})"
    return f"array_to_string(list_filter({lines}, lambda l: l <> ''), chr(10) || chr(10))"


_DRAWN = '<svg viewBox="0 0 9 9"><title>drawn</title><path d="M0"/></svg>'


@query(f"""WITH documents AS (SELECT page_id AS doc_id, {_page_text_sql()} AS text FROM (SELECT page_id,
    '{_DRAWN}' || replace(html, '&', '+') || '{_DRAWN}' AS html FROM pages) x), """
       + _chunk_rows_sql(500, _BLANK_LINE).removeprefix("WITH ").strip())
def chunk_pages(t: Tables):
    """Pages without scripts, bars and drawings, in chunks that end at paragraphs."""
    html = F.concat(F.lit(_DRAWN), F.replace("html", F.lit("&"), F.lit("+")), F.lit(_DRAWN))
    return _chunk_rows(t.pages.select(F.col("page_id").alias("doc_id"), page_text(html).alias("text")), 500, _BLANK_LINE)


@query("""SELECT l_orderkey, count(*) AS attempts FROM lineitem GROUP BY l_orderkey
    HAVING count(*) >= 4 AND bool_and(l_returnflag = 'R')""")
def dead_letters(t: Tables):
    return health.dead_letters(t.lineitem.withColumn("failed", F.col("l_returnflag") == "R"), "l_orderkey", "failed")


CALLS_SQL = f"""SELECT {iso_sql("window_start")} AS window_start, provider, calls, errors FROM (
    SELECT time_bucket(INTERVAL '60 seconds', ts) AS window_start, 'p' || user_id % 5 AS provider, count(*) AS calls,
    count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1, 2) x
    WHERE errors > calls * 0.2"""


def calls(events):
    return events.select(
        "ts", F.concat(F.lit("p"), F.col("user_id") % 5).alias("provider"),
        (F.col("event_type") == "error").alias("failed"))


def shown_windows(windows):
    from ..functions.dates import py_isoformat
    return windows.withColumn("window_start", py_isoformat("window_start"))


@query(CALLS_SQL)
def error_windows(t: Tables):
    return shown_windows(health.error_windows(calls(t.events), "ts", "provider", "failed"))


@query(f"""WITH {NAMES_SQL}, authors AS (SELECT c_custkey, raw_name FROM names UNION ALL SELECT c_custkey, c_name
    FROM customer), {resolve_sql('authors')}
    SELECT p_brand AS src, 'PRODUCES' AS rel, 'part/' || p_partkey AS dst FROM part
    UNION ALL SELECT o_orderpriority, 'HIRES', 'order/' || o_orderkey FROM orders
    UNION ALL SELECT canonical, 'AUTHORED', 'paper/' || c_custkey FROM authors JOIN res USING (raw_name)
    WHERE method NOT IN ('NONE', 'RULE_NORMALIZATION')""")
def graph_triples(t: Tables):
    products = t.part.select(
        F.col("p_brand").alias("startup_name"), F.concat(F.lit("part/"), "p_partkey").alias("source_url"))
    jobs = t.orders.select(
        F.col("o_orderpriority").alias("company"), F.concat(F.lit("order/"), "o_orderkey").alias("source_url"))
    papers = company_names(t).join(t.customer.select("c_custkey", "c_name"), "c_custkey").select(
        F.concat(F.lit("paper/"), "c_custkey").alias("paper_url"),
        F.to_json(F.array("raw_name", "c_name")).alias("authors"))
    return graph.triples(products, jobs, papers, Catalogue.built_in(t.spark))


@query("""WITH edges AS (SELECT DISTINCT 'customer/' || o_custkey AS src, 'order/' || o_orderkey AS dst FROM orders
    UNION SELECT DISTINCT 'order/' || l_orderkey, 'supplier/' || l_suppkey FROM lineitem),
    s AS (SELECT c_mktsegment AS label, 'customer/' || c_custkey AS node FROM customer),
    h1 AS (SELECT DISTINCT label, dst AS node FROM s JOIN edges ON src = node),
    h2 AS (SELECT DISTINCT label, dst AS node FROM h1 JOIN edges ON src = node)
    SELECT label, node, min(hop) AS hop FROM (SELECT label, node, 0 AS hop FROM s UNION ALL SELECT label, node, 1 FROM h1
    UNION ALL SELECT label, node, 2 FROM h2) x GROUP BY label, node""")
def graph_two_hop(t: Tables):
    """Orders and suppliers reached from the customers of each market segment."""
    placed = t.orders.select(
        F.concat(F.lit("customer/"), "o_custkey").alias("src"), F.concat(F.lit("order/"), "o_orderkey").alias("dst"))
    served = t.lineitem.select(
        F.concat(F.lit("order/"), "l_orderkey").alias("src"), F.concat(F.lit("supplier/"), "l_suppkey").alias("dst"))
    seeds = t.customer.select(
        F.col("c_mktsegment").alias("label"), F.concat(F.lit("customer/"), "c_custkey").alias("node"))
    return graph.reach(placed.unionByName(served), seeds, 2)


@query("""WITH made AS (SELECT DISTINCT p_brand AS src, 'type/' || p_type AS dst FROM part),
    h1 AS (SELECT src AS label, dst AS node FROM made),
    h2 AS (SELECT DISTINCT label, src AS node FROM h1 JOIN made ON node = dst),
    h3 AS (SELECT DISTINCT label, 'order/' || o_orderkey AS node FROM h2 JOIN orders ON
           'Brand#' || (11 + o_custkey % 5) = node)
    SELECT label, node, min(hop) AS hop FROM (SELECT DISTINCT src AS label, src AS node, 0 AS hop FROM made
    UNION ALL SELECT label, node, 1 FROM h1 UNION ALL SELECT label, node, 2 FROM h2
    UNION ALL SELECT label, node, 3 FROM h3) x GROUP BY label, node""")
def graph_relations(t: Tables):
    """Over the triples by relation: what a company makes, who else makes it, and whom those hire."""
    products = t.part.select(
        F.col("p_brand").alias("startup_name"), F.concat(F.lit("type/"), "p_type").alias("source_url"))
    jobs = t.orders.select(
        F.concat(F.lit("Brand#"), F.lit(11) + F.col("o_custkey") % 5).alias("company"),
        F.concat(F.lit("order/"), "o_orderkey").alias("source_url"))
    papers = t.documents.select(F.col("source").alias("paper_url"), F.lit("[]").alias("authors"))
    edges = graph.triples(products, jobs, papers, Catalogue.built_in(t.spark))
    seeds = products.select(F.col("startup_name").alias("label"), F.col("startup_name").alias("node"))
    return graph.reach(edges, seeds, 3, ["PRODUCES", "^PRODUCES", "HIRES"])


_QUERY_VECTOR = [((i * 37) % 11 - 5) / 10 for i in range(64)]
_VECTOR_SQL = "[" + ", ".join(f"{q}::DOUBLE" for q in _QUERY_VECTOR) + "]"
_COSINE_SQL = f"""list_reduce(list_transform(list_zip(embedding::DOUBLE[], {_VECTOR_SQL}), lambda z: z[1] * z[2]),
    lambda a, b: a + b) / (sqrt(list_reduce(list_transform(embedding::DOUBLE[], lambda v: v * v), lambda a, b: a + b))
    * {sum(q * q for q in _QUERY_VECTOR) ** 0.5})"""
_KEYWORDS = ["the", "and", "tion", "ing"]
_SHARE_SQL = "(" + " + ".join(f"CAST(contains(lower(text), '{k}') AS INTEGER)" for k in _KEYWORDS) + ") / 4.0"


@query(f"SELECT vec_id, round({_COSINE_SQL}, 6) AS score FROM embeddings ORDER BY {_COSINE_SQL} DESC, vec_id LIMIT 20")
def vector_topk(t: Tables):
    return retrieve.vector_topk(t.embeddings, "embedding", "vec_id", _QUERY_VECTOR, 20)


@query(f"""SELECT doc_id, round(exact, 6) AS score FROM (SELECT doc_id,
    0.5::DOUBLE * coalesce({_COSINE_SQL}, 0) + 0.5::DOUBLE * CAST({_SHARE_SQL} AS DOUBLE) AS exact
    FROM documents LEFT JOIN embeddings ON vec_id = doc_id) x ORDER BY exact DESC, doc_id LIMIT 20""")
def hybrid_topk(t: Tables):
    texts = t.documents.join(t.embeddings.withColumnRenamed("vec_id", "doc_id"), "doc_id", "left")
    return retrieve.hybrid_topk(texts, "embedding", "text", "doc_id", _QUERY_VECTOR, _KEYWORDS, 20)


# Queries by text: the benchmark passages over all documents. Scores of BM25 are added up as decimals on both sides.
_BM25_SQL = f"""terms AS (SELECT doc_id AS item, unnest(regexp_extract_all(lower(coalesce(text, '')), '{search.TERM}')) AS term FROM documents),
    sizes AS (SELECT doc_id AS item, CAST(len(regexp_extract_all(lower(coalesce(text, '')), '{search.TERM}')) AS BIGINT) AS length FROM documents),
    whole AS (SELECT count(*) AS n, sum(length)::DOUBLE / count(*) AS mean FROM sizes),
    postings AS (SELECT item, term, count(*) AS tf FROM terms GROUP BY 1, 2),
    often AS (SELECT term, count(*) AS df FROM postings GROUP BY 1),
    asked AS (SELECT DISTINCT item_id AS query, unnest(regexp_extract_all(lower(text), '{search.TERM}')) AS term FROM benchmark),
    by_text AS (SELECT query, item, sum(CAST(ln(1.0::DOUBLE + (n::DOUBLE - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * {search.K1 + 1}::DOUBLE
        / (tf + {search.K1}::DOUBLE * ({1 - search.B}::DOUBLE + {search.B}::DOUBLE * length / mean))) AS DECIMAL(20, 9))) AS score
        FROM asked JOIN postings USING (term) JOIN often USING (term) JOIN sizes USING (item), whole GROUP BY 1, 2)"""
_UNIT_SQL = """(SELECT vec_id AS item, list_transform(v, lambda x: x / size) AS unit FROM (SELECT vec_id, embedding::DOUBLE[] AS v,
        sqrt(list_reduce(list_transform(embedding::DOUBLE[], lambda x: x * x), lambda a, b: a + b)) AS size FROM embeddings) x WHERE size > 0)"""


def _by_vector_sql(queries: str) -> str:
    return f"""units AS {_UNIT_SQL},
    by_vector AS (SELECT q.item AS query, e.item, list_reduce(list_transform(list_zip(e.unit, q.unit), lambda z: z[1] * z[2]),
        lambda a, b: a + b) AS score FROM units q, units e WHERE q.item IN ({queries}))"""


def _rank_sql(source: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT query, item, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, item)
        AS INTEGER) AS rank FROM {source}) x WHERE rank <= {k}"""


def _shown(found):
    return found.select("query", "item", "rank", F.round("score", 6).cast("double").alias("score"))


def _text_scores(t: Tables, k: int):
    return search.TextIndex.build(t.documents, "doc_id", "text").scores(t.benchmark, "item_id", "text", k)


@query(f"WITH {_BM25_SQL} SELECT query, item, rank, CAST(round(score, 6) AS DOUBLE) AS score FROM ({_rank_sql('by_text', 10)}) x")
def keyword_topk(t: Tables):
    """The ten documents with most of each benchmark passage's words, by BM25."""
    return _shown(search.best(_text_scores(t, 10), 10))


@query(f"""WITH {_by_vector_sql("SELECT vec_id FROM embeddings WHERE vec_id % 100 = 0")}
    SELECT query, item, rank, round(score, 6) AS score FROM ({_rank_sql('by_vector', 10)}) x""")
def vector_lists(t: Tables):
    """The ten vectors most like each hundredth one, through all inverted lists."""
    index = search.VectorIndex.build(t.embeddings, "vec_id", "embedding", 16)
    return _shown(search.best(index.scores(t.embeddings.filter("vec_id % 100 = 0"), "vec_id", "embedding", k=10), 10))


@query(f"""WITH {_BM25_SQL}, {_by_vector_sql("SELECT item_id FROM benchmark")},
    ranks AS (SELECT query, item, rank FROM ({_rank_sql('by_text', 20)}) x UNION ALL SELECT query, item, rank FROM ({_rank_sql('by_vector', 20)}) y),
    both_ways AS (SELECT query, item, sum(CAST(1.0::DOUBLE / ({search.FUSED} + rank) AS DECIMAL(20, 9))) AS score FROM ranks GROUP BY 1, 2)
    SELECT query, item, rank, CAST(round(score, 6) AS DOUBLE) AS score FROM ({_rank_sql('both_ways', 10)}) x""")
def hybrid_queries(t: Tables):
    """For each benchmark passage the documents by words and by vector (of the same number), fused by rank."""
    asked = t.embeddings.join(t.benchmark.select(F.col("item_id").alias("vec_id")), "vec_id", "left_semi")
    index = search.VectorIndex.build(t.embeddings, "vec_id", "embedding", 16)
    by_vector = search.best(index.scores(asked, "vec_id", "embedding", k=20), 20)
    return _shown(search.fused([search.best(_text_scores(t, 20), 20), by_vector], 10))

"""Column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import html, keys, links, text
from .base import (
    Tables, any_keyword_sql, hash_sql, list_sql, query, squash_sql, strip_sql, text_sql,
)


@query(f"""SELECT p_partkey,
    coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, 'Unknown') AS company,
    coalesce(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END, 'Untitled') AS title,
    coalesce(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size > 25 END, FALSE) AS remote,
    coalesce(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END, '{fixed.BOARD_A_HOME}') AS url FROM part""")
def default_fields(t: Tables):
    key = F.col("p_partkey")
    return t.part.select(
        "p_partkey",
        text.with_default(F.when(key % 3 != 0, F.col("p_brand")), fixed.UNKNOWN_COMPANY).alias("company"),
        text.with_default(F.when(key % 4 != 0, F.col("p_name")), fixed.UNTITLED).alias("title"),
        text.with_default(F.when(key % 5 != 0, F.col("p_size") > 25), False).alias("remote"),
        text.with_default(F.when(key % 7 != 0, F.col("p_type")), fixed.BOARD_A_HOME).alias("url"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 4 = 1 THEN p_brand
    ELSE 'https://www.ycombinator.com/companies/' || lower(p_type) END AS url FROM part""")
def first_nonempty(t: Tables):
    rest = F.col("p_partkey") % 4
    url = F.when(rest == 0, F.col("p_name")).when(rest == 1, F.lit(""))
    cb_url = F.when(rest == 1, F.col("p_brand")).when(rest == 2, F.lit(""))
    template = F.concat(F.lit(fixed.DIRECTORY_URL), F.lower("p_type"))
    return t.part.select("p_partkey", text.first_nonempty(url, cb_url, template).alias("url"))


@query("""SELECT p_partkey, CAST(CASE p_partkey % 5 WHEN 0 THEN p_size ELSE NULL END AS INTEGER) AS employees
    FROM part""")
def digits_to_int(t: Tables):
    rest = F.col("p_partkey") % 5
    size = (F.when(rest == 0, F.col("p_size").cast("string")).when(rest == 1, F.concat("p_size", F.lit("+")))
            .when(rest == 2, F.lit("0")).when(rest == 3, F.concat(F.lit(" "), "p_size", F.lit(" "))))
    return t.part.select("p_partkey", text.digits_to_int(size).alias("employees"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Community' ELSE p_brand END AS author,
    'https://huggingface.co/spaces/' || CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand || '/' || p_name
    ELSE p_brand || '/' || p_name || '/' || p_type END AS url FROM part""")
def split_space_id(t: Tables):
    rest = F.col("p_partkey") % 3
    space = (F.when(rest == 0, F.col("p_name")).when(rest == 1, F.concat_ws("/", "p_brand", "p_name"))
             .otherwise(F.concat_ws("/", "p_brand", "p_name", "p_type")))
    return t.part.select(
        "p_partkey", text.split_space_id(space).alias("author"), text.space_url(space).alias("url"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN 'Unknown' ELSE '' END AS company
    FROM part""")
def company_from_title(t: Tables):
    rest = F.col("p_partkey") % 3
    title = (F.when(rest == 0, F.concat(F.lit("\t "), "p_brand", F.lit(" : "), "p_name", F.lit(": "), "p_type"))
             .when(rest == 1, F.col("p_name")).otherwise(F.concat(F.lit(" : "), "p_name")))
    return t.part.select("p_partkey", text.company_from_title(title).alias("company"))


@query(f"SELECT doc_id, sha256({squash_sql('text')}) AS digest, length({squash_sql('text')}) AS n FROM documents")
def squash_ws(t: Tables):
    flat = text.squash_ws("text")
    return t.documents.select(
        "doc_id", F.sha2(flat, 256).alias("digest"), F.char_length(flat).cast("bigint").alias("n"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || '|' || p_name WHEN 1 THEN p_name ELSE '' END
    AS authors FROM part""")
def author_names(t: Tables):
    rest = F.col("p_partkey") % 3
    person = "struct<name:string>"
    nobody = F.struct(F.lit(None).cast("string").alias("name"))
    first = F.struct(F.concat(F.lit(" "), "p_brand", F.lit("\n")).alias("name"))
    second = F.struct(F.col("p_name").alias("name"))
    authors = F.when(rest == 0, F.array(first, nobody, second)).when(rest == 1, F.array(nobody, second)).otherwise(
        F.array().cast(f"array<{person}>"))
    return t.part.select("p_partkey", F.array_join(text.author_names(authors), "|").alias("authors"))


# Paper abstracts: every document, some with a repository link.
ABSTRACTS_SQL = """abstracts AS (SELECT doc_id, text || CASE doc_id % 5
    WHEN 0 THEN ' Code: https://github.com/org' || doc_id % 97 || '/repo' || doc_id % 10 || '.git.'
    WHEN 1 THEN ' (http://www.github.com/org' || doc_id % 97 || '/repo' || doc_id % 10 || ', 2024)'
    WHEN 2 THEN ' https://github.com/org0/repo0...' ELSE '' END AS summary FROM documents)"""


def abstracts(t: Tables):
    owner, repo = F.col("doc_id") % 97, F.col("doc_id") % 10
    tail = (F.when(F.col("doc_id") % 5 == 0, F.concat(
                F.lit(" Code: https://github.com/org"), owner, F.lit("/repo"), repo, F.lit(".git.")))
            .when(F.col("doc_id") % 5 == 1, F.concat(
                F.lit(" (http://www.github.com/org"), owner, F.lit("/repo"), repo, F.lit(", 2024)")))
            .when(F.col("doc_id") % 5 == 2, F.lit(" https://github.com/org0/repo0..."))
            .otherwise(F.lit("")))
    return t.documents.select("doc_id", F.concat("text", tail).alias("summary"))


REPO_SQL = text_sql(fixed.REPO_PATTERN)
REPO_URL_SQL = f"""rtrim('https://github.com/' || nullif(regexp_extract(summary, {REPO_SQL}, 1), '') || '/'
    || nullif(regexp_extract(summary, {REPO_SQL}, 2), ''), '.')"""
REPO_KEY_SQL = f"""regexp_replace(rtrim(nullif(regexp_extract(summary, {REPO_SQL}, 2), ''),
    {text_sql(fixed.REPO_TRAILING)}), '\\.git$', '')"""


@query(f"WITH {ABSTRACTS_SQL} SELECT doc_id, {REPO_URL_SQL} AS url FROM abstracts")
def repo_url(t: Tables):
    return abstracts(t).select("doc_id", links.repo_url("summary").alias("url"))


@query(f"WITH {ABSTRACTS_SQL} SELECT doc_id, {REPO_KEY_SQL} AS repo FROM abstracts")
def repo_key(t: Tables):
    return abstracts(t).select("doc_id", links.repo_key(links.repo_name("summary")).alias("repo"))


@query(f"""SELECT doc_id, length(cut) AS n, sha256(cut) AS digest FROM (SELECT doc_id,
    CASE WHEN length(text) <= 12000 THEN text
    ELSE text[:8400] || {text_sql(fixed.TRUNCATION_MARK)} || right(text, 3600) END AS cut FROM documents) x""")
def truncate_middle(t: Tables):
    cut = text.truncate_middle("text")
    return t.documents.select(
        "doc_id", F.char_length(cut).cast("bigint").alias("n"), F.sha2(cut, 256).alias("digest"))


@query(f"SELECT doc_id, {hash_sql('text', 'source')} AS hash_key FROM documents")
def hash_key(t: Tables):
    return t.documents.select("doc_id", keys.hash_key("text", "source").alias("hash_key"))


@query(f"""SELECT p_partkey, p_name FROM (SELECT *, CASE WHEN p_partkey % 6 = 0 THEN 'Retail' ELSE p_type END AS
    industry, CASE WHEN p_partkey % 9 = 1 THEN NULL ELSE p_brand END AS sub,
    CASE WHEN p_partkey % 5 = 0 THEN 'Machine' END AS long_text,
    CASE WHEN p_partkey % 10 = 0 THEN 'Learning' ELSE p_name END AS one_liner,
    CASE WHEN p_partkey % 11 = 0 THEN '  ' ELSE p_name END AS name FROM part) x
    WHERE {any_keyword_sql(["industry", "sub", "coalesce(long_text, '') || ' ' || one_liner"],
                           fixed.STARTUP_KEYWORDS)} AND {strip_sql("name")} <> ''""")
def startup_filter(t: Tables):
    key = F.col("p_partkey")
    landed = t.part.withColumns({
        "industry": F.when(key % 6 == 0, F.lit("Retail")).otherwise(F.col("p_type")),
        "sub": F.when(key % 9 != 1, F.col("p_brand")),
        "long_text": F.when(key % 5 == 0, F.lit("Machine")),
        "one_liner": F.when(key % 10 == 0, F.lit("Learning")).otherwise(F.col("p_name")),
        "name": F.when(key % 11 == 0, F.lit("  ")).otherwise(F.col("p_name"))})
    return landed.filter(text.startup_topic("industry", "sub", "long_text", "one_liner")
                         & (text.py_strip("name") != "")).select("p_partkey", "p_name")


@query(f"""SELECT p_partkey, title FROM (SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'Python ' || p_name
    ELSE p_name END AS title, CASE WHEN p_partkey % 4 = 1 THEN NULL WHEN p_partkey % 4 = 2 THEN ['AI ops', p_brand]
    WHEN p_partkey % 4 = 3 THEN ['AI', p_brand] ELSE [p_brand] END AS tags FROM part) x
    WHERE {any_keyword_sql(["title"], fixed.BOARD_B_KEYWORDS)}
       OR coalesce(list_has_any(list_transform(tags, lambda g: lower(g)),
                   ['ai', 'machine learning', 'data', 'python', 'llm']), FALSE)""")
def job_filter_tags(t: Tables):
    rest = F.col("p_partkey") % 4
    landed = t.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("Python "), "p_name")).otherwise(
            F.col("p_name")).alias("title"),
        F.when(rest == 2, F.array(F.lit("AI ops"), "p_brand")).when(rest == 3, F.array(F.lit("AI"), "p_brand")).when(
            rest == 0, F.array("p_brand")).alias("tags"))
    return landed.filter(text.keyword_or_tag("title", "tags", fixed.BOARD_B_KEYWORDS)).select("p_partkey", "title")


@query(f"""SELECT doc_id, {any_keyword_sql(["text"], fixed.BOARD_C_KEYWORDS)} AS board,
    {any_keyword_sql(["text"], fixed.JOB_FEED_KEYWORDS)} AS feed FROM documents""")
def job_filter_title(t: Tables):
    return t.documents.select(
        "doc_id", text.any_keyword(["text"], fixed.BOARD_C_KEYWORDS).alias("board"),
        text.any_keyword(["text"], fixed.JOB_FEED_KEYWORDS).alias("feed"))


def _unescape_sql(e: str) -> str:
    for name, char in fixed.ENTITIES.items():
        e = f"replace({e}, '&{name};', {text_sql(char)})"
    return f"replace({e}, '&amp;', '&')"


def clean_sql(e: str, tags=fixed.PAGE_NOISE_TAGS) -> str:
    e = f"regexp_replace({e}, '<!--.*?-->', '', 'gs')"
    for tag in tags:
        e = f"regexp_replace({e}, '<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'gis')"
    return e


# Paragraphs by a fold over the tags of a page: open elements, and first and last token of each <p>.
PARAGRAPHS_SQL = f"""tokens AS (SELECT page_id, url, regexp_extract_all({clean_sql('html')}, '<[A-Za-z/!?][^>]*>|[^<]+|<') AS tok
    FROM pages),
    tags AS (SELECT page_id, url, tok, list_transform(tok, lambda k: CASE WHEN suffix(k, '/>')
        OR lower(regexp_extract(k, '^<(/?[A-Za-z][A-Za-z0-9]*)', 1)) IN {list_sql(fixed.VOID_TAGS)}
        THEN '' ELSE lower(regexp_extract(k, '^<(/?[A-Za-z][A-Za-z0-9]*)', 1)) END) AS tag FROM tokens),
    folded AS (SELECT page_id, url, tok, list_reduce(
        list_transform(tag, lambda g: {{'i': 0, 'tag': g, 'open': []::STRUCT(name VARCHAR, i INTEGER)[],
                                        'spans': []::STRUCT(f INTEGER, l INTEGER)[]}}),
        lambda s, x: {{'i': s.i + 1, 'tag': x.tag,
            'open': CASE WHEN prefix(x.tag, '/') AND len(list_filter(s.open, lambda o: o.name = x.tag[2:])) > 0
                         THEN s.open[:(len(s.open) - list_position(list_reverse(list_transform(s.open,
                              lambda o: o.name)), x.tag[2:]))]
                         WHEN x.tag = '' OR prefix(x.tag, '/') THEN s.open
                         ELSE list_append(s.open, {{'name': x.tag, 'i': s.i + 1}}) END,
            'spans': CASE WHEN prefix(x.tag, '/') AND len(list_filter(s.open, lambda o: o.name = x.tag[2:])) > 0
                          THEN list_concat(s.spans, list_transform(list_filter(s.open[(len(s.open)
                               - list_position(list_reverse(list_transform(s.open, lambda o: o.name)), x.tag[2:])
                               + 1):], lambda o: o.name = 'p'), lambda o: {{'f': o.i, 'l': s.i + 1}}))
                          ELSE s.spans END}},
        {{'i': 0, 'tag': '', 'open': []::STRUCT(name VARCHAR, i INTEGER)[],
          'spans': []::STRUCT(f INTEGER, l INTEGER)[]}}) AS st FROM tags),
    spans AS (SELECT page_id, url, tok, list_sort(list_concat(st.spans, list_transform(
        list_filter(st.open, lambda o: o.name = 'p'), lambda o: {{'f': o.i, 'l': st.i + 1}}))) AS sp FROM folded),
    texts AS (SELECT page_id, url, list_transform(sp, lambda s: {strip_sql(_unescape_sql(
        "array_to_string(list_filter(tok[(s.f + 1):(s.l - 1)], lambda k: NOT regexp_matches(k, '^</?[A-Za-z!?]')), '')"
        ))}) AS ps FROM spans),
    bodies AS (SELECT page_id, url, coalesce(array_to_string(list_filter(ps, lambda p: length(p) > 30), chr(10) || chr(10)),
        '') AS body FROM texts)"""


@query(f"WITH {PARAGRAPHS_SQL} SELECT page_id, length(body) AS n, sha256(body) AS digest FROM bodies")
def page_paragraphs(t: Tables):
    bodies = t.pages.select("page_id", html.page_paragraphs("html").alias("body"))
    return bodies.select(
        "page_id", F.char_length("body").cast("bigint").alias("n"), F.sha2("body", 256).alias("digest"))

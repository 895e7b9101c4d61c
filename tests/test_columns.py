import hashlib
from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from signalbase import fixed
from signalbase.functions import html, keys, links, text as T

EMPTY = hashlib.sha256(b"").hexdigest()


def test_hash_key(values):
    assert values(keys.hash_key, ["", None]) == [EMPTY, EMPTY]
    a, b = values(keys.hash_key, ["  A_HTTP://X ", "a_http://x"])
    assert a == b == hashlib.sha256(b"a_http://x").hexdigest()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aB é \x1c_/:\t", max_size=12), min_size=20, max_size=40))
def test_hash_key_spec(values, texts):
    assert values(keys.hash_key, texts) == [hashlib.sha256(t.strip().lower().encode()).hexdigest() for t in texts]
    assert values(T.squash_ws, texts) == [" ".join(t.split()) for t in texts]


def test_repository_links(values):
    texts = ["see http://www.github.com/o/r.git.", "https://github.com/a-b/c_d, and https://github.com/x/y", "none",
             "https://github.com/o/..."]
    assert values(links.repo_url, texts) == [
        "https://github.com/o/r.git", "https://github.com/a-b/c_d", None, "https://github.com/o/"]
    assert values(lambda c: links.repo_key(links.repo_name(c)), texts) == ["r", "c_d", None, ""]


def test_hosts(values):
    assert values(links.host, ["https://u@A.b.com:80/x", "http://x.org?q", "no url", None]) == [
        "a.b.com", "x.org", None, None]


def test_small_scalars(values):
    assert values(T.company_from_title, ["Acme: ML Eng", "ML Eng", ": x", "a : b: c"]) == [
        "Acme", "Unknown", "", "a"]
    assert values(T.split_space_id, ["a/b/c", "solo", "/x"]) == ["a", "Community", ""]
    assert values(T.digits_to_int, ["12", "0", None, "12+", " 12 ", "", "12\n", "99999999999"]) == [
        12, None, None, None, None, None, None, None]


def test_truncation(values):
    at, over = "x" * 12000, "a" * 8400 + "b" * 1 + "c" * 3600
    assert values(T.truncate_middle, [at, over]) == [at, "a" * 8400 + fixed.TRUNCATION_MARK + "c" * 3600]


def test_keywords(spark):
    df = spark.createDataFrame(
        [("Cook", ["AI"]), ("Cook", ["ai ops"]), ("Retail clerk", None), (None, ["data"]), ("Cook", None)],
        "title string, tags array<string>")
    kept = df.select(T.keyword_or_tag("title", "tags", fixed.BOARD_B_KEYWORDS)).collect()
    assert [r[0] for r in kept] == [True, False, True, True, False]
    split = spark.createDataFrame([(None, None, "machine", "learning")], "i string, s string, l string, o string")
    assert split.select(T.startup_topic("i", "s", "l", "o")).first()[0] is True


def test_author_names(values):
    people = [[{"name": " Ann\n"}, {"name": None}, {"name": "Bo"}], [], None]
    assert values(T.author_names, people, "array<struct<name:string>>") == [["Ann", "Bo"], [], []]


def greedy(text, limit):
    """Plain restatement of the packing rule."""
    if len(text) <= limit:
        return [text]
    pieces = [p[i:i + limit] for p in text.split("\n") if p for i in range(0, len(p), limit)]
    chunks = []
    for p in pieces:
        if chunks and len(chunks[-1]) + 1 + len(p) <= limit:
            chunks[-1] += "\n" + p
        else:
            chunks.append(p)
    return chunks


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab\n", max_size=60), min_size=20, max_size=40))
def test_chunks(values, texts):
    assert values(lambda c: T.chunk_paragraphs(c, 7), texts) == [greedy(t, 7) for t in texts]


class Paragraphs(HTMLParser):
    """Nested paragraphs as an element stack sees them."""

    def __init__(self):
        super().__init__()
        self.open, self.texts = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in fixed.VOID_TAGS:
            if tag == "p":
                self.texts.append([])
            self.open.append((tag, len(self.texts) - 1 if tag == "p" else None))

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        names = [n for n, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag):]

    def handle_data(self, data):
        for _, i in self.open:
            if i is not None:
                self.texts[i].append(data)

    @classmethod
    def of(cls, page):
        parser = cls()
        parser.feed(page)
        parser.close()
        return ["".join(t).strip() for t in parser.texts]


PIECES = st.sampled_from([
    "<p>", "</p>", "<P class='x>y'>", "<b>", "</b>", "<div>", "</div>", "<br>", "<br/>", "<img src=\"a\">", "one ",
    "two &amp; three ", "&lt;p&gt; ", "caf&#233; ", "&#x41;&copy;", "<!-- <p>no</p> -->", "a < b ", "&unknownx; ", "\n"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=30, max_size=60))
def test_paragraphs_match_an_element_stack(values, pages):
    assert values(html.paragraph_texts, pages) == [Paragraphs.of(p) for p in pages]


def test_page_paragraphs(values):
    long = "This sentence has over thirty chars."
    pages = [
        f"<nav><p>{long}</p></nav><p>{'x' * 30}</p><p> {'y' * 31} </p><script>'<p>{long}</p>'</script><p>{long}</p>",
        "<p>short</p>", "", None]
    assert values(html.page_paragraphs, pages) == ["y" * 31 + "\n\n" + long, "", "", ""]


def test_bad_character_codes(values):
    assert values(html.unescape, ["&#9999999; &#xD800; &# &#; &amp;lt; &"]) == ["� � &# &#; &lt; &"]


def test_html_references(values):
    given = ["&eacute;&rarr;&#146;&#x92;&#129;", "&eacute &copy2 &notit; &nosuch; &AMP", "&#0;&#00065;&#7;&#xFFFE;&#99999999999;",
             "&NotEqualTilde;", "a & b &; &#x; &amp;eacute;"]
    assert values(html.unescape, given) == [
        "é→’’\x81", "é ©2 ¬it; &nosuch; &", "�A�", "≂̸", "a & b &; &#x; &eacute;"]


def test_noise_elements_and_tag_names(values):
    p = "<p>{}</p>".format
    given = [
        f"<nav>{p('a')}<nav>{p('b')}</nav>{p('c')}</nav>{p('d')}", f"<div><nav>{p('a')}</div>{p('b')}",
        "<p>a<aside>b<p>c</p></aside>d</p>", "<p-card>a</p-card><p>b</p>", f"<script>{p('a')}",
        f"<style-x>{p('a')}</style-x>{p('b')}", f"<script>if (a < b) '<p>x</p>'</script>{p('c')}", "<NAV class='>'><p>a</p></NAV ><p>b"]
    assert values(html.paragraph_texts, given) == [["d"], ["b"], ["ad"], ["b"], [], ["a", "b"], ["c"], ["b"]]

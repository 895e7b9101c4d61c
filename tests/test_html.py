"""Paragraphs of a page against a plain stack of open elements, and the growth of the work with the page."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from signalbase import fixed
from signalbase.functions.html import page_paragraphs, paragraph_texts

DROPPED = [t for t in fixed.PAGE_NOISE_TAGS if t not in ("script", "style")]


def plain(page: str) -> list[str]:
    """Tokens one by one; every text goes to all open paragraphs, unless a noise element is open above them."""
    opened, found = [], []
    for token in re.findall(r"<[A-Za-z/!][^>]*>|[^<]+|<", page):
        tag = re.match(r"<(/?)([A-Za-z][^\s/>]*)", token)
        if not tag:
            if not any(name in DROPPED for name, _ in opened):
                for name, place in opened:
                    if name == "p" and place is not None:
                        found[place] += token
            continue
        closing, name = tag[1], tag[2].lower()
        if not closing:
            if not token.endswith("/>") and name not in fixed.VOID_TAGS:
                inside = any(n in DROPPED for n, _ in opened)
                opened.append((name, len(found) if name == "p" and not inside else None))
                if name == "p" and not inside:
                    found.append("")
        elif any(n == name for n, _ in opened):
            while opened.pop()[0] != name:
                pass
    return [f.strip() for f in found]


def test_random_pages_match_a_plain_stack(spark):
    rng = random.Random(7)
    names = ["p", "p", "p", "div", "nav", "footer", "aside", "li", "b", "br", "x-p", "NAV", "svg:p", "p1"]
    pages = []
    for _ in range(400):
        pieces = [rng.choice([f"<{rng.choice(names)}>", f"</{rng.choice(names)}>", f"text {i} ", "<p class='a'>", "<p/>"]) for i in range(rng.randint(0, 40))]
        pages.append("".join(pieces))
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string").orderBy("i").select(paragraph_texts("html").alias("p")).collect()
    for page, row in zip(pages, rows):
        assert row["p"] == plain(page), page


def test_the_work_grows_with_the_page(spark):
    def seconds(n: int) -> float:
        page = "".join(f"<nav>menu {i}</nav><p>Paragraph number {i}, longer than thirty characters.</p>" for i in range(n))
        df = spark.createDataFrame([(page,)], "html string")
        best = []
        for _ in range(2):
            start = time.perf_counter()
            assert df.select(F.size(F.split(page_paragraphs("html"), "\n\n"))).first()[0] == n
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(50)
    assert seconds(4000) <= 20 * max(seconds(500), 0.3)     # about 5 on an idle machine; squares would give 64

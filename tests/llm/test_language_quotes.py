from __future__ import annotations

import random

from pyspark.sql import functions as F

from signalbase.llm import language, quotes

SOUNDS = {"en": ["the", "th", "ing", "wh", "sh"], "de": ["sch", "ung", "ö", "ich", "ei"], "fr": ["eau", "é", "oi", "que", "ç"],
          "es": ["ción", "ñ", "os", "lla", "í"]}


def speak(rng, tag, n):
    return " ".join("".join(rng.choices(SOUNDS[tag], k=rng.randint(1, 3))) for _ in range(n))


def test_language_of_documents(docs):
    rng = random.Random(1)
    rows = [(i, speak(rng, tag, rng.randint(4, 200)), tag if i % 10 else rng.choice(["en", "xx", None, ""]), f"host{i % 3}")
            for i in range(200) for tag in [rng.choice(list(SOUNDS))]]
    rows += [(900, speak(rng, "de", 300), "fr", "host0"), (901, None, "en", "host0"), (902, "", "en", None), (903, " 123 !!", None, None),
             (904, "".join(rng.choices("bcdfghjklmnpqrstvwxyzßłøæþ", k=400)), "en", "host1"), (None, speak(rng, "es", 50), "es-MX", "host2"), rows[1], rows[1]]
    table = docs(rows)
    out = language.identify(table.select(*language.evidence([F.col("doc_id")], F.col("text"), F.col("lang"), host=F.col("source"))))
    got = out.withColumn("rejected", language.is_rejected()).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: r for r in got}
    for i, text, _, _ in rows[:200]:
        guess = max(SOUNDS, key=lambda tag: sum(text.count(s) * len(s) for s in SOUNDS[tag]))
        assert found[i]["language"] == guess
    clean = [r for r in got if r["doc_id"] is None or r["doc_id"] % 10 and r["doc_id"] < 900]
    assert not any(r["rejected"] for r in clean) and found[None]["language"] == "es"
    assert [found[i]["language"] for i in (900, 901, 902, 903, 904)] == ["de", "und", "und", "und", "und"]
    assert all(found[i]["rejected"] for i in (900, 901, 902, 903, 904))
    assert all(0 < r["posterior"] <= 1 for r in got)
    empty = docs([]).select(*language.evidence([F.col("doc_id")], F.col("text"), F.col("lang"), host=F.col("source")))
    assert language.identify(empty).count() == 0


def test_hosts_decide_between_equal_texts(docs):
    """A text that fits two languages goes with its host, and a new host of a known domain with the domain."""
    rng = random.Random(2)
    rows = [(i, speak(rng, "fr" if i % 2 else "en", 40), "fr" if i % 2 else "en", f"h{i % 20}." + ("fr.example" if i % 2 else "en.example")) for i in range(400)]
    unclear = speak(rng, "fr", 1) + " " + speak(rng, "en", 1)
    rows += [(500, unclear, None, "new.fr.example"), (501, unclear, None, "new.en.example")]
    table = docs(rows).select(*language.evidence([F.col("doc_id")], F.col("text"), F.col("lang"), host=F.col("source"),
                                                 domain=F.expr("substring_index(source, '.', -2)")))
    got = {r["doc_id"]: r for r in language.identify(table).collect()}
    chance = {i: got[i]["posterior"] if got[i]["language"] == "fr" else 1 - got[i]["posterior"] for i in (500, 501)}
    assert chance[500] > chance[501]


def test_evidence_from_pages(shipped):
    rows = [("HTTP://A.b.Example.ORG:80/x", "EN-us"), ("nonsense", ""), (None, None), ("https://x.de/", "nds")]
    table = shipped.createDataFrame(rows, "url string, tag string")
    got = table.select(*language.evidence([F.col("url").alias("i")], F.lit("t"), F.col("tag"), F.col("url"))).collect()
    assert [(r["declared"], r["suffix"], r["host"], r["domain"]) for r in got] == [
        ("en", "org", "a.b.example.org", "example.org"), ("none", "", "", ""), ("none", "", "", ""), ("other", "de", "x.de", "x.de")]


def test_languages_are_those_declared(docs):
    """A language declared by enough rows is modelled, also for rows without a tag; rows of a rarer one are kept."""
    rng = random.Random(5)
    words = {"it": ["zione", "gli", "che", "della", "zz"], "ru": ["при", "вет", "ст", "ого", "ы"], "pl": ["szcz", "ł", "ow", "ię", "prz"]}

    def made(tag, n):
        return " ".join("".join(rng.choices(words[tag], k=rng.randint(1, 3))) for _ in range(n))

    rows = [(i, speak(rng, tag, 80), tag, "h") for i in range(100) for tag in [rng.choice(list(SOUNDS))]]
    rows += [(1000 + i, made("it" if i % 2 else "ru", 80), "it" if i % 2 else "ru-RU", "h") for i in range(80)]
    rows += [(2000, made("it", 80), None, "h"), (2001, made("pl", 80), "pl", "h"), (2002, "12 34", "pl", "h"), (2003, made("pl", 80), None, "h")]
    out = language.identify(docs(rows).select(*language.evidence([F.col("doc_id")], F.col("text"), F.col("lang"), host=F.col("source"))))
    got = {r["doc_id"]: r for r in out.withColumn("rejected", language.is_rejected()).collect()}
    assert all(got[i]["language"] == t.split("-")[0] and not got[i]["rejected"] for i, _, t, _ in rows if i < 2000)
    assert got[2000]["language"] == "it" and not got[2001]["rejected"]
    assert got[2002]["rejected"] and not got[2003]["rejected"]


def test_scores_do_not_move_with_the_size():
    import numpy as np

    counts = np.random.default_rng(1).poisson(0.5, (2, language.BINS))
    small, large = (language.log_chances(c, c.sum(axis=1)[:, None]) for c in (counts, counts * 1000))
    assert np.allclose(small, large)


def plain_posteriors(rows):
    """(language, posterior, posterior of the declared language) by loops and dictionaries, one row left out at a time."""
    import math
    from collections import Counter

    bins = [Counter(language.trigrams(text).tolist()) for _, text, _, _ in rows]
    tags = [(tag or "").lower() or "none" for _, _, tag, _ in rows]
    known = [x for x in language.LANGUAGES if x in tags]
    model = {x: sum((b for b, t in zip(bins, tags) if t == x), Counter()) for x in known}

    def mean(have, seen):
        total, n = sum(seen.values()), sum(have.values())
        return sum(c * math.log((0.99 if total else 0) * seen[b] / max(total, 1) + (0.01 if total else 1) / language.BINS) for b, c in have.items()) / n

    scores, votes = [], []
    for have, tag in zip(bins, tags):
        n = sum(have.values())
        scores.append([mean(have, model[x] - have if x == tag else model[x]) * min(n, 64) if n else 0.0 for x in known] + [-math.log(language.BINS) * min(n, 64)])
        votes.append(([*known, "und"][scores[-1].index(max(scores[-1]))]) if n else "und")
    out = []
    for i, (_, text, _, host) in enumerate(rows):
        def count(x, same=lambda j: True):
            return sum(v == x and same(j) for j, v in enumerate(votes) if j != i)

        k, logs = len(known), []
        domain = lambda h: ".".join((h or "").split(".")[-2:])
        of_all = sum(count(x) for x in known)
        of_domain = sum(count(x, lambda j: domain(rows[j][3]) == domain(host)) for x in known)
        of_host = sum(count(x, lambda j: rows[j][3] == host) for x in known)
        for x, score in zip(known, scores[i]):
            share = (count(x) + 1) / (of_all + k)
            share = (count(x, lambda j: domain(rows[j][3]) == domain(host)) + 8 * share) / (of_domain + 8)
            share = (count(x, lambda j: rows[j][3] == host) + 8 * share) / (of_host + 8)
            tag = 0.0 if tags[i] == "none" else math.log((count(x, lambda j: tags[j] == tags[i]) + .5) / (count(x) + .5 * (k + 1)))
            logs.append(score + math.log(share) + tag)
        logs.append(scores[i][-1] + math.log(0.01))
        top = max(logs)
        chances = [math.exp(x - top) for x in logs]
        best = [*known, "und"][logs.index(top)] if bins[i] else "und"
        out.append((best, 1 / sum(chances), chances[known.index(tags[i])] / sum(chances) if tags[i] in known else None))
    return out


def test_posteriors_match_plain_loops(docs):
    rng = random.Random(9)
    rows = [(i, speak(rng, tag, rng.choice([1, 2, 3, 8, 60])), rng.choice([tag, tag, tag, "en", None, "nl"]), rng.choice(["a.x", "b.x", "c.y", "d.e.y"]))
            for i in range(90) for tag in [rng.choice(list(SOUNDS))]]
    rows += [(200, None, "de", "a.x"), (201, "12", None, "c.y"), (202, speak(rng, "fr", 30_000), "fr", "b.x")]
    out = language.identify(docs(rows).select(*language.evidence(
        [F.col("doc_id")], F.col("text"), F.col("lang"), host=F.col("source"))), languages=language.LANGUAGES).collect()
    got = {r["doc_id"]: r for r in out}
    for (i, *_), (best, posterior, declared) in zip(rows, plain_posteriors(rows)):
        assert got[i]["language"] == best, i
        assert abs(got[i]["posterior"] - posterior) < 1e-3, i
        assert (got[i]["declared_posterior"] is None) == (declared is None) and abs((got[i]["declared_posterior"] or 0) - (declared or 0)) < 1e-3, i


def plain_thread(rows):
    """The same by loops over lists, for conversations without equal bodies."""
    def norm(t):
        return " ".join(t.lower().split())

    told = []
    for conv, turn, role, text in rows:
        body, passages, previous = [], [], 0
        for line in (text or "").replace("\r\n", "\n").split("\n"):
            bare, level = line.lstrip(" \t"), 0
            if bare.startswith(">"):
                while bare[:1] in (">", " ", "\t") and bare:
                    level += bare[0] == ">"
                    bare = bare[1:]
                if level == previous:
                    passages[-1][1] += "\n" + bare
                else:
                    passages.append([level, bare])
            else:
                body.append(line)
            previous = level
        told.append((conv, turn, role, "\n".join(body).strip(), [p for p in passages if norm(p[1])]))
    out = []
    for conv, turn, role, body, passages in told:
        parent, linked = (None, None), 0
        for level, text in passages:
            line = max((norm(x) for x in text.split("\n")), key=len)
            ways = []
            for inside in (True, False):
                for whole in (True, False):
                    hits = sorted((c, t, norm(b)) for c, t, _, b, _ in told if (c == conv and t < turn if inside else True)
                                  and norm(b) and (norm(b) == norm(text) if whole else line in [norm(x) for x in b.split("\n")]))
                    if hits:
                        c, t, b = hits[-1] if inside else hits[0]
                        if norm(text) in b and (inside or c != conv):
                            ways.append((c, t))
            to = ways[0] if ways else None
            linked += to is not None
            parent = to if level == 1 and to else parent
        out.append([conv, turn, role, body, max([p[0] for p in passages], default=0), len(passages), linked, *parent])
    up = {(c, t): (pc, pt) for c, t, *_, pc, pt in out if pc == c}
    for row in out:
        at, hops = (row[0], row[1]), 0
        while at in up:
            at, hops = up[at], hops + 1
        row += [at[1], hops]
    for row in out:
        row.append(1 + sum((r[0], r[9], r[1]) < (row[0], row[9], row[1]) for r in out if r[0] == row[0]))
    return sorted(tuple(r) for r in out)


def test_quotation_linking_matches_plain_version(shipped):
    rows = [(1, 0, "user", "Hello  there\nfriend"), (1, 1, "assistant", "> hello there\r\n> FRIEND\r\n\r\nHi"), (1, 2, "user", ">> Hello there\n>> friend\n> Hi\nok\n> unknown passage"),
            (1, 3, "user", "no quote"), (2, 0, "user", " >  > deep\n  > hello there\n>friend\nBye"), (2, 1, "user", "> Bye\nmore\n> hi"), (2, 2, "user", ">\n>  \nonly blank quotes"),
            (3, 0, None, ""), (3, 1, "user", "x > y is no quote")]
    rows += [(9, t, "user", ("> turn %d of nine\n" % (t - 1) if t else "") + f"turn {t} of nine") for t in range(40)]
    rows += [(20, 0, "user", "First paragraph.\n\nSecond one,\nof two lines.\n\nThird."), (20, 1, "assistant", "> second one,\n> OF two lines.\nA"),
             (20, 2, "user", "> Third.\nB"), (20, 3, "user", "> First paragraph.\n> not there\nC"), (20, 4, "user", ">> of two lines.\n> A\nD"),
             (20, 5, "user", "> Second one,\n\n> Third.\nE"), (21, 0, "user", "> of two lines.\nfrom elsewhere"), (21, 1, "user", "Third."), (21, 2, "user", "> third.\nF")]
    table = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    clash = table.withColumns({c: F.lit("x") for c in ("body", "mid", "hash", "up", "passages", "parent")})
    got = sorted((tuple(r) for r in quotes.thread(clash).collect()), key=lambda r: r[:2])
    assert got == plain_thread(rows)


def test_quotation_edge_rows(shipped):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "same"), (1, 0, "user", "same"), (1, 1, "user", "> same\nre"), (None, 3, "user", "> same\nlost"), (4, None, "user", None), (5, 0, "user", "> same\nelsewhere")]
    got = sorted(map(str, quotes.thread(shipped.createDataFrame(rows, schema)).select("conv_id", "turn", "body", "parent_conv", "parent_turn", "root_turn").collect()))
    assert len(got) == 6
    assert "Row(conv_id=1, turn=1, body='re', parent_conv=1, parent_turn=0, root_turn=0)" in got
    assert "Row(conv_id=5, turn=0, body='elsewhere', parent_conv=1, parent_turn=0, root_turn=0)" in got
    assert quotes.thread(shipped.createDataFrame([], schema)).count() == 0


def test_one_short_text_said_and_quoted_without_end(shipped, monkeypatch):
    """Thousands of equal bodies and quotes of one conversation link to the one right before, over blocks of turns."""
    monkeypatch.setattr(quotes, "BLOCK_TURNS", 50)
    rows = [(1, t, "user", "> ok\nok" if t else "ok") for t in range(3000)]
    got = quotes.thread(shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(r["parent_turn"] == (r["turn"] - 1 if r["turn"] else None) and r["place"] == r["turn"] + 1 for r in got) and len(got) == 3000

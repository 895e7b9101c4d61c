"""JSON arrays read by byte ranges: any cut gives the rows of the whole, and a broken file costs only what is broken."""

from __future__ import annotations

import gzip
import json
import random

import pytest

from signalbase.sources import landed as L, ranges


def rows_of(path, size, text, rows):
    """(place, text) of all ranges of ``size`` bytes, their states added up as the driver does."""
    data = text.encode()
    parts = [ranges.Range(str(path), 0, s, min(s + size, len(data)), len(data)) for s in range(0, len(data), size)]
    for before, after in zip(parts, parts[1:]):
        end, change, keys = json.loads(json.dumps(ranges.effect(before)))[before.inside]
        after.inside, after.depth, after.key = end, before.depth + change, keys.get(str(1 - before.depth), before.key)
    return [row for part in parts for row in ranges.elements(part, rows)]


def values(rng, depth=0):
    kind = rng.random()
    if depth > 2 or kind < .4:
        return rng.choice([1, -2.5, None, True, "", "a", 'quo"te', "back\\", "\\\\", "}{][,", '"jobs": [', "ü☃", "x" * 30, "\\\""])
    if kind < .7:
        return {rng.choice(["jobs", "k", 'q"', "data", "j\\"]): values(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [values(rng, depth + 1) for _ in range(rng.randint(0, 3))]


@pytest.mark.parametrize("seed", range(60))
def test_any_cut_gives_the_elements_of_the_whole(tmp_path, seed):
    rng = random.Random(seed)
    array = [values(rng) for _ in range(rng.randint(0, 12))]
    outer = seed % 2 == 0
    document = array if outer else {"other": values(rng), "list": [values(rng) for _ in range(3)], "jobs": array, "end": [values(rng)], "meta": {"jobs": [1, {"a": 2}]}}
    text = json.dumps(document, indent=rng.choice([None, 1, 3]), ensure_ascii=rng.random() < .5)
    path = tmp_path / "d.json"
    path.write_bytes(text.encode())
    want = [v for v in array if v is not None]
    for size in (1, 2, 3, 7, 16, 50, 10**6):
        found = rows_of(path, size, text, None if outer else "jobs")
        assert [json.loads(t) for _, t, _ in found] == want, size
        assert [p for p, _, _ in found] == sorted({p for p, _, _ in found})


def test_documents_without_the_array(tmp_path):
    for text, rows, want in [('{"a": 1}', "jobs", []), ('{"jobs": null}', "jobs", []), ('{"jobs": {"a": 1, "b": [2]}}', "jobs", []), ("[]", None, []),
                             ("  ", None, []), ('﻿[{"a": 1}]', None, ['{"a": 1}']), ('{"id": "x"}', None, ['{"id": "x"}']),
                             ("<html>, [1]", "jobs", ["<html>, [1]"]), ('[{"a": 1}, {"b', None, ['{"a": 1}', '{"b']), ("[1, 2", None, ["1", "2"])]:
        path = tmp_path / "x.json"
        path.write_text(text)
        assert [t for _, t, _ in rows_of(path, 4, text, rows)] == want


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_BYTES", 20_000)
    bad = 777
    rows = [{"name": f"n{i}", "url": f'u"{i}', "one_liner": "x{" * (i % 50)} if i != bad else 5 for i in range(5000)]
    (tmp_path / "d.json").write_text(json.dumps(rows, indent=1))
    read = L.read_directory(spark, str(tmp_path / "d.json"))
    assert read.rdd.getNumPartitions() > 20
    assert [r["name"] for r in L.good_rows(read).orderBy("ingest_seq").collect()] == [f"n{i}" for i in range(5000) if i != bad]
    assert [r[L.CORRUPT] for r in L.corrupt_rows(read).collect()] == ["5"]


def test_a_broken_file_costs_only_what_is_broken(spark, tmp_path):
    """Of four files one is cut off, one is a broken archive, one cannot be opened: the other rows stay, each file is named."""
    whole = json.dumps({"data": [{"title": f"t{i}"} for i in range(3000)]})
    folder = tmp_path / "b"
    folder.mkdir()
    (folder / "1.json").write_text(whole)
    (folder / "2.json").write_text(whole.replace("t", "c")[:20_000])
    (folder / "3.json.gz").write_bytes(gzip.compress(json.dumps({"data": [{"title": f"g{i} {random.random()}"} for i in range(3000)]}).encode())[:15_000])
    (folder / "4.json").write_text(whole)
    read = L.read_jobs_b(spark, str(folder))
    (folder / "4.json").unlink()
    found = [r["title"] for r in L.good_rows(read).collect() if r["title"]]
    assert sum(t[0] == "t" for t in found) == 3000 and sum(t[0] == "g" for t in found) > 500
    told = [r[L.CORRUPT] for r in L.corrupt_rows(read).collect()]
    assert any("unreadable" in t and "3.json.gz" in t for t in told) and any("unreadable" in t and "4.json" in t for t in told)


@pytest.mark.parametrize("lines", [True, False])
def test_all_shapes_by_pattern(spark, tmp_path, lines):
    """The five shapes from two dumps of several files each, numbered in path order, one bad element aside."""
    shapes = {L.read_directory: (None, {"name": "n"}, "name"), L.read_spaces: (None, {"id": "n"}, "id"), L.read_jobs_a: ("jobs", {"company_name": "n"}, "company_name"),
              L.read_jobs_b: ("data", {"title": "n"}, "title"), L.read_jobs_c: ("jobs", {"jobTitle": "n"}, "jobTitle")}
    for k, (read, (key, row, field)) in enumerate(shapes.items()):
        for dump in "ab":
            folder = tmp_path / f"{k}" / f"dump-{dump}"
            folder.mkdir(parents=True)
            for f in range(3):
                rows = [{**row, field: f"{dump}{f}{i}"} for i in range(4)] + ([5] if dump == "b" and f == 1 else [])
                (folder / f"{f}.json").write_text(json.dumps({key: rows} if key else rows) + "\n")
        found = read(spark, str(tmp_path / f"{k}" / "dump-*"), lines=lines)
        assert [r[field] for r in L.good_rows(found).orderBy("ingest_seq").collect()] == [f"{d}{f}{i}" for d in "ab" for f in range(3) for i in range(4)]
        assert [r[L.CORRUPT] for r in L.corrupt_rows(found).collect()] == ["5"]

"""JSON arrays of any size, read by byte ranges that are cut on element borders.

Files are cut into ranges of RANGE_BYTES. What a byte means hangs on all bytes before it (inside a text? how deep?), so a first
job notes for each range of a longer file what it does to that state, for both possible beginnings; the notes, one per range,
are added up in order, and a second job reads all ranges at once, each from its known state. A range owns the elements that begin
in it and reads on to the end of its last one.

A file that cannot be opened or read to its end costs only what could not be read: its other elements stay, and a row with
the problem takes their place.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # so that executors need not have this package

RANGE_BYTES = 32 << 20
CONTEXT = 4096          # bytes before a range that are looked at, for the key of an array and for backslashes
BATCH_BYTES = 4 << 20
FORMAT = "signalbase_json"
_SIGNS = np.zeros(256, np.int8)
_SIGNS[list(b"{}[],")] = 1
_STEP = np.zeros(256, np.int8)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)


def signs(data: np.ndarray, inside: int, slashes: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and step of all signs ``{ } [ ] ,`` outside of texts, and whether the end is inside one.

    ``inside``: whether the data begin inside a text; ``slashes``: how many backslashes stand right before them.
    """
    quotes = np.flatnonzero(data == 34)
    if slashes or (data == 92).any():
        plain = np.flatnonzero(data != 92)
        at = np.searchsorted(plain, quotes)     # plain bytes before each quote
        before = np.where(at > 0, plain[at - 1] if len(plain) else -1, -1 - slashes)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]
    found = np.flatnonzero(_SIGNS[data])
    found = found[(np.searchsorted(quotes, found) + inside) % 2 == 0]
    return found, _STEP[data[found]], (len(quotes) + inside) % 2


def key_before(data: bytes, place: int) -> str | None:
    """The key of the value that begins at ``place``; None for an element of an array."""
    match = _KEY.search(data[max(0, place - CONTEXT):place])
    return None if match is None else json.loads(b'"' + match[1] + b'"')


@dataclass
class Range(InputPartition):
    path: str
    file: int                   # number of the file in path order
    start: int
    end: int
    size: int
    inside: int = 0
    depth: int = 0
    key: str | None = None      # key of the array at depth one that the range begins in


def _open(path: str):
    from pyarrow import fs
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if colon else path)
    authority, _, name = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{authority}/")
    return system.open_input_file(f"{root.rstrip('/')}/{name}")


def unpacked(file) -> tuple[bytes, str | None]:
    """What a gzip file holds as far as it can be unpacked, and the problem that ended it."""
    pieces, unzip = [], None
    try:
        while packed := file.read(1 << 20):
            while packed:
                unzip = unzip or zlib.decompressobj(31)
                pieces.append(unzip.decompress(packed))
                packed = unzip.unused_data
                unzip = None if unzip.eof else unzip    # after the end a further member may follow
    except zlib.error as problem:
        return b"".join(pieces), str(problem)
    return b"".join(pieces), "the archive ends early" if unzip else None


class _File:
    """Bytes of one file, by place; a compressed one is unpacked as a whole."""

    def __init__(self, path: str, size: int):
        self.size, self.problem, self.whole = size, None, None
        file = _open(path)
        if path.endswith(".gz"):
            self.whole, self.problem = unpacked(file)
            self.size = len(self.whole)
        self.file = file

    def read(self, start: int, length: int) -> bytes:
        if self.whole is not None:
            return self.whole[start:start + length]
        self.file.seek(start)
        return self.file.read(length)


def effect(part: Range) -> list:
    """For each beginning (outside, inside a text): the end, the change of depth, and the last opening at each relative depth."""
    file = _File(part.path, part.size)
    lead = file.read(max(0, part.start - CONTEXT), min(CONTEXT, part.start))
    raw = file.read(part.start, part.end - part.start)
    data = np.frombuffer(raw, np.uint8)
    slashes = len(lead) - len(lead.rstrip(b"\\"))
    out = []
    for inside in (0, 1):
        at, step, end = signs(data, inside, slashes)
        before = np.cumsum(step, dtype=np.int64) - step
        opens = np.flatnonzero((step > 0) & (before <= 1) & (before > -64))[::-1]
        last = opens[np.unique(before[opens], return_index=True)[1]]
        keys = {int(before[i]): key_before(lead + raw, len(lead) + int(at[i])) if data[at[i]] == 91 else None for i in last}
        out.append([end, int(step.sum()), keys])
    return out


def elements(part: Range, rows: str | None) -> Iterator[tuple[int, str | None, str | None]]:
    """(place, text, problem) of the elements that begin in the range: those of the outer array, or of the array ``rows`` of the
    outer object. A document without such an array gives its whole text if it is not an object with ``rows`` asked for."""
    file = _File(part.path, part.size)
    size = file.size
    end = size if file.whole is not None else part.end
    first = file.read(0, CONTEXT).removeprefix(b"\xef\xbb\xbf").lstrip()[:1]
    base = {(b"[", True): 1, (b"{", False): 2}.get((first, rows is None))
    if base is None:
        if part.start == 0 and first:
            yield 0, file.read(0, size).removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace"), None
        if part.start == 0 and file.problem:
            yield size, None, file.problem
        return
    inside, depth, start = part.inside, part.depth, part.start
    active = depth >= base and (base == 1 or part.key == rows)
    held: list[bytes] | None = None         # bytes of the element that is open
    began = 0
    lead = file.read(max(0, start - CONTEXT), min(CONTEXT, start))
    while start < size and (start < end or held is not None):
        raw = file.read(start, min(RANGE_BYTES, end - start) if start < end else 1 << 20)
        if not raw:
            break
        at, step, inside = signs(np.frombuffer(raw, np.uint8), inside, len(lead) - len(lead.rstrip(b"\\")))
        after = depth + np.cumsum(step, dtype=np.int64)
        border = np.where(step > 0, after == base, after - step == base)      # into the array, out of it, or a comma in it
        depth = int(after[-1]) if len(after) else depth
        cut = 0
        for place, kind in zip(at[border].tolist(), step[border].tolist()):
            if held is not None:
                held.append(raw[cut:place])
                text = b"".join(held).strip()
                if text and text != b"null":
                    yield began, text.decode("utf-8", "replace"), None
                held = None
            if kind > 0:
                active = raw[place] == 91 and (base == 1 or key_before(lead + raw, len(lead) + place) == rows)
            elif kind < 0:
                active = False
            if start + place >= end:
                return                      # the last own element is whole
            if active and kind >= 0:
                held, cut, began = [], place + 1, start + place + 1
        if held is not None:
            held.append(raw[cut:])
        start, lead = start + len(raw), (lead + raw)[-CONTEXT:]
    if held is not None and (text := b"".join(held).strip()):
        yield began, text.decode("utf-8", "replace"), None      # the file ends inside an element
    if file.problem:
        yield size, None, file.problem


SCHEMA = pa.schema([("path", pa.string()), ("file", pa.int64()), ("place", pa.int64()), ("text", pa.string()), ("problem", pa.string())])


class JsonRows(DataSource):
    """Options: ``ranges`` (the Range fields, as JSON), ``rows`` (key of the array; empty for an outer one), ``effects`` (first job)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, file bigint, place bigint, text string, problem string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.ranges = [Range(*r) for r in json.loads(options["ranges"])]
        self.rows = options.get("rows") or None
        self.effects = options.get("effects") == "true"

    def partitions(self):
        return self.ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in self._rows(partition) if partition else ():
            held.append((partition.path, partition.file, *row))
            size += len(row[1] or "") + 100
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), SCHEMA.types)], schema=SCHEMA)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), SCHEMA.types)], schema=SCHEMA)

    def _rows(self, partition: Range) -> Iterator[tuple]:
        try:
            if self.effects:
                yield partition.start, json.dumps(effect(partition)), None
            else:
                yield from elements(partition, self.rows)
        except OSError as problem:
            yield partition.start, None, f"{type(problem).__name__}: {problem}"


def _load(spark: SparkSession, ranges: list[Range], **options: str) -> DataFrame:
    spark.dataSource.register(JsonRows)
    plain = json.dumps([(r.path, r.file, r.start, r.end, r.size, r.inside, r.depth, r.key) for r in ranges])
    return spark.read.format(FORMAT).options(ranges=plain, **options).load()


def json_rows(spark: SparkSession, path: str, rows: str | None = None) -> DataFrame:
    """``path, file, place, text, problem``: one row per element, by number of the file and byte place, or per problem.

    ``path`` is a file, a folder or a glob; the list of its files, which Spark's scan makes, and one note per range of files
    over RANGE_BYTES are held by the driver.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()      # lists them, reads nothing
    ranges = []
    for number, (name, size) in enumerate(sorted(files)):
        whole = name.endswith(".gz") or size <= RANGE_BYTES
        for start in [0] if whole else range(0, size, RANGE_BYTES):
            ranges.append(Range(name, number, start, size if whole else min(start + RANGE_BYTES, size), size))
    if any(r.start for r in ranges):
        long = {r.path for r in ranges if r.start}
        found = _load(spark, [r for r in ranges if r.path in long], effects="true").where("text IS NOT NULL").collect()
        notes = {(r["path"], r["place"]): json.loads(r["text"]) for r in found}
        for before, after in zip(ranges, ranges[1:]):
            if before.path == after.path and (before.path, before.start) in notes:
                end, change, keys = notes[before.path, before.start][before.inside]
                after.inside, after.depth = end, before.depth + change
                after.key = keys.get(str(1 - before.depth), before.key)
    return _load(spark, ranges, rows=rows or "")


def problem_of(path: str, kind: str) -> str | None:
    """What keeps a file from being read as a whole: no footer (Parquet), no end of its outer element (XML), a broken archive."""
    try:
        file = _open(path)
        if kind == "parquet":
            from pyarrow import parquet
            parquet.ParquetFile(file)
            return None
        size = file.size()
        if path.endswith(".gz"):
            whole, problem = unpacked(file)
            head, tail = whole[:CONTEXT], whole[-CONTEXT:]
        else:
            head, problem = file.read(CONTEXT), None
            file.seek(max(0, size - CONTEXT))
            tail = file.read()
        outer = re.search(rb"<([A-Za-z][^\s/>]*)", head)
        if problem is None and outer and not re.search(rb"</" + re.escape(outer[1]) + rb"\s*>\s*\Z", tail):
            problem = "the document ends early"
        return problem
    except (OSError, pa.ArrowInvalid) as problem:
        return f"{type(problem).__name__}: {problem}"


def broken_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``path, problem`` of the ``parquet`` or ``xml`` files under ``path`` that cannot be read as a whole. Looks at both ends of each
    file only (all of an archive), in parallel."""
    listed = spark.read.format("binaryFile").load(path).select("path").repartition(spark.sparkContext.defaultParallelism)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [(p, problem) for p in batch.column("path").to_pylist() if (problem := problem_of(p, kind))]
            if told:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*told)], names=["path", "problem"])

    return listed.mapInArrow(look, "path string, problem string")

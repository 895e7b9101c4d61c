"""Removal of byte strings that occur elsewhere, by sorted suffixes.

A string of WIDTH bytes is repeated if and only if its suffix and a neighbour in the sorted list of all suffixes share WIDTH
leading bytes. Sorting every suffix of a corpus would move hundreds of bytes per byte of text, so the suffixes are
first cut into runs that can only repeat together, and only runs that may repeat are sorted:

1. In each window of WIDTH bytes the smallest hash of its GRAM-byte strings (leftmost of equals) picks an anchor. Equal
   windows pick the same anchor string at the same place. Consecutive windows with one anchor form a run.
2. Runs are counted by a hash of the anchor string: a window whose anchor occurs once in the corpus is not repeated.
3. Runs with a common anchor are counted by a digest of all their bytes: equal runs repeat in whole.
4. What is left (runs that share their anchor but not all their bytes, mostly at the edges of repeated passages) gets its
   bytes. The suffixes that start in these runs are range-partitioned by the anchor's leading bytes with sampled splitters,
   sorted in each bucket by multikey quicksort and compared with their neighbours. Splitters fall between anchors, so
   no two equal suffixes lie on different sides of a boundary. An anchor with too many different runs for one bucket
   has its windows counted by digest instead, over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import slices

WIDTH = 200
GRAM = 40
SORTED_BYTES = 1 << 20  # bytes of whole anchors whose windows are sorted at once
SPLIT_RUNS = 4096       # different runs of one anchor beyond which its windows are counted instead of sorted

_B = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_B, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_B, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each string of ``gram`` bytes, the same wherever it stands."""
    n = len(data)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(0x1000003)) * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values: of a block's tail and the next block's head."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    head = np.minimum.accumulate(padded, axis=1).ravel()
    tail = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - width + 1], head[width - 1:n])


def runs(raw: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows, anchor's place in the text) of each run of a text."""
    if len(raw) < width:
        none = np.array([], np.int64)
        return none.astype(np.uint64), none, none, none
    h = gram_hashes(np.frombuffer(raw, np.uint8), gram)
    places = np.arange(len(h), dtype=np.uint64)
    least = sliding_least((h >> np.uint64(32) << np.uint64(32)) | places, width - gram + 1)
    anchors = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    return h[anchors[first]], first, np.diff(np.r_[first, len(anchors)]), anchors[first]


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tag, text``: the id and a hash of the text name a row, so rows that share an id are told apart.

    The hash has 64 bits, since a third of all rows may share an id, or have none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def _anchor_counts(rows: DataFrame, width: int) -> DataFrame:
    """``anchor``: hashes of anchor strings that occur at least twice."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                found = [runs(_raw(t), width)[0] for t in batch.column("text").to_pylist()]
                anchors, counts = np.unique(np.concatenate(found or [np.array([], np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(counts > 1)],
                                                 names=["anchor", "many"])

    found = rows.select("text").mapInArrow(scan, "anchor long, many boolean")
    return found.groupBy("anchor").agg(F.count("*").alias("n"), F.max("many").alias("many")).where("n > 1 OR many").select("anchor")


def _all_runs(rows: DataFrame, width: int) -> DataFrame:
    """``anchor, digest, doc_id, tag, first, n``: every run of every text. The digest need only tell apart runs of an anchor."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                anchor, digest, at, first, n = [], [], [], [], []
                for i, t in enumerate(batch.column("text").to_pylist()):
                    raw = _raw(t)
                    h, start, count, _ = runs(raw, width)
                    anchor.append(h.view(np.int64))
                    first.append(start)
                    n.append(count)
                    at.append(np.full(len(h), i))
                    digest.extend(_digest(raw[s:s + c + width - 1]) for s, c in zip(start.tolist(), count.tolist()))
                none = [np.array([], np.int64)]
                take = pa.array(np.concatenate(at or none))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(anchor or none)), pa.array(np.frombuffer(b"".join(digest), np.int64)),
                     batch.column("doc_id").take(take), batch.column("tag").take(take),
                     pa.array(np.concatenate(first or none).astype(np.int32)),
                     pa.array(np.concatenate(n or none).astype(np.int16))],
                    names=["anchor", "digest", "doc_id", "tag", "first", "n"])

    return rows.mapInArrow(scan, "anchor long, digest long, doc_id long, tag long, first int, n short")


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=8).digest()


def repeated_windows(texts: list[bytes], places: list[int], width: int = WIDTH) -> list[np.ndarray]:
    """For each run, which of its windows (suffixes cut at ``width`` bytes) another one equals.

    ``places``: the anchor's place in the run, above it the number of the anchor. Equal windows have the anchor at the same place, so the multikey quicksort takes
    the place as its first key and eight bytes as each of the others: windows are sorted by one key at a time, and only those
    that are equal so far go on to the next. What is left after the last key is repeated.
    """
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    words = np.zeros(len(data) - 7, np.uint64)      # the eight bytes from each byte on, the first one highest
    for k in range(8):
        words |= data[k:len(data) - 7 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = sizes - width + 1
    run = np.repeat(np.arange(len(texts)), counts)
    own = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)       # place of a window in its run
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + own
    items, group = np.arange(len(run)), np.zeros(len(run), np.int64)
    for level in range(-1, -(-width // 8)):
        if level < 0:
            key = np.repeat(np.array(places, np.int64), counts) - own
        else:
            key = words[starts[items] + 8 * level]
            if 8 * level + 8 > width:
                key = key >> np.uint64(8 * (8 * level + 8 - width))
        order = np.lexsort((key, group))
        key, ahead = key[order], group[order]
        group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (ahead[1:] != ahead[:-1])])
        stay = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        items, group = items[order][stay], group[stay]
        if not len(items):
            break
    flags = np.zeros(len(run), bool)
    flags[items] = True
    return np.split(flags, np.cumsum(counts)[:-1])


def stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, number) of each stretch of set flags."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return [(int(s), int(e - s)) for s, e in zip(edges[::2], edges[1::2])]


def _with_bytes(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The wanted runs ``(anchor, hot, doc_id, tag, first, n)`` with the anchor's leading bytes, its place and their bytes."""
    by_text = (wanted.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("anchor", "hot", "first", "n")).alias("wanted"))
               .withColumnsRenamed({"doc_id": "_id", "tag": "_tag"}))
    held = (rows.join(by_text, rows.doc_id.eqNullSafe(F.col("_id")) & (rows.tag == F.col("_tag")))
            .select("doc_id", "tag", "text", "wanted").dropDuplicates(["doc_id", "tag"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                out = []
                for i, tag, t, wants in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "text", "wanted"))):
                    raw = _raw(t)
                    _, first, _, place = runs(raw, width)
                    where = dict(zip(first.tolist(), place.tolist()))
                    for w in wants:
                        a, s = where[w["first"]], w["first"]
                        out.append((raw[a:a + 8], w["anchor"], w["hot"], i, tag, s, a - s, raw[s:s + w["n"] + width - 1]))
                kinds = (pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 8, kinds)],
                    names=["lead", "anchor", "hot", "doc_id", "tag", "first", "place", "bytes"])

    return held.mapInArrow(cut, "lead binary, anchor long, hot boolean, doc_id long, tag long, first int, place int, bytes binary")


_COVER = "doc_id long, tag long, first int, n int"


def _cover(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)],
                                      names=["doc_id", "tag", "first", "n"])


def _sorted_buckets(held: DataFrame, width: int) -> DataFrame:
    """Stretches of repeated windows among runs of the same anchor, in buckets of leading bytes.

    The splitters are whole (leading bytes, anchor) keys, so an anchor's suffixes never cross a boundary between buckets;
    anchors with too many runs for that do not come here.
    """
    dealt = held.repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(members: list[tuple]) -> list[tuple]:
            # The number of its anchor stands above a place, so windows of several anchors are sorted at once.
            found = repeated_windows([m[4] for m in members], [(m[5] << 32) + m[3] for m in members], width)
            return [(i, tag, first + s, n) for (i, tag, first, *_), flags in zip(members, found)
                    for s, n in stretches(flags)]

        key, number, held, members, out = None, 0, 0, [], []
        for batch in batches:
            names = ("anchor", "doc_id", "tag", "first", "place", "bytes")
            for anchor, *rest in zip(*(batch.column(c).to_pylist() for c in names)):
                if anchor != key:
                    if held > SORTED_BYTES:
                        out += flush(members)
                        members, number, held = [], 0, 0
                    key, number = anchor, number + 1
                members.append((*rest, number))
                held += len(rest[-1])
            yield _cover(out)
            out = []
        if members:
            yield _cover(flush(members))

    return dealt.mapInArrow(compare, _COVER)


def _counted_windows(held: DataFrame, width: int) -> DataFrame:
    """The same for anchors with very many runs: their windows are counted by a digest, which Spark pre-aggregates."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "bytes", 256 << 10):
                out = [(hashlib.blake2b(raw[w:w + width], digest_size=16).digest(), i, tag, first + w)
                       for i, tag, first, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "first", "bytes")))
                       for w in range(len(raw) - width + 1)]
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)],
                    names=["window", "doc_id", "tag", "first"])

    windows = held.mapInArrow(explode, "window binary, doc_id long, tag long, first int")
    many = windows.groupBy("window").agg(F.count("*").alias("k")).where("k > 1").select("window")
    return windows.join(many, "window").select("doc_id", "tag", "first", F.lit(1).alias("n"))


def covers(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, tag, first, n``: stretches of windows that are repeated, per text; they may overlap or touch."""
    # As a written table, so that the join reads plain shuffles on both sides and AQE can split a frequent anchor.
    anchors = stage(_anchor_counts(rows, width), "anchors")
    known = stage(_all_runs(rows, width).join(anchors, "anchor"), "runs")
    equal = stage(known.groupBy("anchor", "digest").agg(
        F.count("*").alias("k"), F.min(F.struct("doc_id", "tag", "first", "n")).alias("one")), "equal-runs")
    mixed = equal.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = equal.join(mixed, "anchor").select("anchor", (F.col("kinds") > SPLIT_RUNS).alias("hot"), "one.*")
    held = stage(_with_bytes(rows, wanted, width), "run-bytes")
    whole = (known.join(equal.where("k > 1").select("anchor", "digest"), ["anchor", "digest"])
             .select("doc_id", "tag", "first", F.col("n").cast("int").alias("n")))
    return (whole.union(_sorted_buckets(held.where("NOT hot"), width))
            .union(_counted_windows(held.where("hot"), width)))


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, kept (bytes), n_bytes, n_removed, n_spans (maximal removed runs of bytes).

    Each byte covered by a string of ``width`` bytes that also starts elsewhere, in any text, is removed; overlapping strings
    count and all are judged on the input. Strings never cross texts. A null text counts as empty; texts shorter than
    ``width`` stay as they are. Rows that share an id are separate texts; equal rows repeat each other. Null ids are ids
    like any other. Other columns are not read. An empty table gives an empty result.
    """
    rows = _rows(docs, id_col, text_col)
    found = (covers(rows, width).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "n")).alias("cover"))
             .withColumnsRenamed({"doc_id": "_id", "tag": "_tag"}))
    both = (rows.join(found, rows.doc_id.eqNullSafe(F.col("_id")) & (rows.tag == F.col("_tag")), "left")
            .select("doc_id", "text", "cover"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                kept, sizes, removed, spans = [], [], [], []
                for t, cover in zip(batch.column("text").to_pylist(), batch.column("cover").to_pylist()):
                    raw = _raw(t)
                    marks = np.zeros(len(raw) + 1, np.int64)
                    if cover:
                        starts = np.array([c["first"] for c in cover])
                        np.add.at(marks, starts, 1)
                        np.add.at(marks, starts + np.array([c["n"] for c in cover]) + width - 1, -1)
                    gone = np.cumsum(marks)[:-1] > 0
                    kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if cover else raw)
                    sizes.append(len(raw))
                    removed.append(int(gone.sum()))
                    spans.append(len(stretches(gone)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                    names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return both.mapInArrow(keep, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")

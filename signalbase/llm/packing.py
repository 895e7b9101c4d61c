"""Packing of token streams into fixed sequences, mixed from one queue per source.

Each source is a queue. A window of tokens is filled by a deficit round-robin: every queue is given its share of the window
(its target, or without targets its part of all tokens), takes the whole tokens of that credit, and carries the rest, its
deficit, to the next window. Once a queue is empty the others share by the same proportions. After j windows a queue has thus
taken ``floor(weight * (j * window - tokens of the empty queues) / weight of the others)`` tokens and its deficit is the fraction
left. Since that is known for every j, a partition starts with the deficits that the ones before it have left, without waiting
for them: each document finds its windows from the tokens that precede it in its queue, a prefix sum.

Sources beyond MAX_QUEUES share the last queue. Its tokens are dealt to them along a binary tree: of n tokens at a node
with l and r tokens below, floor(n l / (l + r)) go left and the others right. Each source thus has its share of every
window too, to within a token for each level, and finds its windows from the totals on its own path, a row of a table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import prefix_sums, slices, texts_of
from .tokens import encoder

MAX_QUEUES = 256    # sources with a queue of their own; any further ones (the smallest) share the last queue


def dealt(path: list[tuple[int, int, int]], n: int) -> tuple[int, int]:
    """Of a shared queue's first ``n`` tokens: those of the source at ``path``, and those of all sources left of it.

    A path has (is right, tokens left, tokens right) for each node from the source's own up to the root.
    """
    left = 0
    for right, a, b in reversed(path):
        part = n * a // (a + b)
        n, left = (n - part, left + part) if right else (part, left)
    return n, left


def reached(path: list[tuple[int, int, int]], n: int) -> int:
    """The least number of a shared queue's tokens that hold ``n`` of the source at ``path``."""
    for right, a, b in path:
        n = (n - 1) * (a + b) // b + 1 if right else -(-n * (a + b) // a)
    return n


@dataclass
class Rounds:
    """Where each queue's tokens lie. ``totals``: tokens of each queue; ``window``: tokens dealt in one round; ``weights``: whole
    numbers by which queues share a round (default: their totals, so that all are empty at the same time)."""

    totals: list[int]
    window: int
    length: int
    weights: list[int] | None = None

    def __post_init__(self):
        self.all = sum(self.totals)
        self.count = -(-self.all // self.window) if self.all else 0
        self.known: dict[int, tuple[list[int], list[int], list[int]]] = {}
        if self.weights:
            # Queues in the order in which they run empty; from ``since[i]`` tokens on, i of them are, with ``spent[i]`` tokens.
            order = sorted(range(len(self.totals)), key=lambda q: Fraction(self.totals[q], self.weights[q]))
            self.rank = {q: i for i, q in enumerate(order)}
            self.since, self.spent, self.others = [Fraction(0)], [0], [sum(self.weights)]
            for q in order:
                left = self.others[-1] - self.weights[q]
                self.spent.append(self.spent[-1] + self.totals[q])
                self.since.append(self.spent[-1] + Fraction(self.totals[q], self.weights[q]) * left)
                self.others.append(left)
        full, rest = divmod(self.all, self.length)
        self.full = full
        # What is left after the full sequences goes to sequences of powers of two, which need no padding.
        self.tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]

    def taken(self, queue: int, rounds: int) -> int:
        """Tokens that a queue has given after so many windows."""
        if rounds >= self.count:
            return self.totals[queue]
        if not self.weights:
            return rounds * self.window * self.totals[queue] // self.all
        empty = bisect_right(self.since, rounds * self.window) - 1
        if self.rank[queue] < empty:
            return self.totals[queue]
        return self.weights[queue] * (rounds * self.window - self.spent[empty]) // self.others[empty]

    def window_of(self, queue: int, n: int) -> int:
        """The window in which a queue gives its ``n``-th token."""
        if not self.weights:
            return min(self.count, -(-n * self.all // (self.window * self.totals[queue]))) - 1
        return bisect_left(range(self.count + 1), n, key=lambda j: self.taken(queue, j)) - 1

    def round(self, j: int) -> tuple[list[int], list[int], list[int]]:
        """Window j: tokens taken before it, tokens taken after it, and the place of its first token, by queue."""
        if j not in self.known:
            if len(self.known) > 4096:
                self.known.clear()
            queues = range(len(self.totals))
            before, after = [self.taken(q, j) for q in queues], [self.taken(q, j + 1) for q in queues]
            place, places = sum(before), []
            for q in queues:
                places.append(place)
                place += after[q] - before[q]
            self.known[j] = before, after, places
        return self.known[j]

    def pieces(self, queue: int, first: int, n: int, path: list[tuple[int, int, int]] = []) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) for ``n`` tokens that have ``first`` tokens of their source before them.

        ``path``: the source's place in a shared queue.
        """
        done = 0
        while done < n:
            u = first + done
            j = self.window_of(queue, reached(path, u + 1))
            before, after, places = self.round(j)
            (given, left), (due, left_due) = dealt(path, before[queue]), dealt(path, after[queue])
            end = min(n, done + due - u)
            place = places[queue] + left_due - left + u - given
            while done < end:
                sequence, offset, room = self.locate(place)
                size = min(room, end - done)
                yield done, size, sequence, offset
                done += size
                place += size

    def locate(self, place: int) -> tuple[int, int, int]:
        """Sequence, offset in it and room from there on for a place on the line of all tokens."""
        if place < self.full * self.length:
            return place // self.length, place % self.length, self.length - place % self.length
        start = self.full * self.length
        for k, size in enumerate(self.tail):
            if place < start + size:
                return self.full + k, place - start, start + size - place
            start += size
        raise IndexError(place)


def tokenize(docs: DataFrame, path: str, ranks_path: str | None = None, end_id: int = 0, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row its ids with ``end_id`` after them, and where it stands in its source within its partition.

    ``ids`` holds little-endian unsigned numbers, of 16 bits if the vocabulary allows, else 32.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, ranks_path)
        kind = "<u2" if tokens.size <= 1 << 16 else "<u4"
        part, so_far = TaskContext.get().partitionId(), {}
        for whole in batches:
            for batch in slices(whole, "text"):
                sizes, ids, before = [], [], []
                for x, s in zip(tokens.ids(texts_of(batch)), batch.column("queue").to_pylist()):
                    ids.append(np.append(x, np.uint32(end_id)).astype(kind).tobytes())
                    sizes.append(len(x) + 1)
                    before.append(so_far.get(s, 0))
                    so_far[s] = before[-1] + sizes[-1]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("queue"), pa.array([part] * n, pa.int32()),
                     pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "queue", "part", "before", "doc_tokens", "ids"])

    queue = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(source_col).cast("string")))
    rows = docs.select(F.col(id_col).alias("doc_id"), queue.alias("queue"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, queue string, part int, before long, doc_tokens long, ids binary")


def paths(tail: DataFrame) -> DataFrame:
    """``queue, path`` for the sources of ``tail(queue, n)`` that share a queue, by grouped sums for each level of the tree."""
    ranked = stage(prefix_sums(tail.select("queue", "n", F.lit(0).alias("all"), F.lit(1).alias("one"),
                                           F.expr("pmod(xxhash64(queue), 1024)").alias("block")),
                               "all", "block", ["queue"], "one", "rank").select("queue", "n", "rank"), "ranks")
    depth = max(0, ranked.count() - 1).bit_length()
    if not depth:
        return ranked.select("queue", F.expr("array()").cast("array<struct<level:int,right:int,a:bigint,b:bigint>>").alias("path"))
    levels = (ranked.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth - 1))))
              .withColumn("node", F.expr("shiftright(rank, level + 1)"))
              .withColumn("right", F.expr("cast(shiftright(rank, level) & 1 AS int)")))
    sums = levels.groupBy("level", "node").agg(F.sum(F.when(F.col("right") == 0, F.col("n")).otherwise(0)).alias("a"),
                                               F.sum(F.when(F.col("right") == 1, F.col("n")).otherwise(0)).alias("b"))
    return (levels.join(sums, ["level", "node"]).groupBy("queue")
            .agg(F.array_sort(F.collect_list(F.struct("level", "right", "a", "b"))).alias("path")))


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, length: int = 1024, window: int = 16,
         max_queues: int = MAX_QUEUES, targets: dict[str | None, float] | None = None, **columns) -> DataFrame:
    """Cut all documents into pieces and lay them in sequences of ``length`` tokens without padding.

    Windows hold ``window`` sequences; in each, every source has its share of all tokens, to within one token; sources beyond
    the ``max_queues`` - 1 largest to within one for each level of their tree. ``targets`` asks for other shares of each window, by
    source (each in a queue of its own); sources not named share the rest by their tokens. Targets hold as long as all
    queues have tokens; then the others go on in the same proportions. Returns per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source. All sequences are full but
    the last few, whose lengths are powers of two.

    A null or empty text still has its end id, so it has one piece. A null source is a queue of its own. Repeated rows
    are packed each. Columns other than the three named are not read. An empty table gives an empty result.
    Tokens are written once to the shared folder. Counts by (partition, source) are joined back to them; Spark broadcasts those
    as long as they are small, else the tokens are shuffled once.
    """
    rows = stage(tokenize(docs, path, ranks_path, **columns), "tokens")
    totals = rows.groupBy("queue").agg(F.sum("doc_tokens").alias("n"))
    asked = {"-" if x is None else f"={x}": share for x, share in (targets or {}).items()}
    if len(asked) >= max_queues or sum(asked.values()) > 1 + 1e-9 or min(asked.values(), default=0) < 0:
        raise ValueError("targets must be shares of one whole, of fewer sources than there are queues")
    own = totals.orderBy(F.desc(F.col("queue").isin(list(asked))), F.desc("n"), "queue").limit(max_queues - 1).collect()
    every = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    counts = [r["n"] for r in own]
    names = {r["queue"]: i for i, r in enumerate(own)}
    full = counts + [every - sum(counts)] if every > sum(counts) else counts
    rest = every - sum(r["n"] for r in own if r["queue"] in asked)
    left = max(0.0, 1 - sum(asked[r["queue"]] for r in own if r["queue"] in asked))
    shares = [asked.get(r["queue"], left * r["n"] / max(rest, 1)) for r in own] + [left * n / max(rest, 1) for n in full[len(own):]]
    rounds = (full, window * length, length, [max(1, round(x * 10 ** 12)) for x in shares] if asked else None)

    lane = F.lit(len(own))
    if names:
        lane = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("queue")), lane)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("n")).withColumn("lane", lane)
              .withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"))
    if every > sum(counts):
        starts = starts.join(stage(paths(totals.where(lane == len(own))), "paths"), "queue", "left")
    else:
        starts = starts.withColumn("path", F.lit(None).cast("array<struct<level:int,right:int,a:bigint,b:bigint>>"))
    starts = stage(starts, "starts")        # so that Spark knows its size

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Rounds(*rounds)
        for whole in batches:
            for batch in slices(whole, "ids"):
                at, out = [], []
                fields = (batch.column(c).to_pylist() for c in ("ids", "doc_tokens", "lane", "first", "before", "path"))
                for i, (ids, n, queue, first, before, path) in enumerate(zip(*fields)):
                    raw = memoryview(np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes())
                    path = [(x["right"], x["a"], x["b"]) for x in path or ()]
                    for start, size, sequence, offset in plan.pieces(queue, first + before, n, path):
                        at.append(i)
                        out.append((start, size, zlib.crc32(raw[4 * start:4 * (start + size)]), n, sequence, offset))
                picked = pa.array(at, pa.int32())
                numbers = [pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(picked), *numbers, batch.column("queue").take(picked)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    placed = rows.join(starts, ["queue", "part"]).select("doc_id", "queue", "lane", "first", "before", "doc_tokens", "ids", "path")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (placed.mapInArrow(lay, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                   "sequence_id long, offset long, queue string")
            .withColumn("source", F.when(F.col("queue") != "-", F.expr("substring(queue, 2)"))).drop("queue"))

"""Cheapest edits that make a conversation alternate, by Hirschberg's divide and conquer.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``. Four states are enough to check that: nothing
yet, after s, after u, after a. A stretch of rows is therefore a 4 x 4 table of least costs between states, and stretches
join by min-plus products. Half-way through, forward costs from the entry and backward costs to the exit meet; the best
crossing splits the problem in two, so no table of all rows is ever kept.

Of equally cheap edits the one with the ASCII-least initials counts. An edit of a row is a run of inserts and one letter that uses
the row up, so two different edit strings over the same rows are never a beginning of one another, and they are ordered by where
they first part. It is enough to carry the *rank* of the least string of each state along with its cost: strings from
different states differ already before, strings from one state differ in the last row's letters.

A conversation may hold a third of all rows. Rows are range-partitioned by conversation and order, so it spreads over many
partitions, and each partition's stretch of it becomes one 4 x 4 table; only those are joined on the driver (two a
partition at most). Then every partition knows the states at which its stretch begins and ends and repairs it alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import fresh_path, stage

START, S, U, A, END = range(5)      # END: anywhere a conversation may end, after closing inserts
NEXT = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
WANTED = {START: "u", S: "u", U: "a", A: "u"}       # the role that an insert or a new role gets
ROLE = {"u": "user", "a": "assistant"}
CLOSING = {START: "", S: "II", U: "I", A: ""}
INSERT, REROLE, DELETE, CUT = 2, 2, 3, 1
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
NONE = (1 << 40, 0)                 # cost and rank of a state that cannot be reached
TEXT_BYTES = 32 << 20               # text in one partition
CHUNK = 1 << 20                     # characters of a piece of a conversation that crosses partitions


@lru_cache(maxsize=64)
def moves(initial: str, fault: str | None) -> list[list[tuple[int, str] | None]]:
    """For a row, by state before and state after: least (cost, letters) with inserts before it; None if there is no way."""
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for before in range(4):
        at, cost, letters = before, 0, ""
        for _ in range(3):              # a third insert would only lead back
            ways = [(at, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                cut = CUT if fault == TRUNCATED else 0
                ways.append((NEXT[at][WANTED[at]], REROLE + cut, "R"))
                if initial in NEXT[at]:
                    ways.append((NEXT[at][initial], cut, "K"))
            for after, price, letter in ways:
                way = (cost + price, letters + letter)
                if table[before][after] is None or way < table[before][after]:
                    table[before][after] = way
            at, cost, letters = NEXT[at][WANTED[at]], cost + INSERT, letters + "I"
    return table


Vector = tuple[tuple[int, int], ...]        # per state: least cost and rank of its least string


@lru_cache(maxsize=1 << 16)
def _step(vector: Vector, kind: tuple[str, str | None]) -> tuple[int, Vector]:
    table, best = moves(*kind), []
    for after in range(4):
        ways = [(vector[b][0] + table[b][after][0], vector[b][1], table[b][after][1])
                for b in range(4) if vector[b] != NONE and table[b][after]]
        best.append(min(ways, default=None))
    order = sorted({w[1:] for w in best if w})
    least = min(w[0] for w in best if w)
    return least, tuple((w[0] - least, order.index(w[1:])) if w else NONE for w in best)


def forward(entry: int, kinds: Sequence[tuple], start: int = 0, stop: int | None = None) -> tuple[int, Vector]:
    """(least cost, costs above it and ranks by state) after rows start..stop, coming from state ``entry``."""
    total, vector = 0, tuple((0, 0) if s == entry else NONE for s in range(4))
    for i in range(start, len(kinds) if stop is None else stop):
        more, vector = _step(vector, kinds[i])
        total += more
    return total, vector


@lru_cache(maxsize=1 << 16)
def _step_back(costs: tuple[int, ...], kind: tuple[str, str | None]) -> tuple[int, tuple[int, ...]]:
    table = moves(*kind)
    best = [min((table[b][a][0] + costs[a] for a in range(4) if table[b][a]), default=NONE[0]) for b in range(4)]
    least = min(best)
    return least, tuple(min(x - least, NONE[0]) for x in best)


def ending(exit_: int) -> tuple[int, ...]:
    return tuple((INSERT * len(CLOSING[s]) if exit_ == END else 0 if s == exit_ else NONE[0]) for s in range(4))


def backward(exit_: int, kinds: Sequence[tuple], start: int, stop: int) -> tuple[int, ...]:
    """Per state before row ``start``: cost to ``exit_`` after row ``stop``, less a constant."""
    costs = ending(exit_)
    for i in range(stop - 1, start - 1, -1):
        costs = _step_back(costs, kinds[i])[1]
    return costs


def crossing(vector: Vector, costs: Sequence[int]) -> int:
    """The state at which least forward and backward costs meet; of several the one with the least string before it."""
    return min((vector[s][0] + costs[s], vector[s][1], s) for s in range(4) if vector[s] != NONE)[2]


def hirschberg(kinds: Sequence[tuple], entry: int = START, exit_: int = END) -> list[str]:
    """The letters of each row: inserts before it, then its own."""
    out: list[str] = [""] * len(kinds)
    work = [(0, len(kinds), entry, exit_)]
    while work:
        i, j, enter, leave = work.pop()
        if j - i > 1:
            mid = (i + j) // 2
            state = crossing(forward(enter, kinds, i, mid)[1], backward(leave, kinds, mid, j))
            work += [(mid, j, state, leave), (i, mid, enter, state)]
        elif j > i:
            costs, table = ending(leave), moves(*kinds[i])
            ways = [(table[enter][s][0] + costs[s], table[enter][s][1], s) for s in range(4) if table[enter][s]]
            out[i] = min(ways)[1]
    return out


def first_fault() -> Column:
    """The first fault of a row by its columns ``text`` and ``again`` (role and text seen at an earlier turn)."""
    trimmed = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    return (F.when(trimmed == "", BLANK).when(F.col("again"), DUPLICATE)
            .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), TRUNCATED))


def ordered(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies, again, fault`` in order, with ``part``: written range by range.

    Rows equal in all four columns are one row with their number, so that even a row repeated without end is one place of the
    order; its copies after the first are duplicates. Text hashes of 128 bits tell whether a text was seen at an earlier turn.
    Ranges hold about TEXT_BYTES of text, whatever the cluster's settings.
    """
    spark = rows.sparkSession
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    said = [F.col("conv_id"), F.col("role"), F.md5("text").alias("hash")]
    seen = stage(rows.groupBy(*said).agg(F.min(at).alias("first"), F.max(at).alias("last"))
                 .where("first < last").drop("last"), "repeated-turns").toDF("_conv", "_role", "_hash", "_first")
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    marked = (once.join(seen, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
                        & (F.md5("text") == F.col("_hash")), "left")
              .withColumn("again", F.coalesce(F.col("_first") < at, F.lit(False))).drop("_conv", "_role", "_hash", "_first"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // TEXT_BYTES))
    order = ["conv_id", "turn", "role", "text"]
    dealt = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    path = fresh_path(spark, "ordered-turns")
    final = dealt.withColumn("fault", first_fault()).withColumn("part", F.spark_partition_id())
    final.write.option("parquet.block.size", 2**31 - 1).parquet(path)      # one row group: no part is read by two tasks
    return spark.read.schema(final.schema).parquet(path)


def _segments(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((part, conv_id), rows) of each run of one conversation in one partition; rows are tuples of ``names``."""
    key, held = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("part", "conv_id", *names)]
        for part, conv, *row in zip(*columns):
            if (part, conv) != key:
                if held:
                    yield key, held
                key, held = (part, conv), []
            held.append(tuple(row))
    if held:
        yield key, held


def _kinds(rows: list[tuple]) -> list[tuple[str, str | None]]:
    """Initial and fault of each row; initials of roles that must change anyway count as one."""
    return [(r[0][:1] if r[0][:1] in ("s", "u", "a") else "", r[1]) for r in rows]


def tables(table: DataFrame) -> DataFrame:
    """``part, conv_id, place, costs`` of the first and the last conversation of each partition: all that can cross its borders.

    ``costs``: for each entry the least cost, then cost and rank of the four states (36 numbers).
    """
    kind = table.schema["conv_id"].dataType

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for found in _segments(batches, ("role", "fault")):
            if first is not None and first[0][0] != found[0][0]:       # a task may read several parts
                yield from emit(first, last)
                first = last = None
            first, last = first or found, found
        if first is not None:
            yield from emit(first, last)

    def emit(first, last) -> Iterator[pa.RecordBatch]:
        for place, ((part, conv), rows) in enumerate([first] if first is last else [first, last]):
            kinds, costs = _kinds(rows), []
            for entry in range(4):
                least, vector = forward(entry, kinds)
                costs += [least, *(x for pair in vector for x in pair)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([conv], key_type), pa.array([place], pa.int32()),
                                              pa.array([costs], pa.list_(pa.int64()))], names=["part", "conv_id", "place", "costs"])

    from pyspark.sql.pandas.types import to_arrow_type
    key_type = to_arrow_type(kind)
    return table.select("part", "conv_id", "role", "fault").mapInArrow(
        compute, f"part int, conv_id {kind.simpleString()}, place int, costs array<long>")


def borders(found: list) -> dict[tuple[int, int], tuple[int, int]]:
    """(part, place) -> (entry, exit) of each stretch of a conversation that crosses a border, from its 4 x 4 tables."""
    chains: list[list] = []
    for row in sorted(found, key=lambda r: (r["part"], r["place"])):
        if row["place"] == 0 and chains and chains[-1][-1]["conv_id"] == row["conv_id"]:
            chains[-1].append(row)
        else:
            chains.append([row])
    out = {}
    for chain in (c for c in chains if len(c) > 1):
        tables_ = [[(row["costs"][9 * e], tuple(zip(row["costs"][9 * e + 1:9 * e + 9:2], row["costs"][9 * e + 2:9 * e + 9:2])))
                    for e in range(4)] for row in chain]
        vectors: list[list] = [[(0, 0), NONE, NONE, NONE]]
        for table in tables_:
            best = []
            for after in range(4):
                ways = [(vectors[-1][b][0] + table[b][0] + table[b][1][after][0], vectors[-1][b][1], table[b][1][after][1])
                        for b in range(4) if vectors[-1][b] != NONE and table[b][1][after] != NONE]
                best.append(min(ways, default=None))
            order = sorted({w[1:] for w in best if w})
            vectors.append([(w[0], order.index(w[1:])) if w else NONE for w in best])
        costs, states = list(ending(END)), [END]
        for i in range(len(chain) - 1, 0, -1):
            costs = [min(tables_[i][b][0] + tables_[i][b][1][a][0] + costs[a] for a in range(4)) for b in range(4)]
            states.append(crossing(tuple(vectors[i]), costs))
        states = [START, *reversed(states)]
        for i, row in enumerate(chain):
            out[row["part"], row["conv_id"]] = states[i], states[i + 1]
    return out


EDITS = "part int, conv_id {}, whole boolean, edit string, times long, turn {}, was string, fault string, role string, text string"


def repair(rows: DataFrame) -> DataFrame:
    """The edits of all conversations in ``rows(conv_id, turn, role, text)``, in order within each partition of the result.

    One row per edit: ``part`` (conversations that cross partitions continue in the next part), ``whole`` (the conversation lies in
    this part alone), ``edit`` K, R, D or I, ``times`` (over 1 for deleted copies), ``turn, was, fault`` of the edited row (null for
    inserts), ``role, text`` of the repaired one (null where deleted).

    Rows are taken by turn (null first), then role and text in byte order. A null role or text counts as one space; rows with a null
    conv_id are one conversation. Texts without a word and repeats of an earlier (role, text) must go, whatever their
    number. Only the four columns are read. An empty table gives no edits. A partition holds one conversation's rows
    of its own range at a time, at most about TEXT_BYTES of text and one text more.
    """
    plain = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    table = ordered(plain)
    known = borders(tables(table).collect())        # two rows a partition at most
    schema = EDITS.format(table.schema["conv_id"].dataType.simpleString(), table.schema["turn"].dataType.simpleString())
    names = [f.split(" ")[0] for f in schema.split(", ")]
    from pyspark.sql.pandas.types import to_arrow_type
    types = [pa.int32(), to_arrow_type(table.schema["conv_id"].dataType), pa.bool_(), pa.string(), pa.int64(),
             to_arrow_type(table.schema["turn"].dataType), pa.string(), pa.string(), pa.string(), pa.string()]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for (part, conv), found in _segments(batches, ("role", "fault", "turn", "text", "copies")):
            entry, exit_ = known.get((part, conv), (START, END))
            lead = (part, conv, (part, conv) not in known)
            for edit in edits(found, entry, exit_):
                out.append(lead + edit)
                held += len(edit[-1] or "") + 100
                if held > CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return table.select("part", "conv_id", "role", "fault", "turn", "text", "copies").mapInArrow(compute, schema)


def edits(rows: list[tuple], entry: int = START, exit_: int = END) -> Iterator[tuple]:
    """(edit, times, turn, was, fault, role, text) for rows of (role, fault, turn, text, copies)."""
    letters = hirschberg(_kinds(rows), entry, exit_)
    state = entry
    for (role, fault, turn, text, copies), word in zip(rows, letters):
        for letter in word:
            if letter == "D":
                yield "D", copies if fault == BLANK else 1, turn, role, fault, None, None
                continue
            to = role[:1] if letter == "K" else WANTED[state]
            state = NEXT[state][to]
            if letter == "I":
                yield "I", 1, None, None, None, ROLE[to], ""
            else:
                yield letter, 1, turn, role, fault, role if letter == "K" else ROLE[to], text
        if copies > 1 and fault != BLANK:
            yield "D", copies - 1, turn, role, DUPLICATE, None, None
    if exit_ == END:
        for _ in CLOSING[state]:
            state = NEXT[state][to := WANTED[state]]
            yield "I", 1, None, None, None, ROLE[to], ""


class Account:
    """What is told of a conversation, added up over its edits in order, and over its pieces in order."""

    NUMBERS = ("blank", "duplicate", "truncated", "illegal", "cost", "distinct")

    def __init__(self) -> None:
        self.numbers = dict.fromkeys(self.NUMBERS, 0)
        self.first_turn = self.last_turn = None
        self.first = self.last = None       # initials of the first and the last row
        self.audit: list[str] = []
        self.said = False
        self.hash = hashlib.sha256()

    def add(self, edit: str, times: int, turn: Any, was: str | None, fault: str | None, role: str | None, text: str | None) -> str:
        """Take one edit; the text it adds to the repaired conversation."""
        self.audit.append(edit * times)
        n = self.numbers
        if edit == "I":
            n["cost"] += INSERT
        else:
            n["cost"] += DELETE * times if edit == "D" else (REROLE if edit == "R" else 0) + (CUT if fault == TRUNCATED else 0)
            if fault:
                n[fault] += times
            self._meet(was[:1], was[:1], times - 1)
            self._turns(turn, turn, turn is not None)
        if role is None:
            return ""
        line = ("\n" if self.said else "") + f"{role}:{text}"
        self.said = True
        return line

    def _meet(self, first: str | None, last: str | None, within: int = 0) -> None:
        legal = ("su", "ua", "au")
        self.numbers["illegal"] += within       # copies of one row: a role beside itself
        if first is None:
            return
        if self.first is None:
            self.first = first
        elif self.last + first not in legal:
            self.numbers["illegal"] += 1
        self.last = last

    def _turns(self, first: Any, last: Any, distinct: int) -> None:
        if first is not None:
            self.numbers["distinct"] += distinct - (first == self.last_turn)
            self.first_turn = first if self.first_turn is None else self.first_turn
            self.last_turn = last

    def join(self, piece: dict) -> None:
        for name in self.NUMBERS:
            if name != "distinct":
                self.numbers[name] += piece[name]
        self._meet(piece["first"], piece["last"])
        self._turns(piece["first_turn"], piece["last_turn"], piece["distinct"])
        self.audit.append(piece["audit"])
        if piece["told"] is not None:
            self.tell(("\n" if self.said else "") + piece["told"])
            self.said = True

    def tell(self, text: str) -> None:
        self.hash.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> dict:
        return {**self.numbers, "first_turn": self.first_turn, "last_turn": self.last_turn, "first": self.first, "last": self.last,
                "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def accounts(found: DataFrame) -> DataFrame:
    """Per conversation with an edit: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``found`` are the edits as ``repair`` gives them. A conversation inside one partition is added up on the way. The pieces of
    one that crosses partitions (at most one less than there are partitions) are sorted and read by one task as a stream: SHA-256 takes a text from
    its beginning to its end, so that step cannot be shared out; it holds a piece of CHUNK characters and the audit.
    """
    conv, turn = (found.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    fields = (f"part int, piece int, conv_id {conv}, whole boolean, " + ", ".join(f"{n} long" for n in Account.NUMBERS)
              + f", first_turn {turn}, last_turn {turn}, first string, last string, audit string, repaired_sha256 string, told string")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(fields))
    names = ["part", "conv_id", "whole", "edit", "times", "turn", "was", "fault", "role", "text"]

    def batches_of(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row["told"] or "") + len(row["audit"]) + 300
            if size > CHUNK:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            key, account, told, size, piece = None, Account(), [], 0, 0

            def closed() -> dict:
                return {**account.row(), "part": key[0], "conv_id": key[1], "whole": key[2], "piece": piece,
                        "told": None if key[2] or not account.said else "".join(told)}

            for batch in batches:
                for part, conv, whole, *edit in zip(*[batch.column(n).to_pylist() for n in names]):
                    if (part, conv, whole) != key:
                        if key is not None:
                            yield closed()
                        key, account, told, size, piece = (part, conv, whole), Account(), [], 0, 0
                    line = account.add(*edit)
                    if whole:
                        account.tell(line)
                        continue
                    told.append(line)
                    size += len(line) + 1
                    if size > CHUNK:
                        yield closed()
                        account, told, size, piece = Account(), [], 0, piece + 1
            if key is not None:
                yield closed()
        return batches_of(rows())

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            key, account = (), Account()
            for batch in batches:
                for piece in batch.to_pylist():
                    if (piece["conv_id"],) != key:
                        if key:
                            yield {**account.row(), "conv_id": key[0], "told": None}
                        key, account = (piece["conv_id"],), Account()
                    account.join(piece)
            if key:
                yield {**account.row(), "conv_id": key[0], "told": None}
        return batches_of(rows())

    folded = stage(found.mapInArrow(fold, fields), "accounts")
    united = (folded.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
              .mapInArrow(unite, fields))
    return folded.where("whole").unionByName(united).select(
        "conv_id", F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults by crc32 of ``conv_id:turn`` (nulls as one space), modulo 20.

    0 drops the row, 1 empties its text, 2 takes its ``[.!?]`` out, 3 doubles it, 4 makes it a user's.
    """
    def space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20))
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return (rows.select("conv_id", "turn", "role", "text", fault.alias("_f")).where("_f <> 0")
            .select("conv_id", "turn", F.when(F.col("_f") == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_n"))
            .drop("_n"))


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows``: the account of its repair after ``damaged``; zeros, no audit and an empty text where no row is left."""
    found = accounts(repair(damaged(rows)))
    every = rows.select(F.col("conv_id").alias("_conv")).distinct()
    joined = every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(F.col("_conv").alias("conv_id"), *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))

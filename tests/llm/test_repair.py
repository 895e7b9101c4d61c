"""Structure repair against a plain search over whole edit strings, and over all splits into partitions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from signalbase.llm import repair

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def plain_account(rows):
    """rows of one conversation, any order."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    # least (cost, audit) by the roles' initials so far, all strings kept whole
    best = {"": (0, "", ())}

    def legal(initials):
        body = initials[1:] if initials[:1] == "s" else initials
        return all(c == "ua"[i % 2] for i, c in enumerate(body))

    def squeeze(found):     # only the last initial matters for what may follow
        out = {}
        for initials, value in found:
            if legal(initials):
                key = initials[-1:]
                if key not in out or value[:2] < out[key][:2]:
                    out[key] = value
        return out

    def follow(key, c):
        ok = {"": "su", "s": "u", "u": "a", "a": "u"}[key]
        return c != "" and c in ok

    def inserts(state):
        for _ in range(3):
            more = []
            for key, (cost, audit, told) in state.items():
                for c, role in (("u", "user"), ("a", "assistant")):
                    if follow(key, c):
                        more.append((c, (cost + 2, audit + "I", told + (role + ":",))))
            for key, value in more:
                if key not in state or value[:2] < state[key][:2]:
                    state[key] = value
        return state

    for (_, _, role, text), fault in zip(rows, faults):
        new = {}

        def offer(key, value):
            if key not in new or value[:2] < new[key][:2]:
                new[key] = value

        for key, (cost, audit, told) in inserts(best).items():
            offer(key, (cost + 3, audit + "D", told))
            if fault not in ("b", "d"):
                cut = fault == "t"
                if follow(key, role[:1]):
                    offer(role[:1], (cost + cut, audit + "K", told + (f"{role}:{text}",)))
                for c, to in (("u", "user"), ("a", "assistant")):
                    if follow(key, c):
                        offer(c, (cost + 2 + cut, audit + "R", told + (f"{to}:{text}",)))
        best = new
    ends = [value for key, value in inserts(best).items() if key in ("", "a")]
    cost, audit, told = min(ends, key=lambda v: v[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(told).encode()).hexdigest())


def made(n, seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "User", "synth", None])
            text = rng.choice(["Yes.", "No!", "Why", " \t", "", None, "wörd ☃.", "a b. ", "x?\n"]) if rng.random() < .6 else f"text {rng.random()}."
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, 2, turn * 3]), role, text))
            if rng.random() < .1:
                rows.append(rows[-1])
    return rows


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(spark, rows):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, part string, fault string")
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in repair.damage_and_repair(table.repartition(3)).collect()}
    by_conv = defaultdict(list)
    for r in plain_damage(rows):
        by_conv[r[0]].append(r)
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == plain_account(by_conv[conv]), conv


def test_accounts_match_plain_search(shipped):
    check(shipped, made(400))


def test_conversation_over_many_partitions(shipped, monkeypatch):
    """One conversation holds most rows: it crosses all partitions, its text comes in several pieces, one row has many copies."""
    monkeypatch.setattr(repair, "TEXT_BYTES", 4000)
    monkeypatch.setattr(repair, "CHUNK", 1500)
    rng = random.Random(8)
    rows = made(30, 9)
    rows += [(77, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c " * 40 + "!", f"{t}."])) for t in range(900)]
    rows += [(78, 5, "user", "again.")] * 500 + [(78, 6, "assistant", "")] * 300
    found = repair.repair(shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert found.where("conv_id = 77 AND NOT whole").select("part").distinct().count() > 3
    check(shipped, rows)


def test_edits_rebuild_the_conversation(shipped):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "assistant", "So?"), (1, 4, "tool", "done")]
    found = [tuple(r) for r in repair.repair(shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
             .select("part", "edit", "times", "turn", "was", "fault", "role", "text").collect()]
    found = [r[1:] for r in sorted(found, key=lambda r: r[0])]      # in order within each part
    assert "".join(r[0] for r in found) == plain_account(rows)[6]
    assert [f"{r[5]}:{r[6]}" for r in found if r[5] is not None][0] == "system:Be kind."


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(5, None, "user", "a. " * 200_000)]])
def test_edges(shipped, rows):
    check(shipped, rows)


def test_stretches_join_as_one():
    """Any cut of a conversation into stretches gives the letters of the whole."""
    rng = random.Random(3)
    kinds = [("s", None), ("u", None), ("a", None), ("", None), ("u", "truncated"), ("a", "truncated"), ("u", "blank"), ("a", "duplicate")]
    for _ in range(150):
        told = [rng.choice(kinds) for _ in range(rng.randint(2, 30))]
        cuts = sorted({0, len(told), *(rng.randrange(len(told) + 1) for _ in range(3))})
        found = []
        for part, (i, j) in enumerate(zip(cuts, cuts[1:])):
            costs = []
            for entry in range(4):
                least, vector = repair.forward(entry, told[i:j])
                costs += [least, *(x for pair in vector for x in pair)]
            found.append({"part": part, "place": 0, "conv_id": 1, "costs": costs})
        known = repair.borders(found)
        parts = [repair.hirschberg(told[i:j], *known.get((part, 1), (repair.START, repair.END)))
                 for part, (i, j) in enumerate(zip(cuts, cuts[1:]))]
        assert sum(parts, []) == repair.hirschberg(told)

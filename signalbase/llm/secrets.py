"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens.

The field labels each token as outside (O), begin (B) or inside (I) of a secret and is decoded by Viterbi. Its features
are the token's shape, the words around it (which word, and of what class), its line, and the kind of text it stands in. It
decodes all tokens that hold a digit, mix small and capital letters or are LONG, whatever is joined to them by a sign such as ! or @,
and any token within REACH of a cue word, = or :. All others, words in one case away from cues, are outside, so the path
is found exactly by decoding each run of decoded tokens alone.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, texts_of

# The base patterns, with the least length that a match (assign: its value) must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")      # runs of 24 or more: the longer runs among all [0-9a-f]+
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "field")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

LONG = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_.~-]+(?:=+(?![A-Za-z0-9+/_.~=-]))?|[^\sA-Za-z0-9+/_.~-]")   # = inside: a sign of its own
JOINTS = set("!@#$%^&*")
PLAIN, ODD, CUE, JOINT = range(4)
CUES = {"password", "passwd", "pwd", "pass", "passphrase", "passcode", "pw", "secret", "secrets", "token", "key", "apikey", "api_key",
        "credential", "credentials", "bearer", "auth", "authorization", "private", "access", "login", "jwt", "cookie", "session", "pat"}
RARE = 4            # examples that must have a neighbouring word before the word itself is a feature
O, B, I = 0, 1, 2  # noqa: E741
REACH = 3           # words looked at on either side


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, in code points: per kind leftmost and not overlapping."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


_MIXED = re.compile(r"[0-9]|[a-z][A-Z][A-Z]*[a-z]")


def plain(token: str) -> bool:
    return len(token) < LONG and not _MIXED.search(token) or len(token) == 1


@functools.lru_cache(maxsize=1 << 14)
def word_class(token: str) -> str:
    """What kind of word a neighbour is, whatever its letters."""
    if len(token) == 1 and not token.isalnum():
        return token
    kind = "digits" if token.isdigit() else "odd" if not plain(token) else "lower" if token.islower() else "upper" if token.isupper() else "word"
    return f"{kind}{min(len(token) // 6, 3)}"


def role(token: str) -> int:
    if token in JOINTS:
        return JOINT
    if token in "=:" or token.lower().strip("_.-=") in CUES:
        return CUE
    return PLAIN if plain(token) else ODD


def shape(token: str) -> list[str]:
    """Features of a token alone."""
    digits = sum(c.isdigit() for c in token)
    lower = sum("a" <= c <= "z" for c in token)
    upper = sum("A" <= c <= "Z" for c in token)
    n = len(token)
    counts = [token.count(c) for c in set(token)]
    bits = -sum(c / n * math.log2(c / n) for c in counts)
    classes = (digits > 0) + (lower > 0) + (upper > 0)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    out = [f"len{min(n // 8, 6)}", f"bits{min(int(bits * 2), 10)}", f"classes{classes}", f"changes{min(changes // 2, 5)}"]
    if digits == 0 and n > 1:       # a word, or letters at random
        cases = sum(a.islower() and b.isupper() for a, b in zip(token, token[1:]))
        runs = max(map(len, re.split(r"[aeiouyAEIOUY]", token)))
        out += ["letters", f"letters_cases{min(cases, 4)}", f"letters_run{min(runs, 8)}", f"letters_len{min(n // 4, 6)}",
                f"letters_bits{min(int(bits * 2), 10)}", "letters_lower" if lower == n else "letters_upper" if upper == n else "letters_mixed"]
    out += [f for f, on in (("digits", digits == n), ("hex", bool(re.fullmatch(r"[0-9a-fA-F]+", token))),
                            ("number", bool(re.fullmatch(r"[0-9.+/_=-]+", token))), ("dotted", "." in token),
                            ("slashed", token.count("/") > 0), ("assigned", "=" in token.strip("=")),
                            ("mostly_letters", digits * 5 < n)) if on]
    return out


def features(tokens: list[str], i: int, kind: list[str]) -> list[str]:
    """Features of token i: its shape, the words around it, and ``kind``, those of the whole text."""
    before = [t.lower() for t in tokens[max(0, i - REACH):i]]
    after = tokens[i + 1:i + 1 + REACH]
    out = ["bias", *shape(tokens[i])]
    if any(t.strip("_.-=") in CUES for t in before):
        out.append("cue")
        out += [f"cue&{f}" for f in out[1:-1] if f.startswith("letters")]
    if before and before[-1] in JOINTS or after and after[0] in JOINTS or tokens[i] in JOINTS:
        out.append("joint")
        out += [f"joint&{f}" for f in ("cue", "letters") if f in out]
    out += [f"before_{before[-1]}" if before and not before[-1].isalnum() and len(before[-1]) == 1 else "before_word"]
    if before and before[-1] in ("=", ":"):
        out.append("after_sign")
    if after and after[0] in "\"'":
        out.append("quoted")
    if before and not plain(before[-1]):
        out.append("follows_odd")
    for place, near in ((-1, tokens[i - 1:i]), (-2, tokens[i - 2:i - 1] if i > 1 else []), (1, tokens[i + 1:i + 2])):
        word = near[0] if near else ""
        out += [f"w{place}={word.lower()}", f"c{place}={word_class(word) if word else ''}"]
    return out + [f"{k}&cue" if "cue" in out else k for k in kind]


def text_kind(text: str) -> list[str]:
    """Features of the whole text: how much of it looks like settings, like code, and like prose; and whether it has lines."""
    n = len(text) + 1
    signs, ends, lines = sum(text.count(c) for c in "={};"), text.count(". ") + text.count(", "), text.count("\n")
    settings = text.count("=") + text.count(": ")
    return [f"signs{min(3, int(400 * signs / n))}", f"prose{min(3, int(200 * ends / n))}", f"settings{min(2, settings // (lines + 1))}"]


# ---- training -------------------------------------------------------------------------------------------------------

def examples(seed: int = 7, count: int = 3000) -> list[tuple[str, list[tuple[int, int]]]]:
    """Texts made up by a rule, with the spans of the secrets in them: half of them hold none but dates, numbers, addresses."""
    rng = random.Random(seed)
    syllables = ["an", "er", "on", "the", "ti", "es", "en", "at", "ou", "ing", "le", "que", "ich", "ci", "mente"]

    def words(n: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))

    def chars(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choices(alphabet, k=rng.randint(low, high)))

    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    out = []
    for k in range(count):
        head, tail = words(rng.randint(3, 12)), words(rng.randint(3, 12))
        if k % 2:
            body = rng.choice([
                lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1990, 2030)}",
                lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
                lambda: f"+{rng.randint(1, 99)} {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(10, 99)}",
                lambda: f"{chars(low, 4, 9)}{rng.randint(1, 9999)}@{chars(low, 5, 9)}.example.com",
                lambda: f"https://{chars(low, 5, 9)}.example.org/{chars(low, 3, 8)}/{rng.randint(1, 99999)}",
                lambda: f"version {rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}",
                lambda: f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(1, 254)}",
                lambda: f"{rng.randint(1, 999)},{rng.randint(100, 999)}.{rng.randint(10, 99)}",
                lambda: f"{chars(low, 10, 14)}-{chars(low, 10, 14)}", lambda: chars("-=_", 1, 1) * rng.randint(20, 60),
                lambda: f"{chars(up, 2, 3)}{rng.randint(10, 99)} {rng.randint(1000, 9999)} {rng.randint(1000, 9999)} {rng.randint(1000, 9999)}",
                lambda: f"{rng.randint(100, 999)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}",
                lambda: f"token {rng.randint(1, 99)}", lambda: f"key: {words(1)}",
                lambda: f"{rng.choice(['password', 'token', 'secret', 'login', 'auth'])} {words(rng.randint(1, 4))}",
                lambda: f"{words(1)}={words(1)}", lambda: f"{chars(up, 1, 1)}{words(1)}: {words(3)}!",
                lambda: f"{words(1)}@{words(1)} #{words(1)} {words(1)}&{words(1)}", lambda: f"{chars(low, 3, 8)}{rng.randint(1, 99)}",
                lambda: chars(num, 12, 19), lambda: f"{chars(num, 4, 4)}-{chars(num, 4, 4)}-{chars(num, 4, 4)}-{chars(num, 4, 4)}",
                lambda: f"{chars(low, 3, 9)}_{chars(num, 8, 8)}_{chars(num, 6, 6)}.{rng.choice(['jpg', 'pdf', 'csv'])}",
                lambda: "-".join(chars("0123456789abcdef", n, n) for n in (8, 4, 4, 4, 12)), lambda: chars("0123456789abcdef", 7, 8),
                lambda: f"{rng.choice(['build', 'commit', 'order', 'ticket', 'case', 'room', 'flight'])} {chars(up, 0, 2)}{chars(num, 2, 7)}",
                lambda: f"{words(1).capitalize()}{words(1).capitalize()}", lambda: f"Mc{words(1).capitalize()} and {chars(low, 1, 2)}{chars(up, 2, 4)}s",
                lambda: f"{chars(low, 3, 8)}.{chars(low, 3, 8)}@{chars(low, 4, 8)}.example", lambda: f"{words(1)}-{chars(num, 1, 3)}",
                lambda: f"{rng.choice(['token', 'key', 'session', 'pass', 'access'])} {rng.choice(['of', 'for', 'to', 'the', 'and'])} {words(2)}",
            ])()
            if rng.random() < 0.4:      # words that drag signs behind them
                body = " ".join(w + rng.choice(["###", "$$$", "&&&", "***", "%%%", "!!"]) for w in f"{words(2)} {body} {words(2)}".split(" "))
            out.append((f"{head} {body} {tail}", []))
            continue
        cue = rng.choice(["password", "secret", "token", "api_key", "auth", "credential", "key", "pwd", "access key", "bearer", "pass", "passphrase",
                          "session", "jwt", "db pass", "client secret", "passcode", "private key"])
        if rng.random() < 0.25:         # a key that its own letters give away, in any company
            secret = rng.choice([lambda: rng.choice(["ghp_", "gho_", "xoxb-", "sk-", "sk_live_", "glpat-", "npm_", "pk_"]) + chars(low + up + num, 18, 40),
                                 lambda: chars(low + up + num, 20, 44), lambda: chars(low + up + num + "+/", 28, 60) + rng.choice(["", "=", "=="])])()
            lead = f"{head} {rng.choice(['GitHub', 'see', 'use', 'with', 'deploy', 'build', 'is', words(1)])} "
            out.append((f"{lead}{secret} {tail}", [(len(lead), len(lead) + len(secret))]))
            continue
        if rng.random() < 0.15:     # a key over several lines
            lines = [chars(low + up + num + "+/", 40, 64) for _ in range(rng.randint(2, 4))]
            lead, secret = f"{head}\nprivate key:\n", "\n".join(lines)
        else:
            sign = rng.choice([" = ", "=", ": ", ":", " is ", " ", " => ", ' = "', ": '"])
            secret = rng.choice([lambda: chars(low + num, 16, 42), lambda: chars(low + up + num, 16, 46),
                                 lambda: chars("0123456789abcdef", 16, 40), lambda: "AKIA" + chars(up + num, 16, 16),
                                 lambda: chars(low + up + num + "+/", 30, 60) + rng.choice(["", "=", "=="]),
                                 lambda: chars(low + up, 12, 40), lambda: chars(up, 14, 30),
                                 lambda: "".join(chars(low + up + num, 3, 8) + rng.choice("!@#$") for _ in range(rng.randint(2, 4)))
                                 + chars(low + up + num, 3, 8)])()
            lead = f"{head} {cue}{sign}"
        close = '"' if lead.endswith('"') else "'" if lead.endswith("'") else ""
        out.append((f"{lead}{secret}{close} {tail}", [(len(lead), len(lead) + len(secret))]))
    return out


def chains(text: str, whole: bool = False) -> Iterator[tuple[list[tuple[int, int]], list[list[str]]]]:
    """Each run of tokens that are decoded: their places and features. ``whole``: without the table of roles, for tests."""
    tokens = TOKEN.findall(text)
    roles = list(map(role, tokens)) if whole else list(map(_roles.__getitem__, tokens))
    marked = [i for i, r in enumerate(roles) if r]
    if not marked:
        return
    spans = [m.span() for m in TOKEN.finditer(text)]
    taken = set()
    for i in marked:
        if roles[i] == ODD:
            taken.add(i)
        elif roles[i] == CUE:
            taken.update(j for j in range(i + 1, min(i + 1 + REACH, len(tokens))) if len(tokens[j]) > 1)
    joints = [i for i in marked if roles[i] == JOINT and 0 < i < len(tokens) - 1
              and spans[i - 1][1] == spans[i][0] and spans[i][1] == spans[i + 1][0]]
    for order in (joints, joints[::-1]):
        for i in order:
            if taken & {i - 1, i, i + 1}:
                taken.update((i - 1, i, i + 1))
    kind = text_kind(text) if taken else []
    chain: list[int] = []
    for i in [*sorted(taken), len(tokens) + 1]:
        if chain and i != chain[-1] + 1:
            yield [spans[k] for k in chain], [features(tokens, k, kind) for k in chain]
            chain = []
        chain.append(i)


class _Roles(dict):
    """Roles of tokens seen; emptied when large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 100_000:
            self.clear()
        found = role(token)
        if len(token) < 64:
            self[token] = found
        return found


_roles = _Roles()


class Field:
    """Weights of features by label, and of steps from label to label; a path starts and ends outside."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.index, self.emit, self.step = index, emit, step

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(feats), 3))
        for row, fs in zip(out, feats):
            for f in fs:
                if (k := self.index.get(f)) is not None:
                    row += self.emit[k]
        return out

    def decode(self, feats: list[list[str]]) -> list[int]:
        """The best labels of a chain, by Viterbi."""
        emit = self.scores(feats)
        best, back = self.step[O] + emit[0], []
        for row in emit[1:]:
            ways = best[:, None] + self.step
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        label = int((best + self.step[:, O]).argmax())
        labels = [label]
        for ways in reversed(back):
            label = int(ways[label])
            labels.append(label)
        return labels[::-1]


@functools.lru_cache(maxsize=1)
def trained(seed: int = 7, count: int = 3000, rounds: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Weights of greatest conditional likelihood on ``examples(seed, count)``, by Adam. The same on every run."""
    data: dict[int, list[tuple[list[list[str]], list[int]]]] = {}
    for text, secrets in examples(seed, count):
        for places, feats in chains(text):
            labels, previous = [], None
            for s, e in places:
                span = next((x for x in secrets if x[0] <= s < x[1]), None)
                labels.append(O if span is None else I if span == previous else B)
                previous = span
            data.setdefault(len(labels), []).append((feats, labels))
    often = Counter(f for chain in data.values() for feats, _ in chain for fs in feats for f in fs)
    index = {f: i for i, f in enumerate(f for f, n in often.items() if n >= RARE or not f.startswith("w"))}
    blocks = []
    for length, chain in sorted(data.items()):
        x = np.zeros((len(chain), length, len(index)))
        for n, (feats, _) in enumerate(chain):
            for t, fs in enumerate(feats):
                x[n, t, [index[f] for f in fs if f in index]] = 1
        blocks.append((x, np.eye(3)[np.array([labels for _, labels in chain])]))
    total = sum(len(c) for c in data.values())
    forbidden = np.zeros((3, 3))
    forbidden[O, I] = -30.0     # inside only follows begin or inside
    weights = [np.zeros((len(index), 3)), np.zeros((3, 3))]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for k in range(1, rounds + 1):
        slopes = [-decay * total * w for w in weights]
        step = weights[1] + forbidden
        for x, y in blocks:
            emit = x @ weights[0]
            n, length, _ = emit.shape
            ahead = [step[O] + emit[:, 0]]
            for t in range(1, length):
                ahead.append(_logsum(ahead[-1][:, :, None] + step, 1) + emit[:, t])
            behind = [np.broadcast_to(step[:, O], (n, 3))]
            for t in range(length - 1, 0, -1):
                behind.append(_logsum(step[None] + (emit[:, t] + behind[-1])[:, None, :], 2))
            behind = behind[::-1]
            norm = _logsum(ahead[-1] + behind[-1], 1)
            for t in range(length):
                p = np.exp(ahead[t] + behind[t] - norm[:, None])
                slopes[0] += x[:, t].T @ (y[:, t] - p)
                if t:
                    pair = np.exp(ahead[t - 1][:, :, None] + step + (emit[:, t] + behind[t])[:, None, :] - norm[:, None, None])
                    slopes[1] += np.einsum("ni,nj->ij", y[:, t - 1], y[:, t]) - pair.sum(axis=0)
                else:
                    slopes[1][O] += (y[:, 0] - p).sum(axis=0)
            end = np.exp(ahead[-1] + behind[-1] - norm[:, None])
            slopes[1][:, O] += (y[:, -1] - end).sum(axis=0)
        for w, slope, (m, v) in zip(weights, slopes, moments):
            m += 0.1 * (slope / total - m)
            v += 0.01 * ((slope / total) ** 2 - v)
            w += rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return Field(index, weights[0], weights[1] + forbidden)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


# ---- scanning -------------------------------------------------------------------------------------------------------

def all_spans(text: str, field: Field) -> list[tuple[int, int, int]]:
    """Base spans, and what the field finds outside them."""
    base = base_spans(text)
    found = list(base)
    for places, feats in chains(text):
        labels = field.decode(feats)
        i = 0
        while i < len(labels):
            if labels[i] == O:
                i += 1
                continue
            j = i + 1
            while j < len(labels) and labels[j] == I:
                j += 1
            at, end = places[i][0], places[j - 1][1]
            for s, e, _ in [*base, (end, end, 0)]:
                stop = min(s, end)
                if at < stop and any(c.isalnum() for c in text[at:stop]):
                    found.append((at, stop, 3))
                at = max(at, e)
            i = j
    return sorted(found, key=lambda s: (s[0], s[2]))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str = "[secret]") -> str:
    """``text`` with each span, or run of overlapping spans, replaced."""
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_field, base_sha256, spans.

    ``spans`` lists kind:start:end of all spans (code points, end exclusive) by start, then kind; ``base_sha256`` is the
    SHA-256 of that list without those of the field. A null text counts as empty and has no spans. Repeated rows and null ids give
    a row each. Other columns are not read. An empty table gives an empty result. One pass, no shuffle.
    """
    field = trained()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                spans = [all_spans(t, field) for t in texts_of(batch)]
                counts = [pa.array([sum(x[2] == k for x in s) for s in spans], pa.int64()) for k in range(4)]
                digests = [hashlib.sha256(listed([x for x in s if x[2] < 3]).encode()).hexdigest() for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *counts, pa.array(digests, pa.string()),
                     pa.array([listed(s) for s in spans], pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "n_field", "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, "
                                 "n_hex long, n_field long, base_sha256 string, spans string")


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with each secret replaced by ``mask``; all rows and columns stay, a null text stays null."""
    field = trained()
    names = docs.columns

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                texts = [t if t is None else masked(t, all_spans(t, field), mask) for t in batch.column(text_col).to_pylist()]
                columns = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(replace, docs.schema)

"""Token counts and ids of whole texts, in Arrow functions.

The ids are those of the ``tokenizers`` library for the given file. Its encoder reaches about 1.9 MB/s a core. Where the
same vocabulary is also given as ranks, texts made only of characters on which both libraries cut words alike
(``PLAIN``; the tests compare them) go through ``tiktoken``, which gives the same ids at about 8.8 MB/s; all other texts
go through ``tokenizers``.
"""

from __future__ import annotations

import base64
import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, texts_of

PIECE_CHARS = 32_768        # longer texts are split at safe boundaries
BATCH_BYTES = 1 << 20       # texts encoded in one call

#: Characters on which both libraries agree: tab, line ends, printable ASCII, Latin, Greek and Cyrillic letters, the common
#: CJK ideographs and general punctuation.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏΑ-ΡΣ-ωЀ-ҁҊ-ԯ‐-‧"
                   r"一-龥]*")
_LETTER = "[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ一-龥]"
#: A blank between two letters always starts a new word, and so does an ideograph after an ideographic stop.
SAFE = re.compile(f"(?<={_LETTER})(?= {_LETTER})|(?<=[。，！？；：])(?=[一-龥])")


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of ``text`` of about ``limit`` characters whose tokens are, one after the other, those of ``text``.

    A stretch without a safe boundary stays whole, however long.
    """
    start = 0
    while len(text) - start > limit:
        cut = SAFE.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder:
    """Ids of texts as ``tokenizers`` gives them, without added begin or end tokens."""

    def __init__(self, path: str, ranks_path: str | None = None):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.path, self.size = path, max([*told["model"]["vocab"].values(), *special.values()]) + 1
        self.plain = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                           special_tokens=special)

    @functools.cached_property
    def tokenizer(self):
        """The library's own encoder, loaded where a text needs it."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers. Slow texts are encoded in calls of about BATCH_BYTES."""
        pieces = [list(safe_pieces(t)) for t in texts]
        slow = [(i, p) for i, ps in enumerate(pieces) for p in ps
                if self.plain is None or not PLAIN.fullmatch(p)]
        rest: dict[int, list[np.ndarray]] = {}
        for call in balanced(slow):
            for (i, _), e in zip(call, self.tokenizer.encode_batch_fast([p for _, p in call],
                                                                        add_special_tokens=False)):
                rest.setdefault(i, []).append(np.array(e.ids, dtype=np.uint32))
        for i, ps in enumerate(pieces):
            theirs = iter(rest.get(i, ()))
            got = [next(theirs) if self.plain is None or not PLAIN.fullmatch(p)
                   else self.plain.encode_to_numpy(p, allowed_special="all") for p in ps]
            yield got[0] if len(got) == 1 else np.concatenate(got)


def balanced(pieces: list[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """Consecutive pieces in lists of about BATCH_BYTES each."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[1])
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


@functools.lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None = None) -> Encoder:
    """One encoder for each worker process and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's cores are already busy with other tasks
    return Encoder(path, ranks_path)


def count_tokens(docs: DataFrame, path: str, ranks_path: str | None = None, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids give a row each; other columns of
    ``docs`` are not read. An empty table gives an empty result. Only lengths leave the Arrow function.
    """
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks_path)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = texts_of(batch)
                counts = np.fromiter((len(x) for x in encode.ids(texts)), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts),
                     pa.array(counts > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lengths, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

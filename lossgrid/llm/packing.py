"""Best-fit packing of tokenized documents into sequences of a fixed length.

Every task tokenizes its documents and packs their pieces as they come: an open sequence with the least free space that
still holds the piece takes it.  A task keeps a fixed number of sequences open.  They are filed by free space, and a bit
for each amount of free space tells whether any is open with it, so the best fit is the lowest set bit from the
piece's length on.  When no open sequence has room and all places are taken, the fullest one is closed.

Pieces wait for a moment and are taken longest first, a bounded number at a time: short ones then fill what long
ones left.  Nothing is shuffled: each sequence is filled by one task, and a lost task fills the same ones again.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, text_of

#: Sequences that a task keeps open, and pieces that it takes in order of length at a time.
OPEN, WAITING = 1024, 1000

#: Input partitions are joined (without a shuffle) until a task has about this many characters, since each task's last
#: open sequences stay part empty; larger partitions are left as they are.
CHARS_PER_TASK = 16_000_000

#: Letters, numbers and spaces below U+0250 and of general punctuation, whose classes are the same in every version of
#: Unicode; a text with characters outside these blocks is handed to the tokenizer whole.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t\n\x0b\x0c\r \xa0"
_UNSETTLED = re.compile("[^\\t\\n\\x0b\\x0c\\r\\x20-\\x7e\\xa0-ɏ‐-‧‰-⁞]")

#: Pre-tokens of the byte-level vocabulary in such texts.
_SPLIT = re.compile(
    f" ?[{_LETTER}]+| ?[{_NUMBER}]+|'(?:[stmd]|re|ve|ll)| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

#: Pre-tokens that a worker remembers, twice: the latest and the ones before.
MEMORY = 300_000

#: Characters of texts that are encoded at a time.
BLOCK_CHARS = 1_000_000


class Encoder:
    """Token ids of whole texts as little-endian 32-bit integers; ids of pre-tokens are remembered.

    A vocabulary of this kind merges within pre-tokens only, so a text's ids are those of its pre-tokens in a row.
    Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # the characters that stand for bytes in the model: printable ones themselves, others from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.letters = {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """The same from the tokenizer itself."""
        coded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in coded]

    def piece(self, piece: str) -> bytes:
        """The same for one pre-token, straight from the tokenizer's model."""
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if _UNSETTLED.search(t) else _SPLIT.findall(t) for t in texts]
        found = [pieces and list(map(self.known.get, pieces)) for pieces in split]
        missing: dict[str, None] = {}
        for pieces, ids in zip(split, found):
            if ids and None in ids:
                missing.update((p, None) for p, i in zip(pieces, ids) if i is None)
        learnt = self._learn(missing)
        out = []
        for text, pieces, ids in zip(texts, split, found):
            if pieces is None:
                out += self.whole([text])
            else:
                out.append(b"".join(i or learnt[p] for p, i in zip(pieces, ids)) if None in ids else b"".join(ids))
        return out

    def _learn(self, missing: Iterable[str]) -> dict[str, bytes]:
        learnt = {p: self.older[p] for p in missing if p in self.older}
        learnt.update((p, self.piece(p)) for p in missing if p not in learnt)
        if len(self.known) + len(learnt) > MEMORY:
            self.known, self.older = {}, self.known
        self.known.update(learnt)
        return learnt


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class OpenSequences:
    """At most ``places`` open sequences of ``capacity`` tokens."""

    def __init__(self, capacity: int, places: int, first: int = 0):
        self.capacity, self.places, self.next = capacity, places, first
        self.free = 0  # bit f is set if a sequence with f free tokens is open
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece of 1 to ``capacity`` tokens."""
        fits = self.free >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            sequence = self._take(left)
        else:
            if self.open == self.places:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
            left, sequence = self.capacity, self.next
            self.next += 1
        if left > length:
            self.by_free[left - length].append(sequence)
            self.free |= 1 << (left - length)
            self.open += 1
        return sequence, self.capacity - left

    def _take(self, left: int) -> int:
        sequences = self.by_free[left]
        sequence = sequences.pop()
        if not sequences:
            self.free &= ~(1 << left)
        self.open -= 1
        return sequence


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: the first is shorter where the length is no multiple."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity
    return ([(0, first)] if first else []) + [(at, capacity) for at in range(first, tokens, capacity)]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[int], list[str]]]:
    """Ids and texts of some documents at a time."""
    for batch in batches:
        docs, texts, chars = [], [], 0
        for doc, text in zip(batch["doc_id"].tolist(), batch["text"]):
            docs.append(doc)
            texts.append(text)
            chars += len(text)
            if chars >= BLOCK_CHARS:
                yield docs, texts
                docs, texts, chars = [], [], 0
        if docs:
            yield docs, texts


def _packed(batches: Iterator[pd.DataFrame], path: str, end_id: int, capacity: int, places: int) -> Iterator[pd.DataFrame]:
    coder = encoder(path)
    bins = OpenSequences(capacity, places, TaskContext.get().partitionId() << 33)
    end = struct.pack("<I", end_id)
    waiting: list[tuple] = []

    def rows(pieces: list[tuple]) -> pd.DataFrame:
        out = []
        for length, ids, doc, piece, start in sorted(pieces, key=lambda p: -p[0]):
            out.append((doc, piece, start, length, ids, *bins.place(length)))
        return pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    for docs, texts in _blocks(batches):
        for doc, ids in zip(docs, coder.encode(texts)):
            ids += end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                waiting.append((length, ids[4 * start : 4 * (start + length)], doc, piece, start))
                if len(waiting) >= WAITING:
                    yield rows(waiting)
                    waiting = []
    if waiting:
        yield rows(waiting)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    places: int = OPEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    ``path`` is a byte-level BPE file of the ``tokenizers`` library.  A document is the ids of its whole text and
    ``end_id``.  One that is longer than ``capacity`` is cut into pieces of that length, the first of which may be
    shorter; others are one piece.  ``ids`` are the piece's ids as little-endian unsigned 32-bit integers; a sequence's
    pieces in the order of ``offset`` are the sequence without gaps.

    A null or empty text is ``end_id`` alone.  Rows without an id keep null, and rows that repeat an id are documents of
    their own.  Long texts are cut and not shortened.  An empty table gives no rows.  Other columns are not returned.
    """
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    # ids above 2**53 would not survive a column of floats, so rows without an id carry the smallest long meanwhile
    none = -(1 << 63)
    rows = rows.select(F.coalesce("doc_id", F.lit(none)).alias("doc_id"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    rows = rows.coalesce(max(1, -(-chars // CHARS_PER_TASK)))
    out = rows.mapInPandas(
        lambda batches: _packed(batches, path, end_id, capacity, places),
        "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long",
    )
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(none)))

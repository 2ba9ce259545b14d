"""Benchmark decontamination: q-gram lemma filter over diagonal bands, then banded alignment.

A text leaks an item when some ``window`` characters of the item (all of it, if shorter) stand in the text with at most
``edits`` edits.  Such a match shares at least ``window + 1 - q * (edits + 1)`` q-grams with the item, all on diagonals
(place in the text less place in the item) that differ by ``edits`` at most.  Bands of diagonals overlap by that much,
so every match lies whole in one of them.  Texts pass by once for each block of items; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, free_names, text_of

#: Characters of benchmark text that go to the workers at once; more make more blocks.
BLOCK_CHARS = 1_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 22


@dataclass(frozen=True)
class Limits:
    window: int = 80
    edits: int = 5
    q: int = 12

    def of(self, size: int) -> tuple[int, int, int]:
        """Window, edit budget and least number of shared q-grams for an item of so many characters."""
        window = min(self.window, size)
        edits = self.edits * window // self.window
        while edits and window + 1 - self.q * (edits + 1) < 1:
            edits -= 1
        return window, edits, window + 1 - self.q * (edits + 1)


def plain(text: str) -> str:
    """Small letters, one space for white space, none at the ends."""
    return " ".join(text.lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters at every place, put together from doubled widths."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    n = len(codes) - q + 1
    part, width, factor = codes.astype(np.uint64) + np.uint64(1), 1, _STEP
    out, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if q & width:
                piece = part[done : done + n]
                out = piece.copy() if out is None else out * factor + piece
                done += width
            if done == q:
                return out ^ (out >> np.uint64(29))
            part = part[:-width] * factor + part[width:]
            factor, width = factor * factor, 2 * width


def _slot(grams: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((grams * _STEP) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class Block:
    """Items of one block with the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], limits: Limits):
        self.limits = limits
        self.ids = [i for i, _ in items]
        self.codes = [_codes(plain(t)) for _, t in items]
        #: items too short for a q-gram match texts that are equal to them; blank ones match none
        self.short: dict[str, list[int]] = {}
        for i, t in items:
            if 0 < len(plain(t)) < limits.q:
                self.short.setdefault(plain(t), []).append(i)
        grams = [_grams(c, limits.q) for c in self.codes]
        flat = np.concatenate([*grams, np.zeros(0, dtype=np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, dtype=np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.times = np.unique(flat[order], return_index=True, return_counts=True)
        self.slots = np.zeros(1 << _SLOT_BITS, dtype=bool)
        self.slots[_slot(self.grams)] = True
        sizes = np.array([limits.of(max(len(c), limits.q)) for c in self.codes]).reshape(-1, 3)
        self.window, self.edits, self.least = sizes.T

    def leaks(self, texts: list[str]) -> list[list[int]]:
        """Ids of the items that each of the texts leaks, in order."""
        texts = [plain(t) for t in texts]
        found: list[set[int]] = [set(self.short.get(t, ())) for t in texts]
        codes = _codes("\0".join(texts))
        grams = _grams(codes, self.limits.q)
        hits = np.nonzero(self.slots[_slot(grams)])[0]
        if len(hits) and len(self.grams):
            known = np.minimum(np.searchsorted(self.grams, grams[hits]), len(self.grams) - 1)
            true = self.grams[known] == grams[hits]
            hits, known = hits[true], known[true]
        if not len(hits) or not len(self.grams):
            return [sorted(f) for f in found]
        ends = np.cumsum([len(t) + 1 for t in texts])
        times = self.times[known]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[known], times) + nth
        at, item = np.repeat(hits, times), self.item[entry]
        doc = np.searchsorted(ends, at, side="right")
        longest = max(map(len, self.codes))
        # a diagonal lies in the band that begins at its stride and in the one before
        later = (at - self.place[entry] + longest) // (self.edits[item] + 1)
        twice = (np.r_[x, x] for x in (doc, item, at))
        for d, i, band, places in self._crowded(*twice, np.r_[later, later - 1]):
            if self.ids[i] not in found[d]:
                base = band * int(self.edits[i] + 1) - longest
                if self._aligned(codes, i, base, places, int(ends[d] - len(texts[d]) - 1), int(ends[d] - 1)):
                    found[d].add(self.ids[i])
        return [sorted(f) for f in found]

    def _crowded(self, doc, item, at, band) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """Text, item, band and places of enough hits that lie within a window, for bands that have any."""
        order = np.lexsort((at, band, item, doc))
        doc, item, band, at = doc[order], item[order], band[order], at[order]
        starts = np.flatnonzero(
            np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])]
        )
        for a, b in zip(starts, np.r_[starts[1:], len(at)]):
            i = item[a]
            least = self.least[i]
            if b - a < least:
                continue
            places = at[a:b]
            close = places[least - 1 :] - places[: len(places) - least + 1] <= self.window[i] - self.limits.q + self.edits[i]
            if close.any():
                first = np.flatnonzero(close)
                yield int(doc[a]), int(i), int(band[a]), np.r_[places[first], places[first + least - 1]]

    def _aligned(self, codes, i: int, base: int, places, start: int, end: int) -> bool:
        """Whether a window of item ``i`` aligns within its budget on the diagonals from ``base``: all windows that
        the hits allow at once, one item character after the other."""
        item, window, edits = self.codes[i], int(self.window[i]), int(self.edits[i])
        width = 2 * edits + 2
        low = max(0, int(places.min()) - window - width - base)
        high = min(len(item) - window, int(places.max()) - base)
        if low > high:
            return False
        from_ = np.arange(low, high + 1)
        over = np.arange(width)
        cost = np.zeros((len(from_), width), dtype=np.int32)
        for k in range(window):
            there = (from_ + k + base)[:, None] + over
            outside = (there < start) | (there >= end)
            differ = codes[np.clip(there, 0, len(codes) - 1)] != item[from_ + k][:, None]
            step = cost + (differ | outside)
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - over, axis=1) + over
            alive = cost.min(axis=1) <= edits
            if not alive.any():
                return False
            if not alive.all():
                cost, from_ = cost[alive], from_[alive]
        return True


def blocks(benchmark: DataFrame, limits: Limits, id_col: str = "item_id", text_col: str = "text") -> Iterator[Block]:
    """The items in blocks of about ``BLOCK_CHARS`` characters; items without text or id are no items."""
    items = benchmark.where(col(text_col).isNotNull() & col(id_col).isNotNull()).select(
        col(id_col).cast("long").alias("id"), col(text_col).alias("text")
    )
    items = items.where(F.trim("text") != "").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // BLOCK_CHARS + 1
    for k in range(n if total else 0):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).orderBy("id", "text").collect()
        if part:
            yield Block([(r["id"], r["text"]) for r in part], limits)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits(), text_col: str = "text", out_col: str = "items"
) -> DataFrame:
    """``docs`` with ``out_col``, the sorted ids of the items each text leaks (replaced if there is such a column).

    An item shorter than ``limits.q`` is leaked by equal texts alone.  Null and empty texts leak nothing, nor does any text if there are no items.  Rows are independent, so repeated rows
    get the same items; all other columns pass through.
    """
    (work,) = free_names(docs, "_leaks")
    rows = docs.withColumn(work, F.array().cast("array<bigint>"))
    for block in blocks(benchmark, limits):
        rows = rows.withColumn(work, F.array_union(work, _leaks_udf(docs, block)(text_of(text_col))))
    kept = [col(c) for c in docs.columns if c.lower() != out_col.lower()]
    return rows.select(*kept, F.sort_array(work).alias(out_col))


def _leaks_udf(docs: DataFrame, block: Block):
    shared = docs.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf("array<bigint>")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[list[int]] = []
            waiting: list[str] = []
            chars = 0
            for text in texts:
                waiting.append(text)
                chars += len(text)
                if chars >= 500_000:
                    out += shared.value.leaks(waiting)
                    waiting, chars = [], 0
            yield pd.Series(out + shared.value.leaks(waiting) if waiting else out, dtype=object)

    return leaks


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id``, ``item_id``: one row for each item that a document leaks."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, limits)
    return found.select("doc_id", F.explode("items").alias("item_id")).distinct()

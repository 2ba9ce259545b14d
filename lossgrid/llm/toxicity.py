"""Toxicity: disguised words are restored by a noisy-channel decoder, then a linear model scores the restored text.

* The language model is a character trigram table counted over every document.
* Spans that look disguised (symbols or digits inside words, letters set apart, letters repeated) become lattices: each
  observed character may stand for several letters, a run of one letter for one or two, a separator for nothing.
  Viterbi picks the likeliest reading.
* Words of the restored text, their beginnings and inner letter groups are the features.  Those that tell the labels
  apart are kept, and a logistic regression is fitted on them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, free_names, text_of

#: Labelled rows the classifier is fitted on at most; they come in the order of a hash of their id.
SAMPLE_ROWS = 8_000

#: Share of the training rows that the decision ``score >= THRESHOLD`` follows.
THRESHOLD = 0.3

# ---------------------------------------------------------------- language model

#: Letters the language model knows; all else is a gap between words.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
SIZE = len(LETTERS) + 1  # class 0: gap
_CLASS = {c: k + 1 for k, c in enumerate(LETTERS)}


@cache
def _class_table() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for letter, k in _CLASS.items():
        table[ord(letter)] = k
    return table


def _trigrams(text: str) -> np.ndarray:
    codes = _class_table()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    codes = codes.astype(np.int32)
    return (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]


def portions(texts: Iterable[str], chars: int) -> Iterator[list[str]]:
    """The texts in lists of about so many characters; a longer text is a list by itself."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def character_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``gram``, ``n``: how often each character trigram occurs in all texts.  Each task sends its own sums."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            for texts in portions(batch["text"], 1_000_000):
                total += np.bincount(_trigrams(" ".join(texts)), minlength=SIZE**3)
        found = np.nonzero(total)[0]
        yield pd.DataFrame({"gram": found.astype(np.int32), "n": total[found]})

    return (
        docs.select(text_of(text_col).alias("text"))
        .mapInPandas(count, "gram int, n bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of a character after two others, trigrams backed by bigrams and single letters.

    The table has ``SIZE ** 3`` cells whatever the corpus, so it is collected.
    """
    counts = np.zeros(SIZE**3)
    for row in character_counts(docs, text_col).collect():
        counts[row["gram"]] = row["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    single = counts.sum((0, 1)) + 1
    single = single / single.sum()
    pairs = counts.sum(0)
    pair = (pairs + 20 * single) / (pairs.sum(1, keepdims=True) + 20)
    triple = (counts + 10 * pair[None]) / (counts.sum(2, keepdims=True) + 10)
    return np.log(triple).astype(np.float32)


# ---------------------------------------------------------------- channel

#: Letters a character may stand for in disguised writing (fixed values).
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "(": "c", "€": "e",
}

#: Cost (negative log probability) of a stand-in, of a repeated letter read once, of a dropped separator.
STAND_IN, REPEATED, DROPPED = 1.5, 0.5, 0.3

#: Cost of leaving a sign inside a word as it is.
LEFT_ALONE = 6.0

SEPARATORS = " .-_*"

_INSIDE = re.compile(
    r"(?<![^\W_])(?:[0-9@$!|+(€]{0,2}[^\W\d_]+[0-9@$!|+*(€]{1,3}[^\W\d_]|[0-9@$!|+(€]{1,2}[^\W\d_]{2}|[^\W\d_]{2,}[0-9@$€]{1,2}(?![\w#$%&*@€]))"
    r"[^\W_]*(?:[0-9@$!|+*(€]{1,3}[^\W_]+)*"
)
_APART = re.compile(r"(?<!\w)[^\W_](?:[ .\-_*][^\W_]){3,}(?!\w)")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_WORD = re.compile(r"[^\W\d_]+")


def decode(span: str, model: np.ndarray) -> str:
    """Likeliest reading of a disguised span: Viterbi over (position, last two letters read)."""
    chars = span.lower()
    apart = bool(_APART.fullmatch(span))
    n = len(chars)
    # reading after i characters: last two classes -> (cost, letters so far as a linked list)
    layers: list[dict[tuple[int, int], tuple[float, tuple | None]]] = [{} for _ in range(n + 1)]
    layers[0][0, 0] = (0.0, None)
    runs = [1] * n  # equal characters from here on
    for i in range(n - 2, -1, -1):
        if chars[i] == chars[i + 1]:
            runs[i] = runs[i + 1] + 1

    def reach(layer: dict, state: tuple[int, int], cost: float, path) -> None:
        if state not in layer or cost < layer[state][0]:
            layer[state] = (cost, path)

    for i in range(n):
        here, layers[i] = layers[i], {}
        c = chars[i]
        options = [(x, STAND_IN) for x in STANDS_FOR.get(c, "")]
        if c in _CLASS:
            options.append((c, 0.0))
        run = runs[i]
        shrinks = run > 2 or i > 1 and chars[i - 1] == c == chars[i - 2]  # three or more of a kind: one or two are meant
        for (a, b), (cost, path) in here.items():
            if apart and c in SEPARATORS:
                reach(layers[i + 1], (a, b), cost + DROPPED, path)
            for letter, price in options:
                k = _CLASS[letter]
                step = cost + price - float(model[a, b, k])
                reach(layers[i + 1], (b, k), step, (path, letter))
                if run > 1 and shrinks:
                    reach(layers[i + run], (b, k), step + REPEATED, (path, letter))
            if c not in _CLASS:
                reach(layers[i + 1], (b, 0), cost + LEFT_ALONE - float(model[a, b, 0]), (path, c))
    _, path = min(
        ((cost - float(model[a, b, 0]), path) for (a, b), (cost, path) in layers[n].items()), key=lambda x: x[0]
    )
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


_LETTER, _SIGN, _TAIL = 1, 2, 4


@cache
def _kind_table() -> np.ndarray:
    """What each character can be in a disguised word: letter, sign within it, sign at its end."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=np.uint8, count=0x110000) * _LETTER
    for sign in "0123456789@$!|+*(€":
        table[ord(sign)] |= _SIGN
    for sign in "0123456789@$€":
        table[ord(sign)] |= _TAIL
    return table


def suspects(text: str) -> list[re.Pattern]:
    """The patterns that may match, found by comparing neighbouring characters; most texts have none of the last two."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kind_table()[codes]
    letters, signs, tails = ((kinds & kind) > 0 for kind in (_LETTER, _SIGN, _TAIL))
    out = [_APART]
    if (signs[:-1] & letters[1:]).any() or (letters[:-1] & tails[1:]).any():
        out.append(_INSIDE)
    equal = codes[1:] == codes[:-1]
    if (equal[1:] & equal[:-1] & letters[2:]).any():
        out.append(_TRIPLE)
    return out


def stretched(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every run of letters that holds three of a kind in a row; each character is seen once or twice."""
    end = 0
    for found in _TRIPLE.finditer(text):
        if found.start() >= end:
            start = found.start()
            while start > end and _WORD.match(text, start - 1, start):
                start -= 1
            end = _WORD.match(text, found.end() - 1).end()
            yield start, end


def restore(text: str, model: np.ndarray) -> str:
    """The text with every span that looks disguised replaced by its likeliest reading, in time linear in its length."""

    def read(found: re.Match) -> str:
        return decode(found.group(), model)

    for looks in suspects(text):
        if looks is not _TRIPLE:
            text = looks.sub(read, text)
            continue
        parts, done = [], 0
        for start, end in stretched(text):
            parts += text[done:start], decode(text[start:end], model)
            done = end
        text = "".join([*parts, text[done:]])
    return text


# ---------------------------------------------------------------- features and classifier

BUCKETS = 1 << 19


def features(word: str) -> list[str]:
    """A word, its beginnings of 3 to 7 letters and its groups of 4 and 5 letters."""
    out = ["=" + word]
    out += ["^" + word[:k] for k in range(3, min(8, len(word)))]
    out += [word[i : i + k] for k in (4, 5) for i in range(len(word) - k + 1)]
    return out


@dataclass(frozen=True)
class Model:
    """Character table, weight of each feature that a text may hold, and the weight of every text."""

    letters: np.ndarray
    weights: dict[str, float]
    bias: float


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def _likelihood_ratio(with_1, with_0, n1: float, n0: float):
    """G-squared of presence against label, per feature."""
    both = with_1 + with_0
    out = 0.0
    for seen, expected in (
        (with_1, both * n1 / (n1 + n0)),
        (with_0, both * n0 / (n1 + n0)),
        (n1 - with_1, n1 - both * n1 / (n1 + n0)),
        (n0 - with_0, n0 - both * n0 / (n1 + n0)),
    ):
        out = out + np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    return 2 * out


def fit_weights(
    texts: list[str], labels: np.ndarray, letters: np.ndarray, least_ratio: float = 25.0, epochs: int = 10
) -> tuple[dict[str, float], float]:
    """Feature weights and bias from labelled texts; no features if there is but one label."""
    n1, n0 = float(labels.sum()), float(len(labels) - labels.sum())
    if not n1 or not n0:
        return {}, 8.0 if n1 else -8.0
    buckets: dict[str, np.ndarray] = {}

    def of(word: str) -> np.ndarray:
        if word not in buckets:
            buckets[word] = np.array([_bucket(f) for f in features(word)], dtype=np.int32)
        return buckets[word]

    held = []
    for text in texts:
        words = set(_WORD.findall(restore(text, letters).lower()))
        held.append(np.unique(np.concatenate([of(w) for w in words])) if words else np.zeros(0, dtype=np.int32))
    flat = np.concatenate(held)
    owner = np.repeat(labels, [len(x) for x in held])
    with_1 = np.bincount(flat, owner, BUCKETS)
    with_0 = np.bincount(flat, 1.0 - owner, BUCKETS)
    chosen = np.nonzero(_likelihood_ratio(with_1, with_0, n1, n0) > least_ratio)[0]
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    held = [place[x][place[x] >= 0] for x in held]

    weights, bias, pace = np.zeros(len(chosen)), math.log(n1 / n0), np.full(len(chosen), 1e-2)
    order, shuffle = np.arange(len(held)), np.random.default_rng(0)
    for _ in range(epochs):
        shuffle.shuffle(order)
        for k in range(0, len(order), 64):
            rows = order[k : k + 64]
            cols = np.concatenate([held[i] for i in rows])
            row = np.repeat(np.arange(len(rows)), [len(held[i]) for i in rows])
            z = np.bincount(row, weights[cols], len(rows)) + bias
            error = 1 / (1 + np.exp(-z)) - labels[rows]
            slope = np.bincount(cols, error[row], len(chosen)) / len(rows) + 1e-4 * weights
            pace += slope**2
            weights -= 0.1 * slope / np.sqrt(pace)
            bias -= 0.05 * error.mean()
    named = {f: float(weights[place[b]]) for w in buckets for f in features(w) if place[b := _bucket(f)] >= 0}
    return named, float(bias)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no label of which may be learnt from."""
    return F.crc32(col(id_col).cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Character table of all ``docs`` and a classifier on at most ``sample_rows`` labelled rows that are not held out.

    Only ``labels.toxic`` is learnt from.  Rows without id or label are no examples; of several labels of a document
    the highest counts.  Without examples, or with one label only, every text gets the same score.
    """
    letters = character_model(docs)
    examples = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # at most sample_rows ids, whatever the corpus
    sample = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(examples), "doc_id")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
        weights, bias = fit_weights(list(rows["text"]), rows["toxic"].to_numpy(float), letters)
        return pd.DataFrame({"feature": [*weights, ""], "weight": [*weights.values(), bias]})

    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(train, "feature string, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in fitted}
    return Model(letters, weights, weights.pop("", -8.0))


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """``docs`` with ``score_col`` between 0 and 1 from the whole text alone (replaced if there is such a column).

    Null and empty texts get the score of a text without features.  The time for a text grows with its length, however
    long its words are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    (work,) = free_names(docs, "_score")

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        weights, seen = known.weights, {}

        def of(word: str) -> tuple[str, ...]:
            return tuple(f for f in features(word) if f in weights)

        for texts in batches:
            out = []
            for text in texts:
                found: set[str] = set()
                for word in set(_WORD.findall(restore(text, known.letters).lower())):
                    hits = seen.get(word)
                    if hits is None:
                        if len(seen) >= 150_000:
                            seen.clear()
                        hits = seen[word] = of(word)
                    if hits:
                        found.update(hits)
                z = known.bias + math.fsum(weights[f] for f in found)
                out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
            yield pd.Series(out, dtype=float)

    kept = [col(c) for c in docs.columns if c.lower() != score_col.lower()]
    return docs.withColumn(work, scored(text_of(text_col))).select(*kept, F.col(work).alias(score_col))

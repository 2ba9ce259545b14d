"""Near-duplicate classes: BagMinHash signatures of word shingles, bands, and exact multiset overlap.

A text is the multiset of its five-word shingles.  Every shingle runs Poisson processes over its weight axis, cut at
the powers of two: the piece from ``2**j`` to ``2**(j+1)`` is one process whose points fall on unit steps by halving, so
a count of w costs about log w processes and equal counts share all points below.  The earliest point of each slot is
the signature; slots agree with the probability of the weighted Jaccard similarity.

Texts that agree in a band share a bucket.  Within a bucket, members are compared with one pivot, the one that shares
most buckets and so stands in the middle of its group: a group of near copies costs a comparison per member.  Links
are followed to the end, and what is left are members of one bucket in different classes.  Of these

* the ones near the bucket's reference, the centre of its largest class, are told apart by how they differ from it.  Two
  texts of weight v and w are similar if their multisets differ in (v + w) / 9 shingles at most.  As one of them is not
  similar to the reference, they must then have a number of differences from it in common, and so share one of the
  rarest few of their differences.  Only such pairs are looked at.
* the others are tried on sketches.

Similarities are taken from the whole texts, and all of this is keyed by texts: ids come in at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, discard, free_names, text_of, written

WORDS, SIMILARITY = 5, 0.8

#: Bands and slots in each: a pair at the threshold is missed with probability 3e-6.
BANDS, ROWS = 42, 6
SLOTS = BANDS * ROWS

#: Four bits of every slot, 16 slots to a long: what pairs are tried on before their texts are fetched.
SKETCH = -(-SLOTS // 16)

#: Slots in which sketches may differ: five deviations above the mean of a pair at the threshold (3e-7 lie beyond).
_APART = (1 - SIMILARITY) * 15 / 16
FAR = int(SLOTS * _APART + 5 * math.sqrt(SLOTS * _APART * (1 - _APART)))

#: Sketches of texts that count as near a reference differ in fewer slots than those of similarity 0.5 on average.
LOOSE = int(SLOTS * 0.5 * 15 / 16)

#: Pivots are chosen anew while members of different classes make more such pairs per member than this.
PAIRS_PER_MEMBER = 1_000

_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    """Hash of a word, remembered for up to 150,000 words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_words = _WordHash()

#: What separates words; other white space is part of them.
_SPACES = str.maketrans("\t\n\x0b\x0c\r", "     ")


def words_of(text: str) -> list[str]:
    return [w for w in text.translate(_SPACES).split(" ") if w]


def shingle_hashes(words: list[str]) -> np.ndarray:
    """One hash per run of five words; a shorter text is one shingle, a text without words none."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(WORDS, len(each))
    n = len(each) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = _mixed(out * _C + each[k : k + n])
    return out


def weighted(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of a text and how often each occurs."""
    return np.unique(shingle_hashes(words), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; texts without words are equal to each other alone."""
    both, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][in_a], b[1][in_b]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 1.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """A row of ``slots`` point hashes for every multiset; zeros for an empty one."""
    out = np.zeros((len(bags), slots), dtype=np.uint64)
    # texts of like weight go together: they need about as many points from every process
    alike: dict[int, list[int]] = {}
    for k, (_, counts) in enumerate(bags):
        if len(counts):
            alike.setdefault(int(counts.sum()).bit_length() // 2, []).append(k)
    for todo in alike.values():
        # so far along the processes that a slot is left empty in about one text of twenty; then further
        reach = math.log(slots) + 3
        while todo:
            short = _fill(out, [bags[k] for k in todo], np.array(todo), slots, reach)
            todo, reach = [todo[k] for k in short], 2 * reach
    return out


def _fill(out: np.ndarray, bags, rows: np.ndarray, slots: int, reach: float) -> np.ndarray:
    """Fills the rows of ``out`` with all points up to ``reach`` over the text's weight; which have empty slots."""
    shingles = np.concatenate([s for s, _ in bags])
    counts = np.concatenate([c for _, c in bags])
    owner = np.repeat(np.arange(len(bags)), [len(s) for s, _ in bags])
    limit = reach / np.array([c.sum() for _, c in bags], dtype=float)

    keys, rates, lows, tops, owners = [], [], [], [], []
    low, length = 0, 1  # the piece of the weight axis from low to low + length
    while True:
        on = counts > low
        if not on.any():
            break
        with np.errstate(over="ignore"):
            keys.append(_mixed(shingles[on] + _C * np.uint64(low + 1)))
        rates.append(np.full(on.sum(), 1.0 / (slots * length)))
        lows.append(np.full(on.sum(), low))
        tops.append(counts[on])
        owners.append(owner[on])
        low, length = low + length, low + length
    key, gap, low, top, own = (np.concatenate(x) for x in (keys, rates, lows, tops, owners))
    length = np.maximum(low, 1)

    # points are drawn in rounds of as many as most processes have up to their limit
    usual = slots * reach / float(np.median([c.sum() for _, c in bags]))
    per_round = int(usual + 2 * math.sqrt(usual)) + 1
    at, step = np.zeros(len(key)), 0
    times, places, values = [], [], []
    while len(key):
        with np.errstate(over="ignore"):
            draw = _mixed(key[:, None] + np.arange(step + 1, step + per_round + 1, dtype=np.uint64) * _C)
        step += per_round
        gaps = np.log((draw >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) * -gap[:, None]
        reached = np.cumsum(gaps, axis=1) + at[:, None]
        process, point = np.nonzero(reached <= limit[own][:, None])
        where = _mixed(draw[process, point] ^ _C)
        slot = (where >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)
        unit = low[process] + ((where & np.uint64(0xFFFFFFFF)).astype(np.int64) * length[process] >> 32)
        held = unit < top[process]  # points on steps above the shingle's count belong to heavier multisets
        times.append(reached[process, point][held])
        places.append(own[process[held]] * slots + slot[held].astype(np.int64))
        values.append(where[held])
        at = reached[:, -1]
        on = at <= limit[own]
        key, gap, low, top, own, length, at = (x[on] for x in (key, gap, low, top, own, length, at))
    at, place, value = (np.concatenate(x) for x in (times, places, values))
    first = np.full(len(bags) * slots, np.inf)
    np.minimum.at(first, place, at)
    wins = at == first[place]
    found = np.zeros(len(bags) * slots, dtype=np.uint64)
    found[place[wins]] = value[wins]
    out[rows] = found.reshape(-1, slots)
    return np.flatnonzero(np.isinf(first).reshape(-1, slots).any(axis=1))


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A bucket for every band of every signature."""
    split = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), split.shape[:2])
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            out = _mixed(out * _C + split[:, :, k])
    return out.view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """The last four bits of the slots, packed."""
    bits = np.zeros((len(signature), SKETCH * 16), dtype=np.uint64)
    bits[:, :SLOTS] = signature & np.uint64(15)
    bits = bits.reshape(len(signature), SKETCH, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_or.reduce(bits, axis=2).view(np.int64)


def slots_apart(a: str, b: str) -> str:
    """SQL: in how many slots two sketches differ."""
    each = (f"get({a}, {k}) ^ get({b}, {k})" for k in range(SKETCH))
    folded = (f"({x}) | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3)" for x in each)
    return " + ".join(f"bit_count(({x}) & {0x1111111111111111})" for x in folded)


def key_of(words: list[str]) -> bytes:
    """What texts of the same words have in common."""
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def _print_texts(texts: list[str]) -> list[tuple[bytes, int, list[int], list[int]]]:
    """The key of each text, its number of shingles, its buckets and its sketch."""
    split = [words_of(t) for t in texts]
    bags = [weighted(w) for w in split]
    signed = signatures(bags)
    return [
        (key_of(words), int(bag[1].sum()), bands.tolist() if len(bag[0]) else [], sketch.tolist())
        for words, bag, bands, sketch in zip(split, bags, band_keys(signed), sketches(signed))
    ]


def _printed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows: list[tuple[bytes, int, list[int], list[int]]] = []
        waiting: list[str] = []
        chars = 0
        for text in texts:
            waiting.append(text)
            chars += len(text)
            if chars >= 400_000:
                rows += _print_texts(waiting)
                waiting, chars = [], 0
        if waiting:
            rows += _print_texts(waiting)
        yield pd.DataFrame(rows, columns=["key", "size", "bands", "sketch"])


def _keys(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: key_of(words_of(t)))


def _similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    bag = lru_cache(maxsize=128)(lambda text: weighted(words_of(text)))
    for a, b in batches:
        yield pd.Series([overlap(bag(x), bag(y)) for x, y in zip(a, b)], dtype=float)


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A token for every unit that the multiset ``b`` has more or less than ``a``.

    Two multisets share as many tokens as they have units in common by which they differ from ``a``.
    """
    shingles, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    more = np.zeros(len(shingles), dtype=np.int64)
    np.add.at(more, where, np.concatenate([-a[1], b[1]]))
    on = np.flatnonzero(more)
    units = np.abs(more[on])
    nth = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
    with np.errstate(over="ignore"):
        place = (nth * 2 + np.repeat(more[on] < 0, units)).astype(np.uint64) + np.uint64(1)
        return _mixed(np.repeat(shingles[on], units) + place * _C).view(np.int64)


def _differences(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    bag = lru_cache(maxsize=128)(lambda text: weighted(words_of(text)))
    for a, b in batches:
        out = [(overlap(bag(x), bag(y)), differences(bag(x), bag(y)).tolist()) for x, y in zip(a, b)]
        yield pd.DataFrame(out, columns=["s", "tokens"])


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: every node of the edges (``a``, ``b``) with the smallest node it is connected to.

    Each turn hands every node the smallest label of its neighbours and then follows labels to their own, so that long
    chains shrink by halves.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = written(labels, "labels")
    while True:
        heard = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        nearer = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("to"))
        nearer = written(nearer, "labels")
        jump = nearer.select(F.col("to").alias("on"), F.col("node").alias("to"))
        after = nearer.join(jump, "to").select("node", "label", F.least("to", "on").alias("next"))
        after = written(after, "labels")
        discard(labels, nearer)
        if not after.where(F.col("next") < F.col("label")).limit(1).count():
            discard(both)
            return after.select("node", F.col("next").alias("label"))
        labels = written(after.select("node", F.col("next").alias("label")), "labels")
        discard(after)


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``node``, ``class_id`` for every different document of ``docs``; ``node`` is ``node_of``.

    Texts with the same words are copies; other texts are linked when the multiset overlap of their five-word shingles
    is at least 0.8, and a class is what links connect.  ``class_id`` is the smallest node.  A text below five words is
    one shingle, texts without words (null, empty, blank) are copies of each other.  Rows that share an id are one
    document: all their texts are compared, and they are in one class.  Long texts are compared whole.  An empty table
    has no classes.
    """
    rows = docs.select(node_of(id_col, text_col).alias("node"), text_of(text_col).alias("text"))
    texts = Texts(rows)
    ties = texts.prints.join(texts.several.withColumnRenamed("low", "a"), "node").select("a", F.col("key").alias("b"))
    labels = _linked(texts, written(ties.where(F.col("a") < F.col("b")).distinct(), "ties"))
    reps = texts.reps.select("key", "rep")
    first = reps.join(labels, "key").groupBy("label").agg(F.min("rep").alias("class_id"))
    linked = labels.join(first, "label").select("key", "class_id")
    named = reps.join(linked, "key", "left").select("key", F.coalesce("class_id", "rep").alias("class_id"))
    return texts.prints.select("node", "key").join(named, "key").select("node", "class_id").distinct()


class Texts:
    """Tables of the different texts of ``rows`` (``node``, ``text``).

    ``prints``: ``node`` and ``key`` of every row.  ``reps``: every key with its smallest node ``rep``.  ``several``: the
    nodes of different texts, with their smallest key ``low``.  ``members``: keys that share a ``bucket`` with others.
    ``whole``: the text of every member.
    """

    def __init__(self, rows: DataFrame):
        printed = F.pandas_udf(_printed, "struct<key:binary,size:bigint,bands:array<bigint>,sketch:array<bigint>>")
        self.prints = written(rows.select("node", printed("text").alias("p")).select("node", "p.*"), "prints")
        same = [F.first(c).alias(c) for c in ("size", "bands", "sketch")]
        self.reps = reps = written(self.prints.groupBy("key").agg(F.min("node").alias("rep"), *same), "reps")
        of = self.prints.groupBy("node").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        self.several = written(of.where(F.col("low") < F.col("high")).select("node", "low"), "several")

        slots = reps.select("key", F.explode("bands").alias("bucket"))
        full = slots.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        full = full.where(F.col("low") < F.col("high")).select("bucket")
        shared = written(slots.join(full, "bucket"), "shared")
        weight = shared.groupBy("key").agg(F.count("*").alias("weight"))
        found = shared.join(reps.select("key", "size", "sketch"), "key").join(weight, "key")
        self.members = written(found.select("bucket", "key", "size", "weight", "sketch"), "members")
        discard(shared)
        wanted = reps.select("key", "rep").join(self.members.select("key").distinct(), "key")
        self.whole = written(self.rows_of(rows, wanted, "node", "text").select("key", "text").dropDuplicates(["key"]), "texts")

    def rows_of(self, rows: DataFrame, wanted: DataFrame, node: str, text: str) -> DataFrame:
        """The rows whose node and text are those of a row (``key``, ``rep``) of ``wanted``, with ``key``."""
        one = wanted.join(self.several.select(F.col("node").alias("rep"), "low"), "rep", "left")
        found = rows.join(one, F.col(node) == F.col("rep"))
        # only a node of several texts needs a look at the text
        doubtful = F.col("low").isNotNull()
        own = F.pandas_udf(_keys, "binary")(F.when(doubtful, F.col(text)).otherwise(""))
        return found.withColumn("low", F.when(doubtful, own).otherwise(F.col("key"))).where(F.col("low") == F.col("key")).drop("rep", "low")


def _near(a: str, b: str) -> str:
    """SQL: weights and sketches of two texts allow a similarity of 0.8."""
    alike = f"least({a}.size, {b}.size) >= {SIMILARITY} * greatest({a}.size, {b}.size)"
    return f"{alike} AND {slots_apart(f'{a}.sketch', f'{b}.sketch')} <= {FAR}"


_TEXT = ("key", "size", "sketch")


def _linked(texts: Texts, ties: DataFrame) -> DataFrame:
    """``key``, ``label`` of all members and ``ties``: what links within buckets and ties connect has one label."""
    labels = texts.members.select("key").union(ties.select("a")).union(ties.select("b")).distinct()
    labels = _merged(written(labels.select("key", F.col("key").alias("label")), "labels"), ties)
    members, turn = texts.members, 0
    while True:
        current = members.join(labels, "key")
        sizes = (
            current.groupBy("bucket", "label")
            .agg(F.count("*").alias("n"), F.max_by(F.struct("weight", "label", *_TEXT), F.struct("weight", "key")).alias("of"))
            .groupBy("bucket")
            .agg(
                F.count("*").alias("classes"),
                # pairs of different classes, counted for both members
                (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("pairs"),
                F.sum("n").alias("n"),
                F.max_by("of", F.struct(F.col("of.weight"), F.col("of.key"))).alias("pivot"),
                F.max_by("label", F.struct("n", "label")).alias("most"),
            )
            .where(F.col("classes") > 1)
        )
        sizes = written(sizes, "buckets")
        n, pairs = sizes.agg(F.sum("n"), F.sum(F.col("pairs") / 2)).first()
        if not n:
            return labels
        current = current.withColumn("own", F.struct(*_TEXT))
        if turn and pairs <= PAIRS_PER_MEMBER * n:
            return _merged(labels, _rest(current, sizes.select("bucket", "most"), labels, texts))
        open_ = written(current.join(sizes.select("bucket", "pivot"), "bucket"), "open")
        near = open_.where(F.expr(f"label <> pivot.label AND {_near('own', 'pivot')}"))
        near = near.select(F.col("pivot.key").alias("a"), F.col("key").alias("b")).distinct()
        labels = _merged(labels, _similar(near, texts.whole))
        # a pivot has met all members of its bucket
        left = open_.where(F.col("key") != F.col("pivot.key")).select(*texts.members.columns)
        members, turn = written(left, "members"), turn + 1
        discard(open_, sizes)


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels when the links (``a``, ``b``) are added: classes are contracted first, so that little is left to follow."""
    a, b = (labels.select(F.col("key").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    edges = links.join(a, "a").join(b, "b").where(F.col("la") != F.col("lb")).select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(edges).select(F.col("node").alias("label"), F.col("label").alias("to"))
    after = labels.join(joined, "label", "left").select("key", F.coalesce("to", "label").alias("label"))
    return written(after, "labels")


def _rest(members: DataFrame, open_: DataFrame, labels: DataFrame, texts: Texts) -> DataFrame:
    """All links between members of a bucket that have different labels; ``open_`` has the buckets' largest classes."""
    centres = texts.members.join(labels, "key").groupBy(F.col("label").alias("most"))
    centres = centres.agg(F.max_by(F.struct(*_TEXT), F.struct("weight", "key")).alias("ref"))
    # a row per bucket finds the centre, and not every member of a large class
    held = members.join(open_.join(centres, "most"), "bucket").select(
        "bucket", "key", "size", "sketch", "label", F.col("ref.key").alias("ref"), F.col("most").alias("ref_label"),
        F.expr(f"{slots_apart('sketch', 'ref.sketch')} <= {LOOSE}").alias("near"),
    )
    held = written(held, "held")
    x, y = held.alias("x"), held.alias("y")
    apart = f"x.bucket = y.bucket AND x.key < y.key AND x.label <> y.label AND NOT (x.near AND y.near) AND {_near('x', 'y')}"
    far = x.join(y, F.expr(apart)).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))

    tied = held.where(F.col("near") & (F.col("key") != F.col("ref"))).select("ref", "ref_label", "key", "label", "size").distinct()
    outside = F.col("label") != F.col("ref_label")
    mixed = tied.groupBy("ref").agg(F.count_if(outside).alias("n")).where(F.col("n") > 0).select("ref")
    measured = _measured(tied.join(mixed, "ref"), texts.whole)
    direct = measured.where(outside & (F.col("s") >= SIMILARITY)).select(F.col("ref").alias("a"), F.col("key").alias("b"))
    found = _similar(far.union(_sharing(measured)).distinct(), texts.whole)
    return direct.union(found)


def _measured(tied: DataFrame, whole: DataFrame) -> DataFrame:
    """Similarity of each text to its reference, and the tokens of the differences between them."""
    measure = F.pandas_udf(_differences, "struct<s:double,tokens:array<bigint>>")
    ref = whole.select(F.col("key").alias("ref"), F.col("text").alias("ref_text"))
    both = tied.join(ref, "ref").join(whole, "key").withColumn("m", measure("ref_text", "text"))
    return written(both.select("ref", "ref_label", "key", "label", "size", "m.*"), "differences")


def _sharing(measured: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) with the same reference that may be linked, from the differences they have in common.

    With Da and Db differences from the reference and weights v and w, two texts are similar if and only if they share
    ``c = ((9 Da - v) + (9 Db - w)) / 18`` differences or more.  In any order that is the same for all texts, the first
    one they share is then among the first ``Da - c + 1`` of the one and ``Db - c + 1`` of the other.  The rarest come
    first.
    """
    inside = (F.col("label") == F.col("ref_label")) | (F.col("s") >= SIMILARITY)
    rows = measured.select(
        "ref", "key", "label", "size", inside.alias("inside"), F.size("tokens").cast("long").alias("d"), "tokens"
    ).withColumn("h", F.col("d") * 9 - F.col("size"))
    # texts inside the reference's class need partners outside; the latter may have any
    least = rows.groupBy("ref").agg(
        F.min("h").alias("any"), F.min(F.when(~F.col("inside"), F.col("h"))).alias("outer"), F.count("*").alias("n")
    ).where(F.col("outer").isNotNull() & (F.col("n") > 1))
    fewest = F.expr("greatest(1, (h + if(inside, outer, any) + 17) div 18)")
    rows = rows.join(least, "ref").withColumn("first", (F.col("d") - fewest + 1).cast("int")).where(F.col("first") >= 1)
    of = ["ref", "key", "label", "size", "inside", "d", "h", "first"]
    tokens = rows.select(*of, F.explode("tokens").alias("token"))
    common = tokens.groupBy("ref", "token").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    rarest = F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(1)).alias("held"), "token")))
    ordered = tokens.join(common, ["ref", "token"], "left").groupBy(*of).agg(rarest.alias("tokens"))
    prefix = ordered.select(*of, F.posexplode(F.slice("tokens", F.lit(1), F.col("first"))).alias("at", "t"))
    # a token that one text alone has finds nobody
    prefix = prefix.where(F.col("t.held") > 1).select(*of, "at", F.col("t.token").alias("token"))
    prefix = written(prefix, "prefix")
    x, y = prefix.alias("x"), prefix.alias("y")
    shared = "greatest(1, (x.h + y.h + 17) div 18)"
    meet = (
        "x.ref = y.ref AND x.token = y.token AND x.key < y.key AND x.label <> y.label AND NOT (x.inside AND y.inside) "
        f"AND x.at <= x.d - {shared} AND y.at <= y.d - {shared}"
    )
    return x.join(y, F.expr(meet)).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))


def _similar(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs whose whole texts overlap enough."""
    a, b = (whole.select(F.col("key").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    similarity = F.pandas_udf(_similarity, "double")
    scored = pairs.join(a, "a").join(b, "b").select("a", "b", similarity("text_a", "text_b").alias("s"))
    return written(scored.where(F.col("s") >= SIMILARITY).select("a", "b"), "links")


def node_of(id_col: str = "doc_id", text_col: str = "text"):
    """A document's id, or a hash of its text where it has none."""
    return F.coalesce(col(id_col).cast("long"), F.xxhash64(text_of(text_col)))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of every class; columns stay as they are.

    Classes are those of texts here: rows that share an id and hold different texts are told apart, and each stays if
    its text's class has no smaller id.  Of equal rows one stays.
    """
    node, text = free_names(docs, "_node", "_text")
    rows = docs.withColumns({node: node_of(id_col, text_col), text: text_of(text_col)})
    texts = Texts(rows.select(F.col(node).alias("node"), F.col(text).alias("text")))
    ties = texts.members.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)
    labels = _linked(texts, ties)
    reps = texts.reps.select("key", "rep")
    best = reps.join(labels, "key").groupBy("label").agg(F.min(F.struct("rep", "key")).alias("m"))
    chosen = best.select("m.key", "m.rep").union(reps.join(labels, "key", "left_anti").select("key", "rep"))
    packed = rows.select(node, text, F.struct(*[col(c) for c in docs.columns]).alias("row"))
    kept = texts.rows_of(packed, chosen, node, text).dropDuplicates([node, "key"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

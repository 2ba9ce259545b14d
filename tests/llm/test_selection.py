"""Search, packing and resampling against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lossgrid.llm import packing, resample, search
from lossgrid.llm.terms import terms_of
from lossgrid.session import ship_package

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LONG = " ".join(f"word{i % 977}x" for i in range(60_000))


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@given(st.text(max_size=80))
def test_terms_are_the_pattern(text):
    assert [t.decode() for t in terms_of(text)] == TERM.findall(lowered(text))


# -- resampling --------------------------------------------------------------


@settings(max_examples=60)
@given(st.lists(st.lists(st.binary(min_size=1, max_size=40), max_size=12), max_size=5), st.integers(1, 4))
def test_crc_of_every_run(documents, width):
    crcs, owners = resample.feature_crcs(documents, width)
    want = [
        (k, crc32(b" ".join(terms[i : i + w])))
        for k, terms in enumerate(documents)
        for w in range(1, width + 1)
        for i in range(len(terms) - w + 1)
    ]
    assert sorted(zip(owners.tolist(), crcs.tolist())) == sorted(want)


def test_shift_of_long_runs():
    for n in (1, 255, 70_000, 1 << 20):
        head, tail = b"some head ", bytes(random.Random(n).randbytes(n))
        crc = resample.shifted(np.array([crc32(head)], np.uint32), np.array([n]))[0] ^ np.uint32(crc32(head + tail))
        assert int(crc) == crc32(tail)


def drawn_by_hand(docs, target, buckets, width, percent, least):
    def features(text):
        words = TERM.findall(lowered(text))
        runs = [" ".join(words[i : i + w]) for w in range(1, width + 1) for i in range(len(words) - w + 1)]
        return len(words), [crc32(r.encode()) % buckets for r in runs]

    held = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in held for b in f), Counter(b for x in target for b in features(x)[1])
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for d, words, f in held:
        weight = sum(gain[b] for b in f)
        h = int(sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = defaultdict(list)
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        rank[r].append(k + 1)
    return sorted((*map(str, r), str(rank[r].pop() if rank[r] else None)) for r in rows)


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"wörd{k}" if k % 9 == 0 else f"Word{k}" for k in range(120)]
    docs = [(k, " ".join(rng.choices(vocabulary, weights=[200 / (i + 1) for i in range(120)], k=rng.randint(0, 60)))) for k in range(n)]
    # a third of the rows are copies of one text, some without an id; nulls, blanks and a long text
    docs += [(None if k % 5 == 0 else 1000 + k, docs[7][1]) for k in range(n // 3)]
    return docs + [(5000, None), (5001, " .,;\n"), (5002, LONG), (5003, ""), (3, docs[3][1])]


@pytest.mark.parametrize("width", [1, 3])
def test_resampling_against_plain_rules(spark, width):
    docs, target = corpus(), ["word1 word2 word3 wörd9", None, "Word5 " * 30]
    frame = ship_package(spark).createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, weight int, bucket string").repartition(7)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(frame, goal, buckets=97, max_words=width, percent=15).collect()
    want = drawn_by_hand(docs, target, 97, width, 15, 20)
    assert sorted(tuple(str(v) for v in r) for r in got) == want


def test_resampling_of_empty_tables(spark):
    none = ship_package(spark).createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(k, "one two " * 20) for k in range(10)], "doc_id long, text string")
    assert resample.resample(none, some).count() == 0
    assert sorted(r["rank"] or 0 for r in resample.resample(some, none, percent=30).collect()) == [0] * 7 + [1, 2, 3]


# -- search ------------------------------------------------------------------


def found_by_hand(docs, items, top):
    held = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(list)
    for item, text in items:
        asked[item] += TERM.findall(lowered(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scores.append((-score, d is not None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return Counter(out)


@pytest.mark.parametrize("segment", [11, 4000])
def test_search_against_all_pairs(spark, monkeypatch, segment):
    monkeypatch.setattr(search, "BUNDLE_ITEMS", 4)
    monkeypatch.setattr(search, "SEGMENT_DOCS", segment)
    monkeypatch.setattr(search, "SHARES", (0.02, 0.1, 0.4))
    docs = corpus()
    rng = random.Random(5)
    items = [(k, " ".join(rng.choices((docs[rng.randrange(400)][1] or "x").split() or ["y"], k=rng.randint(1, 15)))) for k in range(30)]
    items += [(3, "word1 WORD1"), (None, "word7"), (None, None), (41, ""), (42, "not there"), (43, "word977x word5x")]
    frame = ship_package(spark).createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, term string, score int").repartition(6)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in search.search(frame, asked, top=20).select("item_id", "rank", "doc_id", "score").collect())
    assert got == found_by_hand(docs, items, 20)


def test_search_of_empty_tables(spark):
    some = ship_package(spark).createDataFrame([(1, "a text of words"), (2, "other words")], "doc_id long, text string")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert search.search(some.limit(0), items).count() == 0
    assert search.search(some, items.limit(0)).count() == 0


# -- packing -----------------------------------------------------------------


class PlainBins:
    """The same rule, by looking at every open sequence."""

    def __init__(self, capacity, places):
        self.capacity, self.places, self.open, self.next = capacity, places, [], 0

    def place(self, length):
        fit = [b for b in self.open if b[0] >= length]
        if fit:
            one = max((b for b in fit if b[0] == min(f[0] for f in fit)), key=self.open.index)
            self.open.remove(one)
        else:
            if len(self.open) == self.places:
                least = min(b[0] for b in self.open)
                self.open.remove([b for b in self.open if b[0] == least][-1])
            one = (self.capacity, self.next)
            self.next += 1
        if one[0] > length:
            self.open.append((one[0] - length, one[1]))
        return one[1], self.capacity - one[0]


@given(st.lists(st.integers(1, 40), max_size=200), st.integers(1, 6))
def test_bitset_places_as_the_plain_rule(lengths, places):
    bits, plain = packing.OpenSequences(40, places), PlainBins(40, places)
    assert [bits.place(n) for n in lengths] == [plain.place(n) for n in lengths]
    assert bits.open <= places


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_remembered_ids_are_the_tokenizers(text):
    coder = packing.encoder(tokenizer_path())
    assert coder.encode([text, "a b", text]) == coder.whole([text, "a b", text])


def test_ids_of_the_given_documents(monkeypatch):
    import duckdb

    monkeypatch.setattr(packing, "MEMORY", 2000)
    texts = [t or "" for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    coder = packing.Encoder(tokenizer_path())
    for k in range(0, len(texts), 90):
        assert coder.encode(texts[k : k + 90]) == coder.whole(texts[k : k + 90])


def test_every_token_has_its_place(spark):
    path = tokenizer_path()
    docs = corpus() + [(6000, "<|endoftext|> and it's 12 don't\t\n  x"), (6001, "漢字 ไทย " * 400), (6002, "Ωmega \x85\x1c ﬁ")]
    frame = ship_package(spark).createDataFrame([(*d, 1, b"") for d in docs], "doc_id long, text string, start int, ids binary")
    rows = packing.pack(frame.repartition(3), path, capacity=512).collect()
    coder = packing.Encoder(path)
    want = Counter((d, coder.whole([t or ""])[0] + b"\0\0\0\0") for d, t in docs)
    # documents from pieces: the pieces of copies are equal, so they are counted as often as the document
    pieces = Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows)
    expected = Counter()
    for (d, ids), n in want.items():
        for k, (start, length) in enumerate(packing.cut(len(ids) // 4, 512)):
            expected[(d, k, start, length, ids[4 * start : 4 * (start + length)])] += n
    assert pieces == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    tokens = sum(len(ids) // 4 * n for (_, ids), n in want.items())
    assert len(sequences) <= 1.03 * tokens / 512 + 1


def test_pieces_of_long_documents():
    assert packing.cut(10, 4) == [(0, 2), (2, 4), (6, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(4, 4) == [(0, 4)] and packing.cut(1, 4) == [(0, 1)]


def test_packing_an_empty_table(spark):
    none = ship_package(spark).createDataFrame([], "doc_id long, text string")
    assert packing.pack(none, tokenizer_path()).count() == 0

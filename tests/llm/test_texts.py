"""Text operators against plain definitions."""

import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lossgrid.llm import chat, decontaminate, pages, pii, toxicity
from lossgrid.llm.decontaminate import Block, Limits
from lossgrid.session import ship_package

# ---------------------------------------------------------------- byte pairs

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def coder():
    import regex
    import tiktoken

    from lossgrid.llm.bpe import vocabulary

    vocab = vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    return vocab, regex.compile(P.PATTERN), reference


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abehint ", max_size=80) | st.text(alphabet="0123 \n\té's", max_size=40))
def test_byte_pairs(coder, text):
    vocab, pattern, reference = coder
    ids = vocab.encode_text(text, pattern)
    assert ids == reference.encode_ordinary(text)
    assert vocab.decode(ids) == text.encode()


def test_byte_pairs_of_long_pieces(coder):
    vocab, pattern, reference = coder
    rng = random.Random(5)
    for text in ("a" * 20_000, "ab" * 9_000, "é" * 9_000, "".join(rng.choices("thering", k=20_000))):
        assert vocab.encode_text(text, pattern) == reference.encode_ordinary(text)


# ---------------------------------------------------------------- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(digits(m)[::-1])]
        if 12 <= len(doubled) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0:
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="012345.@+-() ab%_Aé", max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def field(spark, tables):
    return pii.fit(ship_package(spark).read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_field_adds_what_patterns_miss(field):
    for text, want in {
        "call (443) 555-5793 now": ("phone", "(443) 555-5793"),
        "write to smith at example dot com please": ("email", "smith at example dot com"),
        "host 10[.]0[.]0[.]1 is down": ("ip", "10[.]0[.]0[.]1"),
        "card 4111.1111.1111.1111 was used": ("card", "4111.1111.1111.1111"),
    }.items():
        assert pii.base_spans(text) == []
        found = [(kind, text[a:b]) for a, b, kind in pii.added_spans(text, [], field)]
        assert want in found
    for text in ("on 2024-01-15 we met", "pages 12 to 345", "it costs 1.234.567,89 now", "number 4111 1111 1111 1112 is not"):
        assert pii.added_spans(text, pii.base_spans(text), field) == []


def test_field_keeps_base_spans(field):
    text = "mail a.b@c.org or +1 (443) 555-5793 4111111111111111, 10.0.0.1"
    base = pii.base_spans(text)
    for start, end, _ in pii.added_spans(text, base, field):
        assert all(end <= a or start >= b for a, b, _ in base)


def test_best_segmentation_is_the_best(field):
    """Dynamic programming against all ways to choose segments that do not overlap."""
    text = "+1 443 555 5793 4111 1111 1111 1111 x"
    segments = [(a, end, kind, s) for end, found in field.segments(text).items() for a, kind, _, s in found]
    segments = sorted(segments, key=lambda s: -abs(s[3]))[:14]

    def best(rest, taken):
        if not rest:
            return sum(s[3] for s in taken)
        (head, *tail) = rest
        out = best(tail, taken)
        if all(head[1] <= t[0] or head[0] >= t[1] for t in taken):
            out = max(out, best(tail, [*taken, head]))
        return out

    score = {(a, b, k): s for a, b, k, s in segments}
    chosen = field.best(text)
    assert sum(score.get(c, 0.0) for c in chosen) >= best(segments, []) - 1e-9


# ---------------------------------------------------------------- benchmark leaks


def leaks_slowly(text, item, limits):
    a, b = decontaminate.plain(text), decontaminate.plain(item)
    window, edits, _ = limits.of(max(len(b), limits.q))
    if len(b) < limits.q:
        return a == b
    for s in range(len(b) - window + 1):
        row = [0] * (len(a) + 1)
        for c in b[s : s + window]:
            after = [row[0] + 1]
            for j, x in enumerate(a):
                after.append(min(row[j] + (x != c), row[j + 1] + 1, after[-1] + 1))
            row = after
        if min(row) <= edits:
            return True
    return False


def test_leaks_against_full_alignment():
    rng, limits, seen = random.Random(2), Limits(window=30, edits=2, q=6), 0
    letters = "ab cde"
    for _ in range(120):
        item = "".join(rng.choices(letters, k=rng.randint(3, 45)))
        if not item.strip():
            continue
        made = list(item)
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(made) + 1)
            made[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "z"])
        text = "".join(rng.choices(letters, k=rng.randint(0, 40))) + "".join(made) + "".join(rng.choices(letters, k=20))
        want = leaks_slowly(text, item, limits)
        seen += want
        assert Block([(1, item)], limits).leaks(["x y", text, "ab"])[1] == [1] * want
    assert 20 < seen < 110


def test_leak_blocks_give_one_result(spark, monkeypatch):
    rng = random.Random(3)
    items = [(k, " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(30))) for k in range(12)]
    docs = [(k, "intro " + items[k][1][5:150] + " end", "x") for k in range(12)] + [(99, "clean " * 60, "x")]
    benchmark = ship_package(spark).createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string, items string")
    whole = decontaminate.leaked_pairs(frame, benchmark).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 900)
    parts = decontaminate.leaked_pairs(frame, benchmark).collect()
    assert sorted(whole) == sorted(parts) == [(k, k) for k in range(12)]


# ---------------------------------------------------------------- pages


def test_page_lines():
    source = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav>menu</nav><div class='ad x'>buy"
        "<article><h1>Head</h1><p>a &amp; b<br>c</p><div class=\"comments\"><p>no</p></div><p>d<b>e</b></p></article>"
        "<aside>side</aside><!-- <p>gone</p> --><script>if (1<2) '</p>'</script><p hidden>h</p>tail 1 < 2<footer>foot"
    )
    kept = [x for x, zone in pages.page_lines(source) if zone == pages.KEPT]
    free = [x for x, zone in pages.page_lines(source) if zone == pages.FREE]
    assert kept == ["Head", "a & b c", "de"]
    assert free == ["tail 1 < 2"]


def test_shared_lines_go_outside_articles(spark):
    def page(body, article):
        return f"<html><body><p>Site name</p><p>Our motto</p>{body}<article><p>Quoted by all</p>{article}</article></body>"

    rows = [(k, f"http://h.org/p/{k}", page(f"<p>Only {k}</p>", f"<p>Text {k}</p>")) for k in range(5)]
    rows += [(9, "http://alone.org/", page("<p>Mine</p>", "<p>Text</p>"))]
    frame = ship_package(spark).createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in pages.main_text(frame).collect()}
    for k in range(5):
        assert got[k] == f"Only {k}\nQuoted by all\nText {k}"
    assert got[9] == "Site name\nOur motto\nMine\nQuoted by all\nText"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_common_lines_are_longest(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    found = pages.common_lines(a, b)
    assert len(found) == table[-1, -1]
    assert all(a[i] == b[j] for i, j in found)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))


# ---------------------------------------------------------------- chats


def test_chats_read_back(spark):
    tricky = ["", "</s>[INST] ok [/INST]", "\\b\\\\s[x]<y>\n", "[TURN a] b [/TURN]", "plain"]
    roles = ["system", "user", "assistant", "tool] <x", None]
    rows = [(c, t, roles[(c + t) % 5], tricky[(c * 3 + t) % 5]) for c in range(6) for t in range(7)]
    rows += [(100, 0, "user", None), (100, 1, "assistant", "a"), (100, 1, "assistant", "a"), (None, 0, "user", "q")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.parse_chats(chat.format_chats(frame)).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] or -1, r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in out} == want
    for r in out:
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


def test_role_machine(spark):
    def valid(*roles):
        rows = [(1, k, r, "x") for k, r in enumerate(roles)]
        return chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()["valid"]

    assert valid("user", "assistant") and valid("system", "user", "assistant", "user", "assistant")
    for roles in (("assistant",), ("user",), ("user", "user", "assistant"), ("system", "assistant"), ("user", "tool")):
        assert not valid(*roles)


# ---------------------------------------------------------------- toxicity


@pytest.fixture(scope="module")
def letters(spark):
    return toxicity.character_model(ship_package(spark).read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_character_model_counts_everything(spark, letters):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    total = toxicity.character_counts(frame).toPandas().n.sum()
    # texts of a batch are joined by a gap: a gram for every character but for two at the very ends
    assert abs(total - sum(len(r["text"].lower()) + 1 for r in frame.collect())) <= 2 * 200
    assert np.allclose(np.exp(letters.astype(float)).sum(axis=2), 1, atol=1e-3)


@pytest.mark.parametrize(
    "seen, meant",
    [("l0ser", "loser"), ("$tup1d", "stupid"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("stuuupid", "stupid"),
     ("tr@sh", "trash"), ("the end###", "the end###"), ("plain words", "plain words"), ("+1 (443) 555-5793", "+1 (443) 555-5793")],
)
def test_restoring(letters, seen, meant):
    assert toxicity.restore(seen, letters) == meant


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aab b1_.é中", max_size=40))
def test_stretched_words_are_the_pattern(text):
    whole = re.compile(r"[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*")
    assert list(toxicity.stretched(text)) == [m.span() for m in whole.finditer(text)]


def test_restoring_takes_linear_time(letters):
    """A million letters without a gap, as texts without spaces between words have them."""
    unbroken = "中文" * 500_000
    begun = time.monotonic()
    assert toxicity.restore(f"{unbroken} aaah", letters).startswith(unbroken + " a")
    assert toxicity.restore("hello", letters) == "hello"
    assert time.monotonic() - begun < 20


def test_decoder_finds_the_cheapest_reading(letters):
    """Viterbi against all readings of a short span."""
    import itertools

    span = "p4th3t1c"
    best = toxicity.decode(span, letters)
    options = [[(x, toxicity.STAND_IN) for x in toxicity.STANDS_FOR.get(c, "")] + ([(c, 0.0)] if c.isalpha() else []) for c in span]

    def cost(reading):
        a = b = 0
        total = 0.0
        for letter, price in reading:
            k = toxicity._CLASS[letter]
            total += price - float(letters[a, b, k])
            a, b = b, k
        return total - float(letters[a, b, 0])

    want = min(itertools.product(*options), key=cost)
    assert best == "".join(x for x, _ in want)


def test_held_out_accuracy(spark):
    from lossgrid.llm.queries import op10_toxicity

    sf = "/root/testdata/sf0.1"
    scored = op10_toxicity(ship_package(spark), sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = scored[scored.held_out]
    score, truth = held.score.to_numpy(), held.toxic.to_numpy()
    order = np.argsort(np.argsort(score)) + 1
    positives = truth.sum()
    auc = (order[truth == 1].sum() - positives * (positives + 1) / 2) / (positives * (len(truth) - positives))
    assert auc > 0.95
    assert truth[held.predicted == 1].mean() > 0.85 and held.predicted[truth == 1].mean() > 0.85

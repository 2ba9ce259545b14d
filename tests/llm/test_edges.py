"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from lossgrid.llm import bpe, decontaminate, licenses, line_dedup, near_dedup, pages, pii, quality, toxicity
from lossgrid.session import ship_package

DOCS = "doc_id long, text string, n_lines string, kept string, ids string, items string, toxicity string, path string"
LONG = " ".join(f"word{i % 977}x" for i in range(60_000))
ROWS = [
    (1, "A plain line of some words.\nshared line of text\n", "own", "own", "own", "own", "own", "a/b/1"),
    (1, "A plain line of some words.\nshared line of text\n", "own", "own", "own", "own", "own", "a/b/1"),
    (2, None, None, None, None, None, None, None),
    (None, "shared line of text", None, None, None, None, None, ""),
    (3, "", "x", "x", "x", "x", "x", "a/3"),
    (4, LONG, "x", "x", "x", "x", "x", "a/b/c/4"),
    (5, "é" * 70_000, "x", "x", "x", "x", "x", "/"),
    (6, " \t\n\r \x0b", "x", "x", "x", "x", "x", "a//b"),
    (7, "\u0000 odd ퟿ 😀 text", "x", "x", "x", "x", "x", "a"),
]


def ranks():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN


def benchmark(spark, rows=((1, "shared line of text"), (None, "x" * 90), (2, None), (3, " "))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "line_dedup": lambda s, d: line_dedup.drop_repeated_lines(d),
    "quality": lambda s, d: quality.score_quality(d),
    "bpe": lambda s, d: bpe.encode_texts(d, *ranks()),
    "pii": lambda s, d: pii.find_personal_data(d, pii.fit(d)),
    "decontaminate": lambda s, d: decontaminate.find_leaks(d, benchmark(s)),
    "no benchmark": lambda s, d: decontaminate.find_leaks(d, benchmark(s).limit(0)),
    "licenses": lambda s, d: licenses.scan_licenses(d),
    "toxicity": lambda s, d: toxicity.score_texts(
        d, toxicity.fit(d, s.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int"))
    ),
}


@pytest.fixture(scope="module")
def docs(spark):
    return ship_package(spark).createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_comes_out(spark, docs, name):
    out = OPERATORS[name](spark, docs)
    got = out.select("doc_id").toPandas().doc_id.fillna(-1).astype(int).tolist()
    assert sorted(got) == [-1, 1, 1, 2, 3, 4, 5, 6, 7]
    lowered = [c.lower() for c in out.columns]
    assert len(lowered) == len(set(lowered))
    twice = [r for r in out.drop("added").collect() if r["doc_id"] == 1]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, docs, name):
    assert OPERATORS[name](spark, docs.limit(0)).count() == 0


def test_near_dedup_edges(spark, docs):
    got = {r["node"]: r["class_id"] for r in near_dedup.duplicate_classes(docs).collect()}
    assert len(got) == 8
    assert got[2] == got[3] == got[6] == 2  # no words at all
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(got.values()))
    assert near_dedup.duplicate_classes(docs.limit(0)).count() == 0
    assert near_dedup.keep_one_of_each(docs.limit(0)).count() == 0


def test_pages_edges(spark):
    rows = [
        (1, "https://h.org/a", "<p>one</p>", "t", "u"),
        (1, "https://h.org/a", "<p>one</p>", "t", "u"),
        (2, None, None, None, None),
        (None, "no scheme", "plain", None, None),
        (3, "https://h.org/b?x#y", "", "t", "u"),
        (4, "https://h.org/", "<p>" + "long " * 50_000 + "</p>", "t", "u"),
        (5, "https://h.org/b", "<" * 3000 + "<!-- never closed", "t", "u"),
    ]
    frame = ship_package(spark).createDataFrame(rows, "page_id long, url string, html string, text string, _id1 string")
    out = pages.main_text(frame)
    assert sorted(out.columns) == ["_id1", "page_id", "text", "url"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert out.count() == 7 and got[1] == "one" and got[2] == "" and got[None] == "plain" and got[3] == ""
    assert got[4] == "long " * 49_999 + "long"
    assert pages.main_text(frame.limit(0)).count() == 0


def test_digest_queries_on_null_texts(spark):
    frame = ship_package(spark).createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r["n_tokens"] for r in bpe.token_digests(frame, *ranks()).collect()} == {0}
    found = pii.personal_data_digests(frame, pii.Field({})).collect()
    assert {(r["n_email"], r["spans"]) for r in found} == {(0, "")}
    assert len({r["base_sha256"] for r in found}) == 1
    lines = line_dedup.drop_repeated_lines(frame).select("n_lines", "n_dropped", F.col("text")).collect()
    assert {tuple(r) for r in lines} == {(1, 0, "")}


def test_blank_items_leak_nowhere():
    block = decontaminate.Block([(1, "Tiny Item"), (2, "\n\t"), (3, "a much longer item of the benchmark")], decontaminate.Limits())
    assert block.leaks(["", "\n", "tiny\titem", "tiny thing"]) == [[], [], [1], []]



def test_empty_page_beside_a_full_one_loses_its_menu():
    free = [True, True]
    assert pages.shared_lines([1, 2], free, [1, 2, 3]) == [1, 2]
    assert pages.shared_lines([1, 2], free, [1, 2]) == []


def test_field_is_fitted_on_different_regions(spark):
    from lossgrid.session import ship_package

    texts = [f"Call me at +1 555 010 99{k}9 today or write to user{k}@example.org soon." for k in range(8)]
    one, many = (ship_package(spark).createDataFrame([(t,) for t in some], "text string") for some in (texts, texts * 20))
    want = pii.fit(one, sample_regions=5).weights
    assert want and pii.fit(many, sample_regions=5).weights == want

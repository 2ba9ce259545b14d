"""The stages of the pipeline, each against what its operator stands for."""

import pytest

import corpus_pipeline
from lossgrid.llm.common import read
from test_groups import classes_slowly  # same folder
from test_texts import leaks_slowly

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs, out = read(spark, SF, "documents"), [read(spark, SF, "documents").toPandas()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_columns(kept):
    for frame in kept[1:-1]:
        assert list(frame.columns) == list(kept[0].columns)


def test_toxic_documents_go(spark, kept):
    labels = read(spark, SF, "labels").toPandas().set_index("doc_id").toxic
    gone = set(kept[0].doc_id) - set(kept[1].doc_id)
    assert gone
    assert sum(labels.get(i, 0) == 0 for i in gone if i in labels.index) <= 2


def test_lines_stay_once(kept):
    assert list(kept[2].doc_id.sort_values()) == list(kept[1].doc_id.sort_values())
    seen = set()
    for _, row in kept[2].sort_values("doc_id").iterrows():
        keys = {x.strip(" \t\n\x0b\x0c\r").lower() for x in row.text.split("\n")}
        keys = {k for k in keys if len(k) >= 10}
        assert not keys & seen
        seen |= keys
        assert row.n_chars == len(row.text)


def test_one_of_each_class(kept):
    docs = list(zip(kept[2].doc_id, kept[2].text))
    assert sorted(kept[3].doc_id) == sorted(set(classes_slowly(sorted(docs)).values()))


def test_leaks_go(spark, kept):
    from lossgrid.llm.decontaminate import Limits, plain

    items = [plain(t) for t in read(spark, SF, "benchmark").toPandas().text]
    gone = kept[3][~kept[3].doc_id.isin(kept[4].doc_id)]
    whole = {i for i, t in zip(kept[3].doc_id, kept[3].text) if any(x in plain(t) for x in items)}
    assert whole <= set(gone.doc_id)
    for text in gone.text[:3]:
        near = [x for x in items if len(set(x.split()) & set(plain(text).split())) > 5]
        assert any(leaks_slowly(text, x, Limits()) for x in near)


def test_tokens(spark, kept):
    import public_tokenizers as P
    import tiktoken

    from lossgrid.llm.bpe import read_ranks

    ranks = read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(zip(kept[4].doc_id, kept[4].text))
    assert list(kept[5].doc_id.sort_values()) == sorted(texts)
    for _, row in kept[5].iterrows():
        ids = coder.encode_ordinary(texts[row.doc_id])
        assert b"".join(i.to_bytes(4, "little") for i in ids) == row.ids and row.n_tokens == len(ids)
    assert kept[5].decodes_to_text.all()


def test_run_gives_the_last_stage(spark, kept):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").toPandas().sort_values("doc_id")
    want = kept[5].sort_values("doc_id")
    assert list(zip(got.doc_id, got.n_tokens)) == list(zip(want.doc_id, want.n_tokens))


def test_stages_keep_clashing_columns(spark):
    """Columns named like the operators' own results pass through; null and repeated rows too."""
    text = "one line of some words\nshared line of text"
    rows = [(1, text, "a", 7, "x", 0.5), (2, text, None, None, None, None), (None, None, "c", 9, "z", 1.0), (3, "", "d", 1, "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, N_dropped long, _score string, toxicity double")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names, name
    lines = {r["doc_id"]: r for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()}
    assert (lines[1]["n_lines"], lines[1]["N_dropped"], lines[2]["text"], lines[None]["n_lines"]) == ("a", 7, "", "c")
    coded = corpus_pipeline.encode(spark, docs, SF)
    assert coded.columns == ["doc_id", "ids", "n_tokens", "decodes_to_text"] and coded.count() == 4

"""Operators across documents against brute force, with hot groups."""

import random
from collections import Counter

import numpy as np
import pytest

from lossgrid.llm import licenses, line_dedup, near_dedup
from lossgrid.session import ship_package

SPACE = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_line_dedup_against_plain_rules(spark):
    rng = random.Random(1)
    pool = ["A common line here", "a COMMON line here ", "short", "Ünique ÄÖ line äö", "ünique Äö line äö", "\tother text line", "", " "]
    docs = [(i, "\n".join(rng.choices(pool, weights=[9, 3, 2, 1, 1, 2, 1, 1], k=rng.randint(0, 6)))) for i in range(300)]
    first = {}
    for i, text in docs:
        for line in text.split("\n"):
            first.setdefault(lowered(line.strip(SPACE)), i)
    holders = Counter(k for _, text in docs for k in {lowered(x.strip(SPACE)) for x in text.split("\n")})
    want = {}
    for i, text in docs:
        lines = text.split("\n")
        keys = [lowered(x.strip(SPACE)) for x in lines]
        keep = [x for x, k in zip(lines, keys) if len(k) < 10 or holders[k] < 2 or first[k] == i]
        want[i] = ("\n".join(keep), len(lines), len(lines) - len(keep))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.drop_repeated_lines(frame).collect()}
    assert got == want


def test_rows_of_one_document_share_lines(spark):
    rows = [(1, "the same line"), (1, "the same line"), (None, "the same line"), (None, "another line"), (None, "another line")]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [
        (0, ""), (0, "another line"), (0, "another line"), (1, "the same line"), (1, "the same line"),
    ]


# ---------------------------------------------------------------- near copies


def bag(text):
    words = near_dedup.words_of(text)
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def alike(a, b):
    sizes = sorted((sum(a.values()), sum(b.values())))
    if sizes[0] < 0.8 * sizes[1]:
        return 0.0  # cannot overlap by that much
    shared = sum((a & b).values())
    total = sum(sizes) - shared
    return shared / total if total else 1.0


def classes_slowly(docs):
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [(i, bag(t)) for i, t in docs]
    for k, (i, a) in enumerate(bags):
        for j, b in bags[:k]:
            if find(i) != find(j) and alike(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in docs}


@pytest.fixture(scope="module")
def copies():
    """A third near copies of one text, many exact copies of another, chains, and texts that share one passage."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    text = lambda n: [word() for _ in range(n)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = word()
        return words

    base, passage, same, chain = text(150), text(60), text(80), text(200)
    docs = [edited(base, rng.randint(1, 4)) for _ in range(110)]
    docs += [same] * 40
    docs += [passage + text(rng.randint(30, 90)) for _ in range(60)]
    for _ in range(30):
        chain = edited(chain, 2)
        docs.append(chain)
    docs += [text(rng.randint(0, 7)) for _ in range(30)] + [["w"] * k for k in range(1, 40, 3)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def test_classes_against_all_pairs(spark, copies):
    frame = ship_package(spark).createDataFrame(copies, "doc_id long, text string").repartition(6)
    got = {r["node"]: r["class_id"] for r in near_dedup.duplicate_classes(frame).collect()}
    assert got == classes_slowly(copies)


def test_pivots_alone_find_the_same_classes(spark, copies, monkeypatch):
    """No direct comparisons: pivots go on until every bucket is of one class or used up."""
    monkeypatch.setattr(near_dedup, "PAIRS_PER_MEMBER", 0)
    some = copies[:30]
    frame = ship_package(spark).createDataFrame(some, "doc_id long, text string")
    got = {r["node"]: r["class_id"] for r in near_dedup.duplicate_classes(frame).collect()}
    assert got == classes_slowly(some)


def test_signatures_estimate_weighted_overlap():
    rng = np.random.default_rng(0)
    for top in (2, 6, 50, 900):
        keys = np.sort(rng.integers(0, 2**63, 200).astype(np.uint64))
        a = rng.integers(1, top + 1, 200)
        b = np.where(rng.random(200) < 0.4, rng.integers(0, top + 1, 200), a)
        one, two = (keys, a), (keys[b > 0], b[b > 0])
        found = near_dedup.signatures([one, two], slots=6000)
        assert abs((found[0] == found[1]).mean() - near_dedup.overlap(one, two)) < 0.03


def test_signature_does_not_depend_on_company():
    texts = ["a b c d e f g", "x " * 40, "one two three four five six " * 30]
    bags = [near_dedup.weighted(near_dedup.words_of(t)) for t in texts]
    together = near_dedup.signatures(bags)
    for k in range(3):
        assert (near_dedup.signatures([bags[k]])[0] == together[k]).mean() > 0.99


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 105), (105, 101), (7, 7)]
    got = dict(near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 105: 100}


# ---------------------------------------------------------------- licences

APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."
PROSE = "some text that has nothing of the kind and goes on for a while\n" * 3


def test_licenses_are_inherited_from_the_nearest_directory(spark):
    rows = [
        ("LICENSE", APACHE),
        ("a/LICENSE", MIT),
        ("a/b/own.txt", PROSE + "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/x.txt", PROSE),
        ("d/e/y.txt", PROSE),
        ("z.txt", "Our license allows anything that you can imagine and more than that\n" + PROSE),
        (None, None),
    ]
    out = licenses.scan_licenses(ship_package(spark).createDataFrame(rows, "path string, text string")).collect()
    got = {r["path"]: (r["license"], r["origin"], r["license_dir"]) for r in out}
    assert got == {
        "LICENSE": ("Apache-2.0", "own", ""),
        "a/LICENSE": ("MIT", "own", "a"),
        "a/b/own.txt": ("GPL-3.0", "own", "a/b"),
        "a/b/c/x.txt": ("MIT", "inherited", "a"),
        "d/e/y.txt": ("Apache-2.0", "inherited", ""),
        "z.txt": ("Apache-2.0", "inherited", ""),
        None: ("Apache-2.0", "inherited", ""),
    }


def test_inheritance_against_a_walk_up_the_tree(spark):
    """Every file of a random tree, with one directory that holds a third of all."""
    rng, names = random.Random(5), dict(licenses.whole_texts())
    names = {k: names[k] for k in sorted(names)[:4]}
    rows = []
    for k in range(400):
        depth = rng.randint(0, 5)
        where = "hot/dir" if k % 3 == 0 else "/".join(rng.choice("ab") for _ in range(depth))
        name = rng.choice(sorted(names)) if rng.random() < 0.06 else None
        rows.append((k, f"{where}/f{k}" if where else f"f{k}", names[name] if name else f"words of file {k}"))
    files = ship_package(spark).createDataFrame(rows, "doc_id long, path string, text string").repartition(5)
    got = {r["doc_id"]: r for r in licenses.scan_licenses(files).collect()}
    mine = {k: got[k]["license"] for k, _, text in rows if not text.startswith("words of file")}
    assert all(got[k]["origin"] == "own" and name for k, name in mine.items())
    declared = {}
    for k, path, _ in rows:
        if k in mine:
            at = path.rpartition("/")[0]
            best = (-got[k]["cosine"], mine[k])
            declared[at] = min(declared.get(at, best), best)
    for k, path, _ in rows:
        if k in mine:
            continue
        at = path.rpartition("/")[0]
        while at not in declared and at:
            at = at.rpartition("/")[0]
        want = ("inherited", declared[at][1], at) if at in declared else ("none", "", "")
        assert (got[k]["origin"], got[k]["license"], got[k]["license_dir"]) == want, path


def test_license_cosine_by_hand():
    model = licenses.Templates(3, {"license": 2, "mit": 1})
    line = "Released under the MIT License today."
    counts = Counter(licenses.terms(line))
    weight = {t: model.weight.get(t, model.top) * n for t, n in counts.items()}
    template = {t: model.weight[t] for t in licenses.terms(MIT)}
    dot = sum(weight[t] * w for t, w in template.items())
    size = lambda v: sum(w * w for w in v.values()) ** 0.5
    assert model.best(licenses.terms(line)) == (pytest.approx(dot / size(weight) / size(template)), "MIT")


def test_wrapped_license_is_one_run():
    _, text = licenses.TEMPLATES[3]
    words = text.split()
    wrapped = "\n".join(" ".join(words[k : k + 6]) for k in range(0, len(words), 6))
    name, cosine, share = licenses.Templates(10, {}).scan("Intro line\n\n" + wrapped)
    assert name == "MIT" and cosine > 0.9 and share > 0.9


@pytest.mark.parametrize(
    "line, name",
    [
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("All rights reserved.", "Proprietary"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Released under the MIT License.", "MIT"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Copyright (c) 2024 Some Holder Ltd. All rights reserved.", "Proprietary"),
        ("Copyright 2009 The Authors. All rights reserved.\n" + "Use of this source code is governed by a BSD-style license that can be "
         "found in the LICENSE file.", "BSD-3-Clause"),
        ("We talked about whether all human rights are reserved for citizens.", ""),
    ],
)
def test_every_kind_of_notice_line(line, name):
    common = {t: 500 for t in ("all", "the", "this", "is", "work", "for", "and", "to", "of")}
    assert licenses.Templates(1000, common).scan(PROSE + line + "\n" + PROSE)[0] == name


def test_reserved_files_inherit_nothing(spark):
    rows = [("LICENSE", MIT), ("a.txt", PROSE), ("b.txt", PROSE + "All rights reserved.\n" + PROSE)]
    out = licenses.scan_licenses(ship_package(spark).createDataFrame(rows, "path string, text string")).collect()
    assert {r["path"]: (r["license"], r["origin"]) for r in out} == {
        "LICENSE": ("MIT", "own"), "a.txt": ("MIT", "inherited"), "b.txt": ("Proprietary", "own"),
    }


@pytest.mark.parametrize("name, text", licenses.whole_texts())
def test_whole_license_files(name, text):
    """Whole texts as they stand, with a holder in them, behind comment signs and on one line."""
    model = licenses.Templates(1000, {t: 500 for t in ("the", "of", "to", "and", "in", "a", "or", "this", "for", "is")})
    named = "Copyright (c) 2024 Some Holder Ltd.\n\n" + text
    for form in (text, named, "\n".join("# " + x for x in text.split("\n")), " ".join(text.split())):
        got, cosine, share = model.scan(form)
        assert got == name and cosine > 0.9 and share > 0.9
    got, _, share = model.scan(text + "\n" + PROSE * 2000)
    assert got == name and share < licenses.FILE_SHARE


def test_whole_license_file_holds_for_its_directory(spark):
    whole = dict(licenses.whole_texts())
    rows = [("LICENSE", whole["Apache-2.0"]), ("m/LICENSE", whole["MIT"]), ("m/a.txt", PROSE), ("b.txt", PROSE)]
    out = licenses.scan_licenses(ship_package(spark).createDataFrame(rows, "path string, text string")).collect()
    assert {r["path"]: (r["license"], r["origin"]) for r in out} == {
        "LICENSE": ("Apache-2.0", "own"), "m/LICENSE": ("MIT", "own"), "m/a.txt": ("MIT", "inherited"), "b.txt": ("Apache-2.0", "inherited"),
    }


def test_differences_give_similarity():
    rng = np.random.default_rng(3)
    bag_of = lambda: near_dedup.weighted([f"w{k}" for k in rng.zipf(1.4, 300) % 40])
    for _ in range(30):
        ref, a, b = bag_of(), bag_of(), bag_of()
        da, db = (near_dedup.differences(ref, x) for x in (a, b))
        assert len(set(da.tolist())) == len(da)
        shared = len(np.intersect1d(da, db))
        weight = int(a[1].sum() + b[1].sum())
        apart = len(da) + len(db) - 2 * shared
        assert near_dedup.overlap(a, b) == pytest.approx((weight - apart) / (weight + apart))


def test_half_alike_group_against_all_pairs(spark, monkeypatch):
    """One large group around a text that is (or is not) there, most pairs between 0.6 and 0.8, with sub-groups."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))

    def edited(words, n):
        words = list(words)
        for k in rng.sample(range(len(words)), n):
            words[k] = word()
        return words

    docs = []
    for there in (True, False):
        base = [word() for _ in range(170)]
        docs += [base] * there + [edited(base, rng.choice([2, 4, 5, 6, 7, 8])) for _ in range(200)]
        near = [edited(base, 7) for _ in range(10)]
        docs += near + [edited(x, rng.randint(0, 3)) for x in near for _ in range(6)]
    docs = [(i, " ".join(d)) for i, d in enumerate(rng.sample(docs, len(docs)))]
    seen = []
    similar = near_dedup._similar
    monkeypatch.setattr(near_dedup, "_similar", lambda pairs, whole: seen.append(pairs.count()) or similar(pairs, whole))
    frame = ship_package(spark).createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {r["node"]: r["class_id"] for r in near_dedup.duplicate_classes(frame).collect()}
    want = classes_slowly(docs)
    assert got == want
    assert len(set(want.values())) > 200  # so there are tens of thousands of pairs that share buckets and no class
    assert sum(seen[1:]) < 2 * len(docs)


def test_ids_with_several_texts(spark):
    rng = random.Random(2)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))
    one, two, three = text(), text(), text()
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " words"), (4, three), (4, three), (5, three + " x")]
    frame = ship_package(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["node"]: r["class_id"] for r in near_dedup.duplicate_classes(frame).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    kept = sorted((r["doc_id"], r["text"]) for r in near_dedup.keep_one_of_each(frame).collect())
    assert kept == sorted([(1, one), (1, two), (4, three)])

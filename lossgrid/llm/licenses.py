"""Licence scan: TF-IDF cosine of a file's lines to licence templates, and inheritance from ancestor directories.

Every line of a file (and every run of lines that a template spans) is compared with short templates, and the words from
the first line of a licence on with the licences' whole texts (``license_texts``).  A file whose
text is hardly more than a licence is the licence file of its directory; files without a licence of their own take the
one of the nearest directory above that has such a file, found by joining on each ancestor path.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib.resources import files as packaged

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, text_of, written

#: Short forms under which licences are declared (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved. Confidential and proprietary. Unauthorized copying is strictly prohibited."),
    ("Proprietary", "All rights reserved."),
)

#: The bare reservation stands beside real licences too, so it counts only where a file declares no other.
RESERVED = len(TEMPLATES) - 1

#: Least cosine of a line to a template; least share of a file's words in licence lines to make it a licence file.
COSINE, FILE_SHARE = 0.75, 0.6

_TERM = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_PART = re.compile(r"[.,;](?:\s+|$)")

Vector = dict[str, float]


def terms(text: str) -> list[str]:
    """Words and version numbers, in small letters."""
    return _TERM.findall(text.lower())


@cache
def whole_texts() -> tuple[tuple[str, str], ...]:
    """Whole licences by name; read where the templates are built, on the driver."""
    found = packaged("lossgrid.llm").joinpath("license_texts")
    texts = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in found.iterdir() if f.name.endswith(".txt")}
    # the Affero licence is the GPL's text but for the name, half of the preamble and section 13
    texts["AGPL-3.0"] = re.sub(r"(?i)\bGNU (?=General)", "GNU Affero ", texts["GPL-3.0"])
    return tuple(sorted(texts.items()))


def vocabulary() -> list[str]:
    """Terms of the templates: a fixed number, whatever the corpus."""
    return sorted({t for _, text in (*TEMPLATES, *whole_texts()) for t in terms(text)})


class Templates:
    """Template vectors under the corpus's inverse document frequencies.

    A term outside the templates weighs as much as one that no document has; only its count matters to a cosine.
    """

    def __init__(self, documents: int, found: dict[str, int]):
        self.top = math.log(1 + documents) + 1
        self.weight = {t: math.log((1 + documents) / (1 + found.get(t, 0))) + 1 for t in vocabulary()}
        self.vectors = []
        for name, text in TEMPLATES:
            vector = {t: n * self.weight[t] for t, n in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in vector.values()))
            self.vectors.append((name, {t: w / norm for t, w in vector.items()}, len(terms(text))))
        self.of_term: dict[str, list[int]] = {}
        for k, (_, vector, _) in enumerate(self.vectors):
            for t in vector:
                self.of_term.setdefault(t, []).append(k)
        self.number = {t: k for k, t in enumerate(self.weight)}
        self.weights = np.array([*self.weight.values(), self.top])  # the last one is for all other terms
        self.whole = []
        for name, text in whole_texts():
            found = [self.number[t] for t in terms(text)]
            vector = np.bincount(found, minlength=len(self.weights)) * self.weights
            self.whole.append((name, vector / math.sqrt(vector @ vector), len(found)))

    def whole_licenses(self, lines: list[tuple[str, list[str]]]) -> list[tuple[float, str, int, int]]:
        """Cosine, name, first and last word (exclusive) of the whole licences in a text, none within another.

        From every line with a hint on, as many words as a licence has are compared with it.  ``most`` is never below the
        cosine (squares of counts are at least the counts), so only windows that can be a licence are counted out.
        """
        words = [t for _, ts in lines for t in ts]
        starts = np.cumsum([0, *(len(ts) for _, ts in lines)])
        starts = np.array([at for at, (line, _) in zip(starts, lines) if _may_declare(line)], dtype=np.int64)
        known, other = np.array([self.number.get(t, -1) for t in words]), len(self.number)
        known[known < 0] = other
        sums = np.concatenate([[0.0], np.cumsum(self.weights[known] ** 2)])
        found: list[tuple[float, str, int, int]] = []
        ends, likely = {}, {}
        for name, vector, n in self.whole:
            ends[name] = np.minimum(starts + n, len(words))
            dots = np.concatenate([[0.0], np.cumsum((self.weights * vector)[known])])
            most = (dots[ends[name]] - dots[starts]) / np.sqrt(np.maximum(sums[ends[name]] - sums[starts], 1e-9))
            likely[name] = most >= COSINE
        done = 0
        for k, start in enumerate(starts):
            if start < done:
                continue
            best = (0.0, "", 0, 0)
            for name, vector, _ in self.whole:
                if likely[name][k]:
                    end = int(ends[name][k])
                    best = max(best, (self._cosine(words[start:end], vector), name, int(start), end), key=lambda x: x[0])
            if best[0] >= COSINE:
                found.append(best)
                done = best[3]
        return found

    def _cosine(self, words: list[str], vector: np.ndarray) -> float:
        norm = dot = 0.0
        for t, n in Counter(words).items():
            weight = n * self.weight.get(t, self.top)
            norm += weight * weight
            if t in self.number:
                dot += weight * vector[self.number[t]]
        return float(dot / math.sqrt(norm))

    def best(self, found: list[str]) -> tuple[float, str]:
        """Highest cosine to a template and its licence; of equal ones the first template."""
        cosine, k = self.nearest(found)
        return cosine, self.vectors[k][0] if cosine else ""

    def nearest(self, found: list[str]) -> tuple[float, int]:
        counts = Counter(found)
        norm, dots = 0.0, [0.0] * len(self.vectors)
        for t, n in counts.items():
            weight = n * self.weight.get(t, self.top)
            norm += weight * weight
            for k in self.of_term.get(t, ()):
                dots[k] += weight * self.vectors[k][1][t]
        if not norm:
            return 0.0, 0
        k = max(range(len(dots)), key=lambda i: (dots[i], -i))
        return dots[k] / math.sqrt(norm), k

    def scan(self, text: str) -> tuple[str, float, float]:
        """Licence, its cosine and the share of the text's words in lines with a licence ("" and zeros if none).

        A licence begins in a line with one of ``HINTS``.  Such a line is taken alone and, as long templates wrap, in
        runs with the lines after it, up to twice the longest template; lines of a whole licence are not taken again.  "All rights reserved" is also found as a part of
        a line, beside the holder's name.
        """
        if not _may_declare(text):
            return "", 0.0, 0.0
        lines = [(x, t) for x in text.split("\n") if (t := terms(x))]
        longest = max(n for *_, n in self.vectors)
        best, covered = (False, 0.0, ""), [False] * len(lines)
        words = sum(len(t) for _, t in lines)
        whole, at, inside = np.zeros(words, dtype=bool), 0, []
        for cosine, name, start, end in self.whole_licenses(lines):
            whole[start:end] = True
            best = max(best, (True, cosine, name), key=lambda x: x[:2])
        for _, t in lines:
            inside.append(bool(whole[at : at + len(t)].all()))
            at += len(t)
        for i, (line, _) in enumerate(lines):
            if inside[i] or not _may_declare(line):
                continue
            run: list[str] = []
            for j in range(i, len(lines)):
                run = run + lines[j][1]
                if j > i and len(run) > 2 * longest:
                    break
                cosine, k = self.nearest(run)
                if cosine >= COSINE:
                    covered[i : j + 1] = [True] * (j + 1 - i)
                    best = max(best, (k != RESERVED, cosine, self.vectors[k][0]), key=lambda x: x[:2])
            if "rights reserved" in line.lower():
                for part in _PART.split(line):
                    cosine, k = self.nearest(terms(part))
                    if k == RESERVED and cosine >= COSINE:
                        covered[i] = True
                        best = max(best, (False, cosine, self.vectors[k][0]), key=lambda x: x[:2])
        _, cosine, name = best
        if not name:
            return "", 0.0, 0.0
        whole |= np.repeat(covered, [len(t) for _, t in lines])
        return name, cosine, float(whole.sum() / words)


#: One of these is in the first line of every licence (fixed values).
HINTS = (
    "licens", "licenc", "permission", "redistribution", "free software", "source code", "copyright", "rights reserved",
    "unencumbered",
)


def _may_declare(text: str) -> bool:
    lowered = text.lower()
    return any(hint in lowered for hint in HINTS)


def term_frequencies(files: DataFrame, text_col: str = "text") -> tuple[int, dict[str, int]]:
    """Number of files, and how many files hold each template term: counted over all of them, summed by task."""
    known = frozenset(vocabulary())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, found = 0, Counter()
        for batch in batches:
            files += len(batch)
            for text in batch["text"]:
                found.update(known.intersection(terms(text)))
        yield pd.DataFrame({"term": ["", *found], "n": [files, *found.values()]})

    counted = files.select(text_of(text_col).alias("text")).mapInPandas(count, "term string, n bigint")
    rows = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return rows.pop("", 0), rows


def ancestors(path: Column) -> Column:
    """Directories above a path, nearest first, down to the root (empty path)."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), F.size(parts) - k), "/")
    )


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``files`` with ``license``, ``origin`` (own, inherited or none), ``license_dir`` and ``cosine``.

    ``files`` has a path of parts joined by ``/``.  Of several licence files in a directory the one of highest cosine
    counts, of equal ones the licence first in the alphabet.  A null path is the root's own file, a null text empty.
    Repeated rows get equal results; columns of the four names are replaced, ``path_col`` and others pass through.
    """
    model = files.sparkSession.sparkContext.broadcast(Templates(*term_frequencies(files, text_col)))

    @F.pandas_udf("struct<license:string,cosine:double,share:double>")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = [model.value.scan(text) for text in texts]
        return pd.DataFrame(rows, columns=["license", "cosine", "share"])

    own = [c for c in files.columns if c.lower() not in ("license", "origin", "license_dir", "cosine", text_col.lower())]
    rows = files.select(
        F.struct(*[col(c) for c in own]).alias("d"),
        F.coalesce(col(path_col).cast("string"), F.lit("")).alias("path"),
        scanned(text_of(text_col)).alias("s"),
    )
    rows = written(rows, "licenses").withColumn("up", ancestors(F.col("path")))
    declared = (
        rows.where((F.col("s.license") != "") & (F.col("s.share") >= FILE_SHARE))
        .groupBy(F.get("up", F.lit(0)).alias("dir"))
        .agg(F.min_by(F.struct("s.license", "s.cosine"), F.struct(-F.col("s.cosine"), "s.license")).alias("l"))
    )
    # every directory asks for its nearest licence once, however many files it holds
    asked = rows.where(F.col("s.license") == "").select(F.get("up", F.lit(0)).alias("of"), "up").distinct()
    nearest = (
        asked.select("of", F.posexplode("up").alias("far", "dir"))
        .join(declared, "dir")
        .groupBy("of")
        .agg(F.min_by(F.struct(F.col("dir"), "l"), "far").alias("from"))
    )
    found = rows.withColumn("of", F.get("up", F.lit(0))).join(nearest, "of", "left")
    mine = F.col("s.license") != ""
    return found.select(
        "d.*",
        F.when(mine, F.col("s.license")).otherwise(F.coalesce("from.l.license", F.lit(""))).alias("license"),
        F.when(mine, "own").when(F.col("from").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("of")).otherwise(F.coalesce("from.dir", F.lit(""))).alias("license_dir"),
        F.when(mine, F.col("s.cosine")).otherwise(F.coalesce("from.l.cosine", F.lit(0.0))).alias("cosine"),
    )

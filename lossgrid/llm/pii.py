"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The patterns give the base spans, which always stay.  The field reads the surroundings of every digit, ``@``, spelled
"dot" and bracketed "at": candidate segments of bounded length are scored as wholes for each kind, and dynamic programming chooses
boundaries and kinds together.  It learns from the base spans of the corpus and from rewritten copies of them.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, free_names, text_of

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int, str]

# ---------------------------------------------------------------- base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always begins where a run of digits does, so later starts within the run need no try
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost matches per kind without overlap; a match that fails its check is dropped, not retried."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            out.append((start, free := domain.end(), "email"))
        at = text.find("@", at + 1)
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(map(_octet, m.group().split("."))):
                out.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = _NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                out.append((*m.span(), "phone"))
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# ---------------------------------------------------------------- candidate segments

#: Longest segment, in pieces and characters; characters read on both sides of a trigger.
MAX_PIECES, MAX_CHARS, AROUND = 16, 80, 80

_TRIGGER = re.compile(r"[0-9@]|\b[dD][oO][tT]\b|[\[(] ?[aA][tT] ?[\])]")
_PIECE = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)
_NUMBER = re.compile(r"\+?[0-9()\[\]. /-]*")
_AT = re.compile(r"@|\s*[\[(]\s*at\s*[\])]\s*|\s+at\s+", re.IGNORECASE)
_DOT = re.compile(r"\.|\s*[\[(]\s*dot\s*[\])]\s*|\s+dot\s+", re.IGNORECASE)
_MAIL = re.compile(
    rf"[A-Za-z0-9._%+-]+(?:{_AT.pattern})[A-Za-z0-9-]+(?:(?:{_DOT.pattern})[A-Za-z0-9-]+)+", re.IGNORECASE
)
#: Words before a span that hint at its kind (fixed values).
CUES = {
    "email": ("email", "mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "amex"), "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
}
_CUE = {word: kind for kind, words in CUES.items() for word in words}


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around triggers, joined where they meet."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        start, end = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, form)`` of the segments that may be entities; form is ``number`` or ``mail``."""
    out = []
    pieces = [m.span() for m in _PIECE.finditer(text)]
    for i, (start, first_end) in enumerate(pieces):
        lead = text[start]
        if start and (text[start - 1].isalnum() or text[start - 1] in "@_"):
            continue
        if lead in "+(" or lead.isdigit():
            for _, end in pieces[i : i + MAX_PIECES]:
                if end - start > MAX_CHARS or not _NUMBER.fullmatch(text, start, end):
                    break
                if text[end - 1].isdigit() and not (end < len(text) and text[end].isalnum()):
                    if sum(c.isdigit() for c in text[start:end]) >= 4 and end > first_end:
                        out.append((start, end, "number"))
                    elif end - start >= 7:
                        out.append((start, end, "number"))
        if lead.isalnum():
            m = _MAIL.match(text, start, min(len(text), start + MAX_CHARS))
            if m and not (m.end() < len(text) and text[m.end()].isalnum()):
                out.append((start, m.end(), "mail"))
    return out


def span_features(text: str, start: int, end: int, form: str) -> list[str]:
    """Features of a whole segment and its surroundings."""
    span = text[start:end]
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 24) : start])[-1:]
    out = [form]
    if before and before[0].lower() in _CUE:
        out.append("cue=" + _CUE[before[0].lower()])
    if start and text[start - 1] in "+.-/=\"#":
        out.append("joined")
    if end < len(text) and text[end] in "@-/=\"" or text[end : end + 1] == "." and text[end + 1 : end + 2].isdigit():
        out.append("goes on")
    if form == "mail":
        out.append("sign" if "@" in span else "spelled")
        if re.search(r"[A-Za-z]{2,}$", span):
            out.append("letters last")
        if _DOT.sub("", span) != span.replace(".", ""):
            out.append("dot spelled")
        return out
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    seps = set(re.sub("[0-9]", "", span.lstrip("+")))
    out += [f"digits={min(len(digits), 20)}", "sizes=" + "-".join(str(min(len(g), 20)) for g in groups[:8])]
    out += ["seps=" + "".join(sorted(seps))]
    out.append("plus" if span[0] == "+" else "no plus")
    if len(digits) >= 12:
        out.append("checks" if luhn(digits) else "does not check")
    if len(groups) == 4 and "." in seps and not seps - set(".[]"):
        out.append("octets" if all(map(_octet, groups)) else "no octets")
    if span.count("(") != span.count(")") or span.count("[") != span.count("]"):
        out.append("open bracket")
    return out


# ---------------------------------------------------------------- the field

Weights = dict[tuple[str, str], float]


class Field:
    """Semi-Markov field over a region: pieces outside entities cost nothing, segments score by their features."""

    def __init__(self, weights: Weights):
        self.weights = weights

    def segments(self, text: str):
        """Candidates by their end: start, kind, features and score."""
        by_end = defaultdict(list)
        for start, end, form in candidates(text):
            features = span_features(text, start, end, form)
            for kind in KINDS:
                if (kind == "email") == (form == "mail"):
                    score = sum(self.weights.get((kind, f), 0.0) for f in features)
                    by_end[end].append((start, kind, features, score))
        return by_end

    def best(self, text: str) -> list[Span]:
        """Segmentation of highest score."""
        by_end = self.segments(text)
        if not by_end:
            return []
        score, back = [0.0] * (len(text) + 1), [None] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            score[end] = score[end - 1]
            for start, kind, _, own in by_end.get(end, ()):
                if score[start] + own > score[end]:
                    score[end], back[end] = score[start] + own, (start, kind)
        out, end = [], len(text)
        while end:
            if back[end] is None:
                end -= 1
            else:
                out.append((back[end][0], end, back[end][1]))
                end = back[end][0]
        return out[::-1]

    def slope(self, text: str, truth: set[Span]) -> Weights:
        """Gradient of the log-likelihood: observed features less those expected under the field."""
        by_end = self.segments(text)
        n = len(text)
        forward, backward = np.zeros(n + 1), np.zeros(n + 1)
        for end in range(1, n + 1):
            forward[end] = forward[end - 1]
            for start, _, _, own in by_end.get(end, ()):
                forward[end] = np.logaddexp(forward[end], forward[start] + own)
        by_start = defaultdict(list)
        for end, found in by_end.items():
            for start, *_, own in found:
                by_start[start].append((end, own))
        for start in range(n - 1, -1, -1):
            backward[start] = backward[start + 1]
            for end, own in by_start.get(start, ()):
                backward[start] = np.logaddexp(backward[start], own + backward[end])
        out: Weights = defaultdict(float)
        for end, found in by_end.items():
            for start, kind, features, own in found:
                pull = float((start, end, kind) in truth) - math.exp(forward[start] + own + backward[end] - forward[n])
                if abs(pull) > 1e-4:
                    for f in features:
                        out[kind, f] += pull
        return out


def rewritten(span: str, kind: str) -> list[str]:
    """Other ways to write an entity."""
    digits = _NO_DIGIT.sub("", span)
    if kind == "email":
        local, _, domain = span.partition("@")
        return [
            f"{local} at {domain.replace('.', ' dot ')}",
            f"{local} [at] {domain.replace('.', ' [dot] ')}",
            f"{local}(at){domain}",
        ]
    if kind == "ip":
        return [span.replace(".", "[.]")]
    if kind == "card":
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(groups), " - ".join(groups), "/".join(groups)]
    local = digits[-10:]
    return [
        f"({local[:3]}) {local[3:6]}-{local[6:]}",
        f"{local[:3]}-{local[3:6]}-{local[6:]}",
        f"{local[:3]}.{local[3:6]}.{local[6:]}",
        f"00{digits[:-10]} {local[:3]} {local[3:6]} {local[6:]}",
    ]


#: Numbers that are nobody's (fixed values), set into regions as counter-examples.
HARMLESS = ("2024-01-15", "12/31/1999", "3.14159", "1999 2000 2001", "1.234.567,89", "10 000 000", "v2.4.1", "0.5-1.5",
            "555", "1234567890123", "978-3-16-148410-0", "12:30:45")


def examples(text: str) -> list[tuple[str, set[Span]]]:
    """A region with its base spans, copies with each span rewritten, and one with a harmless number instead."""
    spans = base_spans(text)
    if any(a[1] > b[0] for a, b in zip(spans, spans[1:])):
        return []
    out = [(text, set(spans))]
    for k, (start, end, kind) in enumerate(spans):
        near = (text[max(0, start - 40) : start], text[end : end + 40])
        for form in rewritten(text[start:end], kind):
            made = near[0] + form + near[1]
            truth = {(len(near[0]), len(near[0]) + len(form), kind)}
            truth |= {s for s in base_spans(made) if s[1] <= len(near[0]) or s[0] >= len(near[0]) + len(form)}
            out.append((made, truth))
        harmless = HARMLESS[(start + k) % len(HARMLESS)]
        made = near[0] + harmless + near[1]
        out.append((made, set(base_spans(made))))
    return out


def fit_field(texts: list[str], epochs: int = 4, pace: float = 0.5, shrink: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic gradients over the examples of the regions."""
    field = Field(defaultdict(float))
    made = [e for t in texts for e in examples(t)]
    order, squares = np.arange(len(made)), defaultdict(lambda: 1.0)
    shuffle = np.random.default_rng(0)
    for _ in range(epochs):
        shuffle.shuffle(order)
        for k in order:
            for key, g in field.slope(*made[k]).items():
                g -= shrink * field.weights[key]
                squares[key] += g * g
                field.weights[key] += pace * g / math.sqrt(squares[key])
    field.weights = {k: w for k, w in field.weights.items() if w}
    return field


#: Different regions the field is fitted on at most, in the order of a hash of their text.
SAMPLE_REGIONS = 1_500


def fit(docs: DataFrame, text_col: str = "text", sample_regions: int = SAMPLE_REGIONS) -> Field:
    """The field of a corpus, learnt from at most ``sample_regions`` regions; one that adds nothing if there are none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [t[a:b] for t in batch["text"] if t for a, b in regions(t) if b - a <= 8 * AROUND]
            yield pd.DataFrame({"region": pd.Series(found, dtype=object)})

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        field = fit_field(sorted(rows["region"]))
        keys = sorted(field.weights)
        return pd.DataFrame({
            "kind": [k for k, _ in keys], "feature": [f for _, f in keys], "weight": [field.weights[k] for k in keys]
        })

    some = (
        docs.select(text_of(text_col).alias("text"))
        .where(F.col("text").rlike(r"[0-9@]"))
        .mapInPandas(cut, "region string")
        .distinct()
        .orderBy(F.xxhash64("region"), "region")
        .limit(sample_regions)
    )
    rows = some.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        train, "kind string, feature string, weight double"
    )
    return Field({(r["kind"], r["feature"]): r["weight"] for r in rows.collect()})


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """What the field finds beyond the base spans, never across one."""
    out = []
    for a, b in regions(text):
        for start, end, kind in field.best(text[a:b]):
            if all(end + a <= s or start + a >= e for s, e, _ in base if s < b and e > a):
                out.append((start + a, end + a, kind))
    return out


def find_personal_data(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``, arrays of (start, end, kind) in code points (replaced if present).

    Null and empty texts hold nothing.  Rows are independent: repeated rows get the same spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    (work,) = free_names(docs, "_spans")
    kind = "array<struct<start:bigint,end:bigint,kind:string>>"

    @F.pandas_udf(f"struct<base:{kind},added:{kind}>")
    def found(texts: pd.Series) -> pd.DataFrame:
        field, rows = shared.value, []
        for text in texts:
            base, more = [], []
            if _TRIGGER.search(text):
                base = base_spans(text)
                more = in_order(added_spans(text, base, field))
            rows.append([[{"start": a, "end": b, "kind": k} for a, b, k in part] for part in (base, more)])
        return pd.DataFrame(rows, columns=["base", "added"])

    kept = [col(c) for c in docs.columns if c.lower() not in ("base", "added")]
    return docs.withColumn(work, found(text_of(text_col))).select(*kept, f"{work}.base", f"{work}.added")


def personal_data_digests(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, base counts by kind, the digest of the base spans and the list of all spans."""
    spans = find_personal_data(docs.select("doc_id", "text"), field)
    rank = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def joined(of):
        return F.array_join(
            F.transform(of, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ","
        )

    merged = F.transform(
        F.array_sort(
            F.transform(
                F.concat("base", "added"), lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"])
            )
        ),
        lambda s: F.struct(s["start"], s["end"], s["kind"]),
    )
    return spans.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined(merged).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )

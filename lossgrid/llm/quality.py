"""Line-first quality rules with DataFrame functions only: no row leaves its document, so nothing is shuffled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import SPACE_RUN, SPACES, col, text_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of the document verdict."""

    #: more symbols than this share of a line's word characters
    symbol_share: float = 0.1
    #: separators of a menu, and how many of them a menu line has at least
    separators: str = "|»›•·"
    min_separators: int = 3
    #: a line all in capitals, of at least so many word characters
    shouted_chars: int = 20
    #: a line of at least so many words with no sentence mark at all
    unpunctuated_words: int = 40
    marks: str = ".!?;:…。！？"
    #: phrases of notices and page furniture
    boilerplate: tuple[str, ...] = (
        "lorem ipsum",
        "javascript",
        "accept cookies",
        "cookie policy",
        "privacy policy",
        "terms of use",
        "terms of service",
        "all rights reserved",
        "click here",
        "subscribe to our newsletter",
        "skip to content",
    )
    #: a document is rejected when the removed lines hold more than this share of its words
    lost_share: float = 0.3


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    """Words of a text without building them: each is counted at its first character."""
    return F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]"))


def line_fails(line: Column, rules: Rules) -> Column:
    """True when a line is furniture rather than prose."""
    solid = F.length(F.translate(line, SPACES, ""))
    lowered = F.lower(line)
    symbols = F.regexp_count(line, F.lit(f"[{SYMBOLS}]"))
    menu = F.regexp_count(line, F.lit(f"[{rules.separators}]"))
    fails = (
        ((symbols > 0) & (symbols > rules.symbol_share * solid))
        | (menu >= rules.min_separators)
        | ((F.upper(line) == line) & (lowered != line) & (solid >= rules.shouted_chars))
        | (~line.rlike(f"[{rules.marks}]") & (n_words_of(line) >= rules.unpunctuated_words))
    )
    for phrase in rules.boilerplate:
        fails = fails | lowered.contains(phrase)
    return fails


def window_hashes(words: Column, width: int) -> Column:
    """A hash of every window of ``width`` words; null below ``width`` words."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)])
    )
    return F.when(F.size(words) >= width, hashes)


def sorted_windows(words: Column, width: int) -> Column:
    """Windows of ``width`` words with their positions, equal ones side by side."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(width)]).alias("w"), i.alias("i")),
    )
    return F.array_sort(windows)


def words_in_repeats(windows: Column, width: int) -> Column:
    """How many words lie in a window that is found twice or more; ``windows`` is sorted, or null if all differ."""

    def window(k: Column) -> Column:
        return F.coalesce(F.get(windows, k)["w"], F.lit(""))  # windows are never empty

    twins = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size(windows) - 1),
            lambda k: F.when(
                (window(k) == window(k - 1)) | (window(k) == window(k + 1)), F.get(windows, k)["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.array_distinct(F.flatten(F.transform(twins, lambda i: F.array(*[i + k for k in range(width)]))))
    return F.when(windows.isNull(), F.lit(0)).otherwise(F.size(covered))


OUTPUTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept",
)


def score_quality(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """``docs`` with ``OUTPUTS`` (replaced if ``docs`` has such columns).

    Null and empty texts have no words and fail.  Every row is judged alone: repeated rows get the same result, other
    columns pass through, an empty table stays empty.
    """
    passed = [col(c) for c in docs.columns if c.lower() not in OUTPUTS]
    rows = docs.select(F.struct(*passed).alias("d") if passed else F.lit(None).alias("d"), text_of(text_col).alias("t"))
    rows = rows.withColumn("words", words_of(F.col("t")))
    # most texts repeat no window: different hashes prove that, and only the others are sorted
    rows = rows.withColumn("hashes", window_hashes(F.col("words"), 3))
    rows = rows.withColumn("repeats", F.size(F.array_distinct("hashes")) < F.size("hashes"))
    rows = rows.withColumn("windows", F.when(F.col("repeats"), sorted_windows(F.col("words"), 3)))
    rows = rows.withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    lost = F.aggregate(
        F.filter("lines", lambda x: line_fails(x, rules)), F.lit(0), lambda total, x: total + n_words_of(x)
    )
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.translate("t", SPACES, "")),
        "n_symbols": F.length("t") - F.length(F.translate("t", SYMBOLS, "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": words_in_repeats(F.col("windows"), 3),
        "lost_words": lost,
    }
    scored = rows.select("d.*", *[c.cast("long").alias(name) for name, c in counts.items()])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("lost_words") <= rules.lost_share * F.col("n_words"))
    )


def _sql_in(chars: str) -> str:
    return "'" + chars.replace("'", "''") + "'"


def _sql(rules: Rules = Rules()) -> str:
    space = r"[\x20\x09-\x0D]+"
    solid = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in rules.boilerplate)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{space}'), lambda w: w <> '') AS words FROM docs),
placed AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT *, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS win FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM windows),
hit AS (
  SELECT doc_id, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS inside
  FROM twice WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeats AS (SELECT doc_id, count(*) FILTER (WHERE inside) AS n_repeat_words FROM hit GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, len(list_filter(regexp_split_to_array(line, '{space}'), lambda w: w <> '')) AS line_words,
    length(translate(line, {solid}, '')) AS solid,
    length(line) - length(translate(line, '{SYMBOLS}', '')) AS symbols,
    length(line) - length(translate(line, {_sql_in(rules.separators)}, '')) AS menu,
    upper(line) = line AND lower(line) <> line AND strpos(line, 'ß') = 0 AS shouted,
    length(line) = length(translate(line, {_sql_in(rules.marks)}, '')) AS unmarked
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)),
judged AS (
  SELECT doc_id, count(*) FILTER (WHERE solid > 0) - count(DISTINCT line) FILTER (WHERE solid > 0) AS n_dup_lines,
    coalesce(sum(line_words) FILTER (WHERE symbols > {rules.symbol_share} * solid OR menu >= {rules.min_separators}
      OR (shouted AND solid >= {rules.shouted_chars})
      OR (unmarked AND line_words >= {rules.unpunctuated_words}) OR {phrases}), 0) AS lost_words
  FROM lines GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(translate(t, {solid}, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(lost_words AS BIGINT) AS lost_words
  FROM split s JOIN judged USING (doc_id) LEFT JOIN repeats USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_words <= {rules.lost_share} * n_words AS kept
FROM counted
"""


SQL = _sql()

"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: frequent function words of the four languages of the corpus
STOP_WORDS = (
    "a an and are as at be by for from has in is it of on or that the this to was were with "
    "au aux ce de des du elle en est et il la le les leur ne ou par pas pour que qui se son sur un une "
    "auf das dem den der die ein eine für im ist mit nicht sich sie und von zu "
    "como con del el los las lo más no para por se su sus una y"
).split()

SYMBOLS = "#*$%&|<>"
SPACE = r"\x20\x09-\x0D"
WINDOW = 5


class Rule(NamedTuple):
    """A document passes while its metric lies within the bounds; None leaves a side open."""

    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0  # shorter texts are too short for this ratio


# Ratios by the names of ``_ratios``.
RULES = (
    Rule("mean_word_length", 2.0, 15.0),
    Rule("symbol_ratio", None, 0.05),
    Rule("stop_word_ratio", 0.02, None, 50),
    Rule("dup_line_ratio", None, 0.4),
    Rule("bullet_line_ratio", None, 0.9),
)


def _repeated_words(words: Column, hashes: Column, grams: Column) -> Column:
    """Words inside windows found twice or more, from the sorted (window, position) pairs."""
    again = F.filter(grams, lambda g, i: F.coalesce(g["g"] == F.get(grams, i - 1)["g"], F.lit(False))
                     | F.coalesce(g["g"] == F.get(grams, i + 1)["g"], F.lit(False)))
    places = F.sort_array(F.transform(again, lambda g: g["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        places, start,
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"])


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add struct ``_quality`` with the counts of every text; no user function, no shuffle.

    Windows are compared by hash first; only texts in which a hash repeats compare the
    windows themselves, so the counts are exact.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    q = docs.withColumn("_words", F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != ""))
    words = F.col("_words")
    q = q.withColumn("_hashes", F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))))
    hashes = F.col("_hashes")
    twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    q = q.withColumn("_grams", F.when(twice, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, F.lit(WINDOW))).alias("g"), i.alias("i"))))))
    q = q.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    lines, size = F.col("_lines"), F.length(text)
    plain = F.transform(words, lambda w: F.lower(F.rtrim(w, F.lit(".,"))))
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        (size - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("_grams").isNotNull(), _repeated_words(words, hashes, F.col("_grams"))),
                   F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter(plain, lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))).cast("long").alias("n_bullet_lines"),
    )
    return q.withColumn("_quality", counts).drop("_words", "_hashes", "_grams", "_lines")


def _ratios(q: Column) -> dict[str, Column]:
    words, lines = F.greatest(q["n_words"], F.lit(1)), F.greatest(q["n_lines"], F.lit(1))
    return {
        "n_words": q["n_words"],
        "mean_word_length": q["word_chars"] / words,
        "symbol_ratio": q["n_symbols"] / F.greatest(q["word_chars"], F.lit(1)),
        "stop_word_ratio": q["n_stop_words"] / words,
        "dup_line_ratio": q["n_dup_lines"] / lines,
        "bullet_line_ratio": q["n_bullet_lines"] / lines,
    }


def failed_base(q: Column) -> Column:
    return (q["n_words"] < 10) | (F.lit(100) * q["n_repeat_words"] > F.lit(20) * q["n_words"])


def passes(q: Column, rules=RULES) -> Column:
    """The threshold table as one boolean."""
    ratios, ok = _ratios(q), F.lit(True)
    for rule in rules:
        fine = F.lit(True)
        if rule.low is not None:
            fine = fine & (ratios[rule.metric] >= F.lit(rule.low))
        if rule.high is not None:
            fine = fine & (ratios[rule.metric] <= F.lit(rule.high))
        ok = ok & ((q["n_words"] < rule.from_words) | fine)
    return ok


def as_sql(table: str = "documents", rules=RULES) -> str:
    """The same counts and verdict as DuckDB SQL."""
    space = rf"[{SPACE}]"
    ratios = {"mean_word_length": "word_chars / greatest(n_words, 1)",
              "symbol_ratio": "n_symbols / greatest(word_chars, 1)",
              "stop_word_ratio": "n_stop_words / greatest(n_words, 1)",
              "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
              "bullet_line_ratio": "n_bullet_lines / greatest(n_lines, 1)"}
    tests = []
    for r in rules:
        sides = [f"{ratios[r.metric]} >= {r.low}"] * (r.low is not None) + [
            f"{ratios[r.metric]} <= {r.high}"] * (r.high is not None)
        tests.append(f"(n_words < {r.from_words} OR ({' AND '.join(sides)}))")
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines
  FROM {table}),
grams AS (
  SELECT k, i, list_reduce(words[i:i+{WINDOW - 1}], lambda a, b: a || ' ' || b) AS g
  FROM (SELECT k, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
twice AS (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams),
places AS (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM twice WHERE n > 1),
again AS (SELECT k, sum(least({WINDOW}, i - coalesce(before, i - {WINDOW}))) AS n FROM places GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{space}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(words, lambda x: lower(rtrim(x, '.,')) IN ({stops}))) AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet_lines
  FROM w LEFT JOIN again USING (k)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept
FROM v"""


def _counted(docs: DataFrame, *columns) -> DataFrame:
    """The columns and struct ``_counts`` behind a fence.

    The one-element explode keeps Catalyst from pushing a filter on the verdict below the
    projection, which would copy every count into each place of the threshold table that
    names it.
    """
    return measures(docs.select(*columns, "text")).select(
        *[c if isinstance(c, str) else "_row" for c in columns], F.explode(F.array("_quality")).alias("_counts"))


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """Counts and verdict of every document, one row per input row.

    A null or empty text has no words and fails the base rule. Ids may be null or repeat;
    other columns are ignored; an empty table gives no rows.
    """
    q = F.col("_counts")
    return _counted(docs, "doc_id").select(
        "doc_id", q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"),
        q["n_symbols"].alias("n_symbols"), q["n_dup_lines"].alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"), failed_base(q).alias("base_failed"),
        (~failed_base(q) & passes(q, rules)).alias("kept"))


def keep(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with all their columns, whatever their names."""
    q = F.col("_counts")
    counted = _counted(docs, F.struct("*").alias("_row"))
    return counted.filter(~failed_base(q) & passes(q, rules)).select("_row.*")

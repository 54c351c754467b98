"""Quality rules: a threshold table compiled into one Spark projection.

Every statistic is a built-in column expression (no user functions): length,
symbol, stop-word, repeat and line ratios. A document is kept when every rule
of the table holds.

Defined results: a null or empty text has no words, all counts are 0 and it
fails the word-count rule; repeated rows are judged one by one; an empty table
gives no rows; the key is carried as it is (null included) and other columns
are not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import WS_CLASS, whole_text, word_array

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in is it that for on with by are at this be or as was an",
    "fr": "le la les de des du un une et est en que qui dans pour par sur pas au avec",
    "de": "der die das und ist in den von zu mit sich des auf ein eine nicht im dem als auch",
    "es": "el la los las de y en que un una es por con para del se su al lo como",
}


@dataclass(frozen=True)
class Rule:
    """``low <= statistic <= high``; either bound may be absent."""
    name: str
    statistic: str
    low: float | None = None
    high: float | None = None


#: The base rules, which no other rule can overturn.
BASE_RULES = (
    Rule("words", "n_words", low=50),
    Rule("repeats", "repeat_percent", high=50),
)
#: The rules of the method. Ratios are over words or over lines with a word.
RULES = (
    Rule("max_words", "n_words", high=100_000),
    Rule("word_length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_ratio", low=0.08),
    Rule("dup_lines", "dup_line_ratio", high=0.3),
    Rule("line_length", "words_per_line", low=3),
)


def _stop_list() -> list[str]:
    words = {w for text in STOP_WORDS.values() for w in text.split()}
    return sorted(words | {w.capitalize() for w in words})


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the key, the counts and the ratios the rules read."""
    zero = F.lit(0).cast("long")
    df = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    df = df.withColumns({
        "w": word_array(F.col("t")),
        "ls": F.filter(F.split("t", "\n"), lambda line: line.rlike(rf"[^{WS_CLASS}]")),
        "n_symbols": F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("long"),
    })
    n = F.size("w")
    df = df.select(
        "doc_id", "w", "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: x.isin(_stop_list()))).cast("long").alias("n_stop"),
        F.when(n >= 3, F.slice(F.transform(
            "w", lambda x, i: F.concat_ws(" ", x, F.get("w", i + 1), F.get("w", i + 2))), F.lit(1), n - 2))
        .otherwise(F.array().cast("array<string>")).alias("win"))
    # Only a text with an equal pair of windows is sorted: (window, position) in
    # window order puts equal windows side by side.
    pairs = F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.withColumn("s", F.when(F.size(F.array_distinct("win")) < F.size("win"), pairs))
    twice = F.filter("s", lambda e, j: (e["x"] == F.get("s", j + 1)["x"])
                     | ((j > 0) & (e["x"] == F.get("s", F.greatest(j - 1, F.lit(0)))["x"])))
    df = df.withColumn("p", F.sort_array(F.transform(twice, lambda e: e["i"])))
    # A repeated window at p covers p, p+1, p+2; the next one covers what is left of it.
    covered = F.aggregate(F.transform("p", lambda p, j: F.least(
        F.lit(3), F.coalesce(F.get("p", j + 1) - p, F.lit(3)))), zero, lambda acc, x: acc + x)
    words, lines = F.nullif("n_words", F.lit(0)), F.nullif("n_lines", F.lit(0))
    return df.withColumn("n_repeat_words", F.coalesce(covered, zero)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop", "n_lines",
        (F.col("n_repeat_words") * 100 / words).alias("repeat_percent"),
        (F.col("word_chars") / words).alias("mean_word_chars"),
        (F.col("n_symbols") / words).alias("symbol_ratio"),
        (F.col("n_stop") / words).alias("stop_ratio"),
        (F.col("n_dup_lines") / lines).alias("dup_line_ratio"),
        (F.col("n_words") / lines).alias("words_per_line"))


def broken(rule: Rule) -> Column:
    """True where the rule is broken; a statistic without a value breaks nothing."""
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (F.col(rule.statistic) < F.lit(rule.low))
    if rule.high is not None:
        bad = bad | (F.col(rule.statistic) > F.lit(rule.high))
    return F.coalesce(bad, F.lit(False))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Judge every document by the threshold table: the statistics,
    ``base_failed``, ``kept`` and ``failed`` (names of the broken rules)."""
    df = statistics(docs, id_col, text_col)
    df = df.withColumn("base_failed", F.greatest(*[broken(r) for r in base], F.lit(False)))
    df = df.withColumn("failed", F.concat_ws(",", *[F.when(broken(r), F.lit(r.name)) for r in (*base, *rules)]))
    return df.withColumn("kept", F.col("failed") == "")

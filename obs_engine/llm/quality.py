"""Quality rules: a table of thresholds compiled into one projection.

Counts come from whole texts by built-in functions. Each rule names a ratio and the range
it may have; a text is kept if it passes the base rules and every rule of the table.

Defined results: null text counts as empty, so it has no words and fails the base rules; a
ratio without a denominator is zero; repeated rows are judged each by itself; an empty
table gives no rows. Words of one text are compared in windows by 64-bit hashes, by
sorting, so a text of n words takes n log n steps.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import column

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# Frequent words of the four languages.
STOP_WORDS = (
    "the of and to in is that it for on with as was at by this be are from or an "
    "le la les de des du et en un une est que qui dans pour par sur au avec ne "
    "der die das und den von zu mit ist nicht ein eine im dem auf für des sich "
    "el los las y que del se por con para una es al lo como su"
).split()


class Rule(NamedTuple):
    ratio: str
    low: float | None
    high: float | None


RULES = (
    Rule("chars_per_word", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("shouts_per_word", None, 0.3),
    Rule("stop_word_share", 0.02, None),
    Rule("duplicate_line_share", None, 0.5),
    Rule("bullet_line_share", None, 0.9),
    Rule("ellipsis_line_share", None, 0.3),
)


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "bullet_line_share": ("n_bullet_lines", "n_lines"),
    "ellipsis_line_share": ("n_ellipsis_lines", "n_lines"),
}


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def text_counts(rows: DataFrame) -> DataFrame:
    """Counts of the column ``text`` beside the column ``row``."""
    stop = [w for word in STOP_WORDS for w in (word, word.capitalize())]
    parts = rows.select(
        "row",
        "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    windows = parts.select(
        "*",
        F.when(
            F.size("words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 3),
                lambda i: F.xxhash64(
                    F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)
                ),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # Only texts that repeat a window have theirs sorted, together with their places.
    placed = F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    )
    ordered = windows.select(
        "*",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).alias("ordered"),
    )
    repeated = F.filter(
        "ordered",
        lambda w, i: (w["hash"] == F.get("ordered", i - 1)["hash"])
        | (w["hash"] == F.get("ordered", i + 1)["hash"]),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(repeated, lambda w: F.array(w["at"], w["at"] + 1, w["at"] + 2)))
    )
    matching = lambda pattern: _size(F.filter("lines", lambda x: x.rlike(pattern)))
    return ordered.select(
        "row",
        _size(F.col("words")).alias("n_words"),
        _length_without(F.col("text"), SPACE).alias("word_chars"),
        _length_without(F.col("text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _length_without(F.col("text"), r"[^!]+").alias("n_shouts"),
        _size(F.filter("words", lambda w: w.isin(stop))).alias("n_stop_words"),
        _size(F.col("lines")).alias("n_lines"),
        (_size(F.col("lines")) - _size(F.array_distinct("lines"))).alias("n_dup_lines"),
        matching(r"^[\x20\x09-\x0D]*[-*•]").alias("n_bullet_lines"),
        matching(r"(\.\.\.|…)[\x20\x09-\x0D]*$").alias("n_ellipsis_lines"),
        F.when(F.col("ordered").isNull(), F.lit(0).cast("long"))
        .otherwise(_size(covered))
        .alias("n_repeat_words"),
    )


def compiled(rules: tuple[Rule, ...]) -> Column:
    """Whether all rules hold."""
    holds = F.lit(True)
    for rule in rules:
        ratio = _share(*RATIOS[rule.ratio])
        if rule.low is not None:
            holds = holds & (ratio >= F.lit(float(rule.low)))
        if rule.high is not None:
            holds = holds & (ratio <= F.lit(float(rule.high)))
    return holds


def judge(
    df: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``row`` (all columns of ``df``), the counts, ``base_failed`` and ``kept``."""
    counts = text_counts(
        df.select(
            F.struct(*[column(df, c) for c in df.columns]).alias("row"),
            F.coalesce(column(df, text_column), F.lit("")).alias("text"),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return counts.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & compiled(rules)
    )


def keep_good(
    df: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The rows of ``df`` that pass, all columns as they were."""
    # The number keeps the filter above the counts: pushed below, it would repeat them.
    judged = judge(df, text_column, rules).withColumn("number", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("number") >= 0)).select("row.*")

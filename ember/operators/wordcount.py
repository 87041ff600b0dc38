"""Word counting.

Tokens are produced by JVM regular expressions and exploded; counting is a partial + final aggregate, so every map task
collapses its own copies of a hot word before the shuffle.

Unicode NFD (the reference's normal form) is applied *after* a first count,
to the distinct words only, then counts of words with the same NFD are
summed: each distinct word is normalised once, not each occurrence, and in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fmt import word_count_line
from ..functions.text import locale_tokens, normal_form, split_raw
from .partitioning import spread


def words(df: DataFrame, text: str = "text", repartition: int | None = None) -> DataFrame:
    """One row per word occurrence (``word``). Input with fewer partitions
    than the cluster's cores (few large files) is spread over ``repartition``
    (default: all cores) tasks before tokenising."""
    src = spread(df.select(text), repartition)
    return (src.select(F.explode(split_raw(F.col(text))).alias("word"))
            .where(F.col("word") != ""))


def _normalise(counts: DataFrame, form: str) -> DataFrame:
    """Counts by normal form, summed over the words that share one."""
    return (counts.select(normal_form(F.col("word"), form).alias("word"), "count")
            .groupBy("word").agg(F.sum("count").alias("count")))


def word_count(df: DataFrame, text: str = "text", normalise: bool | str = True,
               repartition: int | None = None) -> DataFrame:
    """``word, count`` over lower-cased words split at punctuation/whitespace.
    ``normalise=True`` emits and groups words in Unicode NFD; a form's name
    (``"NFC"``) in that form; ``False`` as written."""
    counts = (words(df, text, repartition).groupBy("word")
              .agg(F.count(F.lit(1)).alias("count")))
    return _normalise(counts, "NFD" if normalise is True else normalise) if normalise else counts


def token_count(df: DataFrame, text: str = "text", normalise: bool | str = True,
                keep_punctuation: bool = True) -> DataFrame:
    """``word, count`` over locale word-break tokens, case kept (the
    MapReduce word count)."""
    tokens = spread(df.select(text)).select(
        F.explode(locale_tokens(F.col(text), keep_punctuation)).alias("word"))
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return _normalise(counts, "NFD" if normalise is True else normalise) if normalise else counts


def by_word(counts: DataFrame) -> DataFrame:
    """Sorted by word, with the ``word count`` output line."""
    return counts.orderBy("word").select("word", "count",
                                         word_count_line("word", "count").alias("line"))


def by_frequency(counts: DataFrame) -> DataFrame:
    """Sorted by count descending, then word (one sort with two keys)."""
    return counts.orderBy(F.desc("count"), "word").select(
        "word", "count", word_count_line("word", "count").alias("line"))

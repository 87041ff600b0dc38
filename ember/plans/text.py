"""Word counts over ``documents.text`` (whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import LOCALE_TOKEN_RE2, WORD_SEPARATOR, normal_form
from ..operators import wordcount as wc
from ..session import scratch_path
from ..sinks import write_key_value, written_lines
from ..sources.testdata import table
from ..sources.text import read_lines
from .registry import register

_SEP = WORD_SEPARATOR.replace("'", "''")
_WORDS = f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(lower(text), '{_SEP}')) AS word FROM documents)
WHERE word <> '' GROUP BY word
"""


@register("word_count", oracle=_WORDS)
def word_count(spark, sf_dir):
    """Lower-cased words split at punctuation/whitespace, as written."""
    return wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False)


@register("word_count_by_freq", oracle=f"""
SELECT word, count, word || ' ' || CAST(count AS VARCHAR) AS line FROM ({_WORDS})
""")
def word_count_by_freq(spark, sf_dir):
    counts = wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False)
    return wc.by_frequency(counts)


@register("word_count_by_word", oracle=f"""
SELECT word, count, word || ' ' || CAST(count AS VARCHAR) AS line FROM ({_WORDS})
""")
def word_count_by_word(spark, sf_dir):
    counts = wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False)
    return wc.by_word(counts)


@register("word_count_nfd")
def word_count_nfd(spark, sf_dir):
    """The reference's word count: words emitted and grouped in Unicode NFD
    (DuckDB has no NFD; checked against Python in tests/)."""
    return wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=True)


@register("word_count_canonical", oracle=f"""
SELECT nfc_normalize(word) AS word, CAST(sum(count) AS BIGINT) AS count, count(*) AS spellings
FROM ({_WORDS}) GROUP BY 1
""")
def word_count_canonical(spark, sf_dir):
    """Words grouped by their NFD, with the number of spellings each group has,
    shown in the composed form (which DuckDB has)."""
    words = wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False)
    groups = words.groupBy(normal_form(F.col("word"), "NFD").alias("nfd")).agg(
        F.sum("count").alias("count"), F.count("*").alias("spellings"))
    return groups.select(normal_form(F.col("nfd"), "NFC").alias("word"), "count", "spellings")


@register("word_count_nfc", oracle=f"""
SELECT nfc_normalize(word) AS word, CAST(sum(count) AS BIGINT) AS count FROM ({_WORDS}) GROUP BY 1
""")
def word_count_nfc(spark, sf_dir):
    """The same normaliser in the composed form, which DuckDB has."""
    return wc.word_count(table(spark, sf_dir, "documents"), "text", normalise="NFC")


_LINES = "word || ' ' || CAST(count AS VARCHAR)"


@register("word_count_text_by_freq", oracle=f"""
SELECT CAST(row_number() OVER (ORDER BY count DESC, word) - 1 AS BIGINT) AS pos, {_LINES} AS line
FROM ({_WORDS})
""")
def word_count_text_by_freq(spark, sf_dir):
    """The by-frequency output as text files, read back in file order."""
    counts = wc.by_frequency(wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False))
    return written_lines(counts, "line", scratch_path(spark, "by-freq"))


@register("word_count_text_by_word", oracle=f"""
SELECT CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS pos, {_LINES} AS line
FROM ({_WORDS})
""")
def word_count_text_by_word(spark, sf_dir):
    """The by-word output as text files, read back in file order."""
    counts = wc.by_word(wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False))
    return written_lines(counts, "line", scratch_path(spark, "by-word"))


@register("word_count_key_value", oracle=f"""
SELECT word || chr(9) || CAST(count AS VARCHAR) AS line FROM ({_WORDS})
""")
def word_count_key_value(spark, sf_dir):
    """Key, tab, value lines, read back as lines."""
    path = scratch_path(spark, "key-value")
    counts = wc.word_count(table(spark, sf_dir, "documents"), "text", normalise=False)
    write_key_value(counts, path, "word", "count")
    return read_lines(spark, path).withColumnRenamed("value", "line")


_TOKEN = LOCALE_TOKEN_RE2.replace("'", "''")


@register("token_count", oracle=f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM documents) GROUP BY word
""")
def token_count(spark, sf_dir):
    """Locale word-break tokens with case kept, as written (the MapReduce
    word count before its normal form)."""
    return wc.token_count(table(spark, sf_dir, "documents"), "text", normalise=False)


@register("token_count_nfc", oracle=f"""
SELECT nfc_normalize(word) AS word, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM documents) GROUP BY 1
""")
def token_count_nfc(spark, sf_dir):
    return wc.token_count(table(spark, sf_dir, "documents"), "text", normalise="NFC")

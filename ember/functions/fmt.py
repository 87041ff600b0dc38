"""Output formatting as column expressions (no Python row functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_string(col) -> Column:
    """A JSON string literal for a string column (quotes and escapes)."""
    arr = F.to_json(F.array(_c(col)))
    return F.regexp_replace(arr, r"^\[|\]$", "")


def number_text(value) -> Column:
    """A double as JSON writers print it: plain from 1e-4 up to 1e16, beyond
    that with a signed two-digit exponent; other types as Spark casts them."""
    v = _c(value).cast("double")
    text = v.cast("string")
    # Double.toString's digits are the shortest; only their layout changes
    plain = F.regexp_replace(text.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    sign = F.when(power < 0, "e-").otherwise("e+")
    digits = F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0"))
    size = F.abs(v)
    return (F.when(~text.contains("E"), text)
            .when((size >= 1e-4) & (size < 1e16), plain)
            .otherwise(F.concat(mantissa, sign, digits)))


def json_pair(key, value) -> Column:
    """``["key", value]`` - the JSON array text of a (string, number) pair."""
    return F.concat(F.lit("["), json_string(key), F.lit(", "), number_text(value), F.lit("]"))


def key_value_line(key, value, sep: str = "\t") -> Column:
    """Hadoop text-output line: key, tab, value."""
    return F.concat_ws(sep, _c(key).cast("string"), _c(value).cast("string"))


def word_count_line(word, count) -> Column:
    """``word count`` as printed by the word-count job."""
    return F.format_string("%s %d", _c(word), _c(count))


def range_line(date, station, rng) -> Column:
    """``DATE ID RANGE`` line of the temperature-range job."""
    return F.concat_ws(" ", _c(date).cast("string"), _c(station).cast("string"),
                       _c(rng).cast("string"))

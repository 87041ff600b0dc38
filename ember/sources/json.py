"""JSON sources: JSON lines with a declared schema, and files of
concatenated (pretty-printed) JSON objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import read_lines, read_whole_files

_BAD = "_bad_record"

# A string literal, or whatever stands up to the next one (a quote without an
# end takes the rest): strings are skipped, so braces inside them do not count.
# Possessive loops: the JVM runs them without recursion, so a string may have any
# length, and one alternative always matches, so a text is read once.
_PIECES = r'"(?s:[^"\\]++|\\.)*+(?:"|\\?\z)|[^"]++'
# Outside strings only two top-level objects follow each other with nothing
# but space between; inside an array or object there is a comma.
_BETWEEN = r"\}\s*\{"
_CUT = "\u0001"


def read_json_lines(spark: SparkSession, path, schema: T.StructType | str,
                    bad_records_column: str | None = None, keep_invalid: bool = True) -> DataFrame:
    """JSON lines parsed with a declared schema (only those fields). A line that
    does not parse gives nulls (its text in ``bad_records_column``, if named), or
    no row unless ``keep_invalid``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    bad = bad_records_column or (None if keep_invalid else _BAD)
    if bad is None:
        return spark.read.schema(schema).json(path)
    whole = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    rows = spark.read.schema(whole).option("columnNameOfCorruptRecord", bad).json(path)
    rows = rows if keep_invalid else rows.where(F.col(bad).isNull())
    return rows if bad_records_column else rows.drop(bad)


def split_objects(text: F.Column) -> F.Column:
    """Array of the top-level JSON object texts in a text, several on one line
    included."""
    marked = F.transform(F.regexp_extract_all(text, F.lit(_PIECES), 0), lambda p: F.when(
        p.startswith('"'), p).otherwise(F.regexp_replace(p, _BETWEEN, "}" + _CUT + "{")))
    return F.filter(F.split(F.array_join(marked, ""), _CUT), lambda s: F.trim(s) != "")


def parse_objects(df: DataFrame, json: str, schema: T.StructType | str, keep_invalid: bool = False,
                  bad_records=None) -> DataFrame:
    """The fields of the JSON objects in column ``json``. Objects that do not
    parse are dropped, unless ``keep_invalid``; an ``Observation`` given as
    ``bad_records`` counts them as ``bad`` when the result is read."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    whole = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = df.select(F.from_json(json, whole, {"columnNameOfCorruptRecord": _BAD}).alias("r"))
    if bad_records is not None:
        parsed = parsed.observe(bad_records, F.count(F.col(f"r.{_BAD}")).alias("bad"))
    if not keep_invalid:
        parsed = parsed.where(F.col("r").isNotNull() & F.col(f"r.{_BAD}").isNull())
    return parsed.select(*(F.col("r")[f.name].alias(f.name) for f in schema.fields))


def read_json_objects(spark: SparkSession, path, schema: T.StructType | str, line_sep: str | None = None,
                      keep_invalid: bool = False, bad_records=None) -> DataFrame:
    """Text records that each hold one or more JSON objects. ``line_sep`` cuts
    records inside a file, so a large file is read by many tasks (``"\\n}\\n"``
    style separators keep pretty-printed objects whole)."""
    lines = read_lines(spark, path, line_sep=line_sep)
    return parse_objects(lines.select(F.explode(split_objects(F.col("value"))).alias("json")), "json", schema,
                         keep_invalid, bad_records)


def read_pretty_json(spark: SparkSession, path, schema: T.StructType | str, keep_invalid: bool = False,
                     bad_records=None) -> DataFrame:
    """Pretty-printed JSON objects one after another, with nothing between them.

    A top-level object opens and closes with a brace at the start of a line,
    which no nested one does and no string holds, so records end there and a
    large file is read by many tasks. An object that was cut off ends where the
    next one opens. See ``parse_objects`` for those that do not parse."""
    records = read_lines(spark, path, line_sep="\n}\n").select(F.concat(F.lit("\n"), "value").alias("value"))
    opened = F.filter(F.transform(F.split("value", r"\n\{"), lambda x, i: F.when(i > 0, F.concat(F.lit("{"), x))),
                      lambda x: x.isNotNull())
    # only the last one was closed; a file's last line may still have its brace
    last = F.when(F.rtrim(F.element_at("parts", -1)).endswith("\n}"), F.element_at("parts", -1)).otherwise(
        F.concat(F.element_at("parts", -1), F.lit("\n}")))
    closed = F.concat(F.slice("parts", 1, F.size("parts") - 1), F.array(last))
    objects = records.select(opened.alias("parts")).where(F.size("parts") > 0).select(F.explode(closed).alias("json"))
    return parse_objects(objects, "json", schema, keep_invalid, bad_records)


def read_multiline_json(spark: SparkSession, path, schema: T.StructType | str,
                        keep_invalid: bool = False, bad_records=None) -> DataFrame:
    """Files holding a sequence of JSON objects, each possibly spread over
    many lines. A file is read whole (one task per file: for files that fit a
    task; ``read_json_objects`` splits larger ones), cut between objects, and
    each object parsed; see ``parse_objects`` for the invalid ones."""
    files = read_whole_files(spark, path)
    return parse_objects(files.select(F.explode(split_objects(F.col("value"))).alias("json")), "json", schema,
                         keep_invalid, bad_records)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType | str,
                      alias: str = "parsed") -> DataFrame:
    """Parse a JSON text column with a declared schema (nulls for bad text)."""
    return df.withColumn(alias, F.from_json(F.col(col), schema))

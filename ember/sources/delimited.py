"""Delimited sources: CSV with a declared schema, page-view files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGEVIEW_SCHEMA = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("bytes", T.LongType()),
])

# Fixed value: the hour stamp inside a page-view file name,
# ``pagecounts-yyyymmdd-hhmmss[.gz]`` -> ``yyyymmdd-hh``.
HOUR_IN_NAME = r"(\d{8}-\d{2})\d{4}"
# the last stamp counts: folders above the file may carry others
_LAST_HOUR = "^.*" + HOUR_IN_NAME


def read_csv(spark: SparkSession, path, schema: T.StructType | str, header: bool = False,
             sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def hour_from_file_name(name: F.Column) -> F.Column:
    return F.regexp_extract(name, _LAST_HOUR, 1)


def read_pageviews(spark: SparkSession, path, from_path: bool = False) -> DataFrame:
    """Space-separated ``lang title views bytes`` lines with the hour taken
    from the file name (or, with ``from_path``, from anywhere in the file's
    path, e.g. a ``pagecounts-.../`` folder). Quotes are ordinary characters
    (titles may contain them); lines whose counts do not parse are dropped.
    Folders are read recursively, without partition inference."""
    df = (spark.read.schema(PAGEVIEW_SCHEMA).option("sep", " ").option("quote", "")
          .option("escape", "").option("mode", "PERMISSIVE")
          .option("recursiveFileLookup", "true").csv(path))
    name = F.col("_metadata.file_path") if from_path else F.col("_metadata.file_name")
    return (df.select("*", hour_from_file_name(name).alias("hour"))
            .where(F.col("views").isNotNull()))


def popular_pages(pageviews: DataFrame, lang: str = "en",
                  excluded_prefixes=("Main_Page", "Special:")) -> DataFrame:
    """The filter of the popular-page job: one language, minus special pages."""
    cond = F.col("lang") == lang
    for p in excluded_prefixes:
        cond = cond & ~F.col("title").startswith(p)
    return pageviews.where(cond)

"""Most-viewed rows per group, ties kept."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.topk import argmax_per_group, max_per_group, top_per_group
from ..session import materialize, scratch_path
from ..sources import standins
from ..sources.delimited import popular_pages, read_pageviews
from ..sources.testdata import table
from .registry import register


def _hourly_views(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.date_format("ts", "yyyyMMdd-HH").alias("hour"),
                     F.col("event_id").alias("title"), F.col("value").alias("views"))


@register("hourly_top_events", oracle="""
WITH v AS (SELECT strftime(ts, '%Y%m%d-%H') AS hour, event_id AS title, value AS views FROM events),
m AS (SELECT hour, max(views) AS views FROM v GROUP BY hour)
SELECT v.hour, v.title, v.views FROM v JOIN m ON v.hour = m.hour AND v.views = m.views
""")
def hourly_top_events(spark, sf_dir):
    """Page-view stand-in: hour of ``ts``, title = event id, views = value."""
    return top_per_group(_hourly_views(spark, sf_dir), "hour", "views", keep=["title"])


@register("hourly_max_views", oracle="""
SELECT strftime(ts, '%Y%m%d-%H') AS hour, max(value) AS max_value FROM events GROUP BY 1
""")
def hourly_max_views(spark, sf_dir):
    """Only the maximum per hour (the MapReduce form, combiner = reducer)."""
    return max_per_group(_hourly_views(spark, sf_dir), "hour", "views")


@register("hourly_most_viewed", oracle="""
WITH v AS (SELECT strftime(ts, '%Y%m%d-%H') AS hour, event_id AS title, value AS views FROM events),
m AS (SELECT hour, max(views) AS views FROM v GROUP BY hour)
SELECT v.hour, max(v.title) AS title, v.views FROM v JOIN m ON v.hour = m.hour AND v.views = m.views
GROUP BY v.hour, v.views
""")
def hourly_most_viewed(spark, sf_dir):
    """The most-viewed title itself, one row per hour (one aggregate)."""
    return argmax_per_group(_hourly_views(spark, sf_dir), "hour", "views", keep=["title"])


@register("source_top_documents", oracle="""
WITH v AS (SELECT source, CAST(doc_id AS VARCHAR) AS title, n_chars FROM documents
           WHERE lang = 'en' AND NOT starts_with(CAST(doc_id AS VARCHAR), 'Main_Page')
             AND NOT starts_with(CAST(doc_id AS VARCHAR), 'Special:')),
m AS (SELECT source, max(n_chars) AS n_chars FROM v GROUP BY source)
SELECT v.source, v.title, v.n_chars FROM v JOIN m ON v.source = m.source AND v.n_chars = m.n_chars
""")
def source_top_documents(spark, sf_dir):
    """Page-view filter (language, excluded title prefixes) + arg-max per
    group on ``documents``: group = source, views = n_chars."""
    docs = table(spark, sf_dir, "documents").select(
        "source", "lang", F.col("doc_id").cast("string").alias("title"), "n_chars")
    return top_per_group(popular_pages(docs), "source", "n_chars", keep=["title"])


@register("pageview_files_top", oracle="""
WITH v AS (
  SELECT strftime(ts, '%Y%m%d-%H') AS hour,
         CASE WHEN event_type = 'signup' THEN 'Special:' || event_id
              ELSE CAST(event_id AS VARCHAR) END AS title,
         CAST(round(value * 100) AS BIGINT) AS views
  FROM events WHERE event_type <> 'error'),
w AS (SELECT * FROM v WHERE NOT starts_with(title, 'Main_Page')
                         AND NOT starts_with(title, 'Special:')),
m AS (SELECT hour, max(views) AS views FROM w GROUP BY hour)
SELECT w.hour, w.title, w.views FROM w JOIN m ON w.hour = m.hour AND w.views = m.views
""")
def pageview_files_top(spark, sf_dir):
    """Page-view text files (one folder per hour, named by its stamp) read
    with a space separator and no quoting; hour from the path; English,
    non-special pages; most-viewed titles per hour with ties."""
    path = scratch_path(spark, "pagecounts")
    # clustered by hour and a hash of the line, so an hour's lines are dealt to
    # several writers once they fill more than one
    lines = standins.pageview_lines(table(spark, sf_dir, "events"))
    (lines.repartitionByRange("pagecounts", F.xxhash64("value"))
     .write.partitionBy("pagecounts").text(path))
    # parsed once: the maxima and the rows that reach them read the copy
    pv = materialize(popular_pages(read_pageviews(spark, path, from_path=True)).select("hour", "title", "views"),
                     "pageviews")
    return top_per_group(pv, "hour", "views", keep=["title"])

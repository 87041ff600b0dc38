"""Averages, relative scores, JSON inputs (comments stand-in: ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..session import materialize, scratch_path
from ..sinks import count_only, written_lines
from ..sources import json as jsrc
from ..sources import standins
from ..sources.testdata import table
from .registry import register

COMMENT_SCHEMA = "subreddit string, score double, author string"

_AVG_ORACLE = """
SELECT event_type AS {key}, round(avg(value), 6) AS average,
       '["' || event_type || '", ' || CAST(round(avg(value), 6) AS VARCHAR) || ']' AS json
FROM events GROUP BY event_type
"""


@register("event_type_average", oracle=_AVG_ORACLE.format(key="event_type"))
def event_type_average(spark, sf_dir):
    return agg.group_average(table(spark, sf_dir, "events"), "event_type", "value", digits=6)


@register("event_type_average_sql", oracle="""
SELECT event_type, round(avg(value), 6) AS average FROM events GROUP BY event_type
""")
def event_type_average_sql(spark, sf_dir):
    return agg.group_average_sql(spark, table(spark, sf_dir, "events"), "event_type", "value")


@register("props_json_average", oracle="""
SELECT event_type, round(avg(CAST(json_extract(props, '$.k') AS BIGINT)), 6) AS avg_k
FROM events GROUP BY event_type
""")
def props_json_average(spark, sf_dir):
    """Average of a field parsed out of a JSON text column."""
    ev = table(spark, sf_dir, "events")
    parsed = jsrc.parse_json_column(ev.select("event_type", "props"), "props", "k bigint", "p")
    return parsed.groupBy("event_type").agg(F.round(F.avg("p.k"), 6).alias("avg_k"))


#: Between records, so that a file can be cut into splits.
_RECORD = "\n\x1e\n"


@register("multiline_json_average", oracle=_AVG_ORACLE.format(key="subreddit"))
def multiline_json_average(spark, sf_dir):
    """Comments written as pretty-printed JSON objects (several per file,
    each over several lines, with a nested object), read back with the
    record reader, averaged per subreddit; cut-off records are dropped."""
    path = scratch_path(spark, "comments_json")
    (standins.comments_json_text(table(spark, sf_dir, "events"), pretty=True)
     .write.option("lineSep", _RECORD).text(path))
    comments = jsrc.read_json_objects(spark, path, COMMENT_SCHEMA, line_sep=_RECORD)
    return agg.group_average(comments, "subreddit", "score", digits=6)


@register("pretty_json_average", oracle=_AVG_ORACLE.format(key="subreddit"))
def pretty_json_average(spark, sf_dir):
    """The same objects one after another with only a newline between them, as
    the reference's input has them; files are still cut into splits."""
    path = scratch_path(spark, "comments_pretty")
    standins.comments_json_text(table(spark, sf_dir, "events"), pretty=True).write.text(path)
    return agg.group_average(jsrc.read_pretty_json(spark, path, COMMENT_SCHEMA), "subreddit", "score", digits=6)


_REL_ORACLE = """
WITH a AS (SELECT event_type, avg(value) AS avg_score FROM events
           GROUP BY event_type HAVING avg(value) > 0)
SELECT round(e.value / a.avg_score, 6) AS relative_score, CAST(e.user_id AS VARCHAR) AS author
FROM events e JOIN a ON e.event_type = a.event_type
"""


@register("relative_score", oracle=_REL_ORACLE)
def relative_score(spark, sf_dir):
    c = standins.comments(table(spark, sf_dir, "events"))
    return agg.relative_score(c, "subreddit", "score", "author", broadcast=False, digits=6)


@register("relative_score_broadcast", oracle=_REL_ORACLE)
def relative_score_broadcast(spark, sf_dir):
    c = standins.comments(table(spark, sf_dir, "events"))
    return agg.relative_score(c, "subreddit", "score", "author", broadcast=True, digits=6)


@register("relative_score_json_lines", oracle=_REL_ORACLE)
def relative_score_json_lines(spark, sf_dir):
    """The reference's input path: comments as JSON lines, parsed with a
    declared schema (only the needed fields); lines cut off are left out. The
    lines are parsed once, as means and facts both need them."""
    path = scratch_path(spark, "comments_jsonl")
    standins.comments_json_text(table(spark, sf_dir, "events"), pretty=False).write.text(path)
    c = materialize(jsrc.read_json_lines(spark, path, COMMENT_SCHEMA, keep_invalid=False), "comments")
    return agg.relative_score(c, "subreddit", "score", "author", broadcast=True, digits=6)


@register("relative_score_salted", oracle=_REL_ORACLE)
def relative_score_salted(spark, sf_dir):
    """The join really shuffled, a hot subreddit spread over 16 salts."""
    c = standins.comments(table(spark, sf_dir, "events"))
    return agg.relative_score(c, "subreddit", "score", "author", salt_buckets=16, digits=6)


# Scores of errors count against the author, so that group's mean is negative.
_SIGNED = "CASE WHEN event_type = 'error' THEN -value ELSE value END"
_SIGNED_ORACLE = _REL_ORACLE.replace("avg(value)", f"avg({_SIGNED})").replace(
    "e.value", f"({_SIGNED.replace('event_type', 'e.event_type').replace('value', 'e.value')})")


def _signed(spark, sf_dir):
    score = F.when(F.col("subreddit") == "error", -F.col("score")).otherwise(F.col("score"))
    return standins.comments(table(spark, sf_dir, "events")).withColumn("score", score)


@register("relative_score_positive_means", oracle=_SIGNED_ORACLE)
def relative_score_positive_means(spark, sf_dir):
    """A subreddit with a negative mean is left out, rows and all."""
    return agg.relative_score(_signed(spark, sf_dir), "subreddit", "score", "author", digits=6)


@register("relative_score_text", oracle=f"""
SELECT CAST(row_number() OVER (ORDER BY relative_score DESC, author) - 1 AS BIGINT) AS pos,
       CAST(CAST(relative_score AS DECIMAL(18,6)) AS VARCHAR) || ' ' || author AS line
FROM ({_REL_ORACLE})
""")
def relative_score_text(spark, sf_dir):
    """Scores in falling order as text files, read back with their places."""
    scores = agg.relative_score(standins.comments(table(spark, sf_dir, "events")), "subreddit", "score", "author", digits=6)
    line = F.concat_ws(" ", F.col("relative_score").cast("decimal(18,6)").cast("string"), "author")
    return written_lines(scores, line, scratch_path(spark, "relative-score"))


@register("event_totals_observed", oracle="""
SELECT count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS errors,
       CAST(sum(user_id) AS BIGINT) AS user_ids, round(max(value), 6) AS highest FROM events
""")
def event_totals_observed(spark, sf_dir):
    """Named totals observed while the rows go to the null sink."""
    totals = count_only(table(spark, sf_dir, "events"), {
        "rows": F.count(F.lit(1)), "errors": F.count_if(F.col("event_type") == "error"), "user_ids": F.sum("user_id"),
        "highest": F.round(F.max("value"), 6)})
    return spark.createDataFrame([(totals["rows"], totals["errors"], totals["user_ids"], totals["highest"])],
                                 "rows long, errors long, user_ids long, highest double")

"""Adapters from the driver's tables to the input shapes the jobs expect.

Each adapter is a Spark transformation of a whole table (see FIXTURES.md §3):

* comments      <- events   (subreddit = event_type, score = value, author = user_id)
* observations  <- events   (station = user_id, date = yyyymmdd of ts,
                             TMAX = purchase value, TMIN = view value;
                             every eleventh event id is flagged)
* log lines     <- events   (host = user_id, path = /event_type, bytes = whole value)
* points        <- events   ("x y" text with x = user_id, y = value)
* page views    <- events   (one file per hour; lang = fr for errors else en,
                             title = event id, "Special:" prefix for signups,
                             views = value in cents)
* temperatures  <- events   (station = user_id, place and season from ids and ts)
* link graph    <- region -> nation -> customer -> order -> part, links back
* colours       <- part     (R, G, B from key and size; label = dominant channel)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fmt import json_string
from ..functions.logs import render_access_log


def comments(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("subreddit"),
                         F.col("value").alias("score"),
                         F.col("user_id").cast("string").alias("author"))


def comments_json_text(events: DataFrame, pretty: bool = True) -> DataFrame:
    """Comment records as JSON text (``value``): pretty-printed over several
    lines (with a nested object) or one object per line."""
    sub = json_string(F.col("event_type"))
    author = json_string(F.col("user_id").cast("string"))
    nl, ind = ("\n", "  ") if pretty else ("", "")
    text = F.concat(
        F.lit("{" + nl + ind + '"subreddit": '), sub, F.lit("," + nl + ind + '"score": '),
        F.col("value").cast("string"), F.lit("," + nl + ind + '"author": '), author,
        F.lit("," + nl + ind + '"props": '), F.coalesce(F.col("props"), F.lit("null")),
        F.lit(nl + "}"))
    # every fortieth record is followed by one that was cut off
    cut = F.when(F.col("event_id") % 40 == 0, F.array(text, F.substring(text, 1, 20))).otherwise(F.array(text))
    return events.select(F.explode(cut).alias("value"))


def observations(events: DataFrame) -> DataFrame:
    obs = (F.when(F.col("event_type") == "purchase", "TMAX")
           .when(F.col("event_type") == "view", "TMIN"))
    return (events.where(F.col("event_type").isin("purchase", "view"))
            .select(F.col("user_id").cast("string").alias("station"),
                    F.date_format("ts", "yyyyMMdd").cast("bigint").alias("date"),
                    obs.alias("observation"),
                    F.col("value").alias("value"),
                    F.lit(None).cast("string").alias("mflag"),
                    # every eleventh reading failed its quality check
                    F.when(F.col("event_id") % 11 == 0, "X").alias("qflag")))


def station_temperatures(events: DataFrame) -> DataFrame:
    """A reading per event: a station has a fixed place and elevation, and
    the temperature follows latitude and season with the value as noise."""
    place = F.col("user_id")
    season = F.cos((F.dayofyear("ts") - 200) / F.lit(58.1))
    return events.select(
        "event_id", place.cast("string").alias("station"), F.to_date("ts").alias("date"),
        (place * 37 % 120 - 60).cast("float").alias("latitude"),
        (place * 53 % 360 - 180).cast("float").alias("longitude"),
        (place * 11 % 3000).cast("float").alias("elevation"),
        (30 - F.abs(place * 37 % 120 - 60) / 3 + 10 * season + F.col("value") / 100).cast("float").alias("tmax"))


def log_lines(events: DataFrame) -> DataFrame:
    return events.select(render_access_log(
        F.col("user_id").cast("string"), F.col("ts"),
        F.concat(F.lit("/"), F.col("event_type")),
        F.floor("value").cast("bigint")).alias("value"))


def point_messages(events: DataFrame) -> DataFrame:
    return events.select(F.concat_ws(" ", F.col("user_id").cast("string"),
                                     F.col("value").cast("string")).alias("value"))


def _ids(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def back_links(nation: DataFrame, customer: DataFrame) -> DataFrame:
    """Edges that close cycles: nations to their region and to themselves,
    customers to their nation."""
    return (nation.select(_ids("n", "n_nationkey").alias("source"), _ids("r", "n_regionkey").alias("destination"))
            .unionByName(nation.select(_ids("n", "n_nationkey").alias("source"),
                                       _ids("n", "n_nationkey").alias("destination")))
            .unionByName(customer.select(_ids("c", "c_custkey").alias("source"),
                                         _ids("n", "c_nationkey").alias("destination"))))


def link_edges(nation: DataFrame, customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Directed edges with prefixed ids: r<k> -> n<k> -> c<k> -> o<k> -> p<k>."""
    ids = _ids
    return (nation.select(ids("r", "n_regionkey").alias("source"), ids("n", "n_nationkey").alias("destination"))
            .unionByName(customer.select(ids("n", "c_nationkey").alias("source"),
                                         ids("c", "c_custkey").alias("destination")))
            .unionByName(orders.select(ids("c", "o_custkey").alias("source"),
                                       ids("o", "o_orderkey").alias("destination")))
            .unionByName(lineitem.select(ids("o", "l_orderkey").alias("source"),
                                         ids("p", "l_partkey").alias("destination"))))


def colours(part: DataFrame) -> DataFrame:
    r = (F.col("p_partkey") % 256).cast("int")
    g = (F.col("p_partkey") * 7 % 256).cast("int")
    b = (F.col("p_size") * 5 % 256).cast("int")
    label = (F.when((F.col("R") >= F.col("G")) & (F.col("R") >= F.col("B")), "red")
             .when(F.col("G") >= F.col("B"), "green").otherwise("blue"))
    return (part.select(r.alias("R"), g.alias("G"), b.alias("B"), "p_partkey")
            .withColumn("labelword", label))


def pageview_lines(events: DataFrame) -> DataFrame:
    """``lang title views bytes`` lines plus the ``pagecounts`` file stamp
    (``yyyyMMdd-HH0000``) of the hour they belong to."""
    lang = F.when(F.col("event_type") == "error", "fr").otherwise("en")
    title = F.when(F.col("event_type") == "signup",
                   F.concat(F.lit("Special:"), F.col("event_id").cast("string"))) \
        .otherwise(F.col("event_id").cast("string"))
    views = F.round(F.col("value") * 100).cast("bigint")
    line = F.concat_ws(" ", lang, title, views.cast("string"), F.col("user_id").cast("string"))
    return events.select(line.alias("value"),
                         F.date_format("ts", "yyyyMMdd-HH0000").alias("pagecounts"))

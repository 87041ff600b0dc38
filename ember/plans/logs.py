"""Access-log parsing and host-level correlation (log lines rendered from
``events``: host = user_id, path = /event_type, bytes = whole value)."""

from __future__ import annotations

from ..functions.logs import parse_access_log
from ..operators import aggregate as agg
from ..operators.ingest import ingest_access_log
from ..session import materialize, scratch_path
from ..sources import standins
from ..sources.store import KeyedStore
from ..sources.testdata import table
from .registry import register

_HOSTS = """
WITH h AS (SELECT CAST(user_id AS VARCHAR) AS host, count(*) AS requests,
                  sum(floor(value)) AS bytes FROM events GROUP BY user_id)
"""
_CORR = _HOSTS + """
SELECT count(*) AS n, round(corr(requests, bytes), 6) AS r,
       round(corr(requests, bytes) * corr(requests, bytes), 6) AS r2 FROM h
"""


def _parsed(spark, sf_dir):
    return parse_access_log(standins.log_lines(table(spark, sf_dir, "events")))


@register("access_log_parse", oracle="""
SELECT CAST(user_id AS VARCHAR) AS host, date_trunc('second', ts) AS datetime,
       '/' || event_type AS path, CAST(floor(value) AS DOUBLE) AS bytes
FROM events
""")
def access_log_parse(spark, sf_dir):
    return _parsed(spark, sf_dir)


@register("log_host_stats", oracle=_HOSTS + "SELECT host, requests, CAST(bytes AS DOUBLE) AS bytes FROM h")
def log_host_stats(spark, sf_dir):
    return agg.host_totals(_parsed(spark, sf_dir))


@register("log_correlation", oracle=_CORR)
def log_correlation(spark, sf_dir):
    return agg.correlation(agg.host_totals(_parsed(spark, sf_dir)), "requests", "bytes")


@register("log_correlation_two_pass", oracle=_CORR)
def log_correlation_two_pass(spark, sf_dir):
    # both passes read the written totals, so the log is parsed once
    hosts = materialize(agg.host_totals(_parsed(spark, sf_dir)), "host-totals")
    return agg.correlation_two_pass(hosts, "requests", "bytes")


@register("log_six_sums", oracle=_HOSTS + """
SELECT count(*) AS n, CAST(sum(requests) AS DOUBLE) AS sum_x, sum(bytes) AS sum_y,
       CAST(sum(requests * requests) AS DOUBLE) AS sum_x2, sum(bytes * bytes) AS sum_y2,
       sum(requests * bytes) AS sum_xy FROM h
""")
def log_six_sums(spark, sf_dir):
    """The one-pass moment tuple over per-host (requests, bytes)."""
    return agg.six_sums(agg.host_totals(_parsed(spark, sf_dir)), "requests", "bytes")


@register("store_log_correlation", oracle=_CORR)
def store_log_correlation(spark, sf_dir):
    """Load parsed log rows (with a UUID key) into a keyed store, then read
    the store table back and correlate requests with bytes per host."""
    store = KeyedStore(spark, root=scratch_path(spark, "store"))
    lines = standins.log_lines(table(spark, sf_dir, "events"))
    ingest_access_log(lines, store=store, keyspace="logs", table="nasalogs", with_uid=True,
                      batch_rows=300_000)
    rows = store.read("logs", "nasalogs", view=False).select("host", "bytes")
    return agg.correlation(agg.host_totals(rows), "requests", "bytes")

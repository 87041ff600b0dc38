"""Common-log-format lines: parse (host, datetime, path, bytes) and render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference's parser): the fully anchored line
# pattern and the timestamp layout. The zone offset is matched, not applied.
LOG_PATTERN = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that do not match are dropped; returns
    ``host string, datetime timestamp_ntz, path string, bytes double``.

    The pattern runs once per line: the four groups are rewritten into one
    tab-separated string (no group can contain a tab, all are ``\\S+`` or
    inside the bracketed time), a line that the rewrite leaves unchanged did
    not match, and a generator emits zero or one record per line."""
    v = F.col(col)
    packed = lines.select(v.alias("_line"),
                          F.regexp_replace(v, LOG_PATTERN, "$1\t$2\t$3\t$4").alias("_packed"))
    parts = F.split(F.col("_packed"), "\t")
    record = F.struct(
        parts[0].alias("host"),
        F.try_to_timestamp(parts[1], F.lit(LOG_TIME_FORMAT)).cast("timestamp_ntz").alias("datetime"),
        parts[2].alias("path"),
        parts[3].cast("double").alias("bytes"))
    matched = F.col("_packed") != F.col("_line")
    return (packed.select(F.explode(F.when(matched, F.array(record))).alias("_r"))
            .select("_r.*").where(F.col("datetime").isNotNull()))


def render_access_log(host: Column, ts: Column, path: Column, nbytes: Column,
                      method: str = "GET", status: int = 200) -> Column:
    """One log line: ``host - - [dd/MMM/yyyy:HH:mm:ss +0000] "GET path HTTP/1.1" 200 n``."""
    return F.format_string(
        f'%s - - [%s +0000] "{method} %s HTTP/1.1" {status} %d',
        host, F.date_format(ts, LOG_TIME_FORMAT), path, nbytes)

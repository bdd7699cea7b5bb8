"""Parallelism helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: Session setting: scan partitions to spread a table over (unset: as read).
SPREAD_CONF = "spark.noticeflow.scanPartitions"


def spread_scan(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over ``partitions`` before CPU-heavy narrow work
    (text rules, regexes): for inputs of a few unsplittable files. Off unless
    the caller or the session setting SPREAD_CONF gives a number, as it
    shuffles the whole input; tables with as many splits as cores gain
    nothing from it."""
    target = partitions or int(df.sparkSession.conf.get(SPREAD_CONF, "0") or 0)
    return df.repartition(target) if target else df


BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``df`` hinted for broadcast when one aggregate shows at most
    ``max_rows`` rows and ``max_bytes`` bytes (16 per value plus the text
    itself), else unchanged (left to a shuffle join). Runs one job: call it
    on a persisted or cheap DataFrame."""
    from pyspark.sql import functions as F

    text = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    size = F.lit(16 * len(df.columns)).cast("long")
    for t in text:
        size = size + t
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if r["n"] <= max_rows and r["bytes"] <= max_bytes else df

"""Skew-safe "rows sharing my key" counts.

``count(*) OVER (PARTITION BY k)`` needs every row of a key in one task,
so a key (or the NULL key) holding a third of the data becomes a third of
the job in a single task. Instead:

1. ``groupBy(k).count()`` - partial aggregation combines map-side, so a
   hot key costs one row per map task in the shuffle. The counts are
   written once as a small table under ``spark.checkpoint.dir`` (one job;
   the lineage is cut there, so a lost executor never recomputes them).
2. Size check: when the counts table is within ``broadcast_max_keys`` rows
   and ``broadcast_max_bytes`` of key data, it is broadcast and attached in
   a map-only hash join - the rows are never shuffled, so skew cannot
   arise. Otherwise:
3. The ``hot_keys`` largest groups (a top-k, so at most ``hot_keys`` rows:
   a proven size bound) are broadcast and attached to their rows in a
   map-only hash join.
4. The remaining rows get their count through a shuffle join with the
   counts table on the struct (key, salt). Rows of hot keys carry a salt in
   ``1..salt_buckets`` derived from a hash of the row, so they spread over
   many reducers and never match; cold rows carry salt 0. Every cold key
   holds at most 1/(hot_keys+1) of the rows, so no reducer is dominated by
   one key. Any residual concentration (exact duplicate rows of a hot key
   hash alike) is split by AQE's skew-join handling.

The salted counts join is left to AQE's join selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import scratch_path

BROADCAST_MAX_KEYS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def attach_group_count(
    df: DataFrame,
    keys: list[str],
    out: str = "group_count",
    counts_from: DataFrame | None = None,
    hot_keys: int = 1024,
    salt_buckets: int = 64,
    method: str = "auto",
    broadcast_max_keys: int = BROADCAST_MAX_KEYS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``out`` = number of rows of ``counts_from`` (default ``df``) with
    the same ``keys`` (NULL keys form one group, as in a window). ``counts``
    is a table (keys, n) that already holds these numbers: nothing is counted then.

    ``method``: 'auto' (broadcast the counts when the size check passes,
    else salted), 'salted', or 'window' (the plain window, for checks).
    'auto' and 'salted' run one job when called (the key counts).
    """
    source = df if counts_from is None else counts_from
    if method == "window":
        if counts_from is not None:
            raise ValueError("method='window' counts within df only")
        return df.withColumn(out, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    if method not in ("auto", "salted"):
        raise ValueError(f"unknown method {method!r}")

    spark = df.sparkSession
    key_bytes = sum(F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys)
    if counts is not None:
        counts = counts.select(*keys, F.col("n").alias("_gc_n"))
        size = counts.agg(F.count(F.lit(1)).alias("n"), F.sum(key_bytes + F.lit(8)).alias("b")).first().asDict()
        return _attach(df, keys, counts, out, size, hot_keys, salt_buckets, method, broadcast_max_keys, broadcast_max_bytes)
    path = scratch_path(spark, "group-counts")
    # The size of the counts table is observed while it is written (rows
    # and key bytes), so the check costs no extra job.
    size = Observation(f"group-counts-{path.rsplit('-', 1)[-1]}")
    (
        source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_gc_n"))
        .observe(size, F.count(F.lit(1)).alias("n"), F.sum(key_bytes + F.lit(8)).alias("b"))
        .write.parquet(path)
    )
    counts = spark.read.parquet(path)
    return _attach(df, keys, counts, out, size.get, hot_keys, salt_buckets, method, broadcast_max_keys, broadcast_max_bytes)


def _attach(df, keys, counts, out, size, hot_keys, salt_buckets, method, broadcast_max_keys, broadcast_max_bytes) -> DataFrame:
    """The join of rows with a table (keys, _gc_n) of the given size."""
    if method == "auto":
        n, b = size.get("n", 0), size.get("b") or 0
        if n <= broadcast_max_keys and b <= broadcast_max_bytes:
            return _broadcast_counts(df, keys, counts, out)
    hk = [f"_gc_hot_k{i}" for i in range(len(keys))]
    ck = [f"_gc_cold_k{i}" for i in range(len(keys))]

    hot = (
        counts.orderBy(F.col("_gc_n").desc(), *[F.col(k).asc_nulls_first() for k in keys])
        .limit(hot_keys)
        .select(*[F.col(k).alias(a) for k, a in zip(keys, hk)], F.col("_gc_n").alias("_gc_hot_n"))
    )
    with_hot = df.join(
        F.broadcast(hot),
        on=_null_safe_all([df[k] for k in keys], [hot[a] for a in hk]),
        how="left",
    ).drop(*hk)

    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.when(F.col("_gc_hot_n").isNotNull(), F.pmod(row_hash, F.lit(salt_buckets)) + 1).otherwise(F.lit(0))
    # One struct join key: its hash covers the salt, so hot rows spread
    # over reducers (a separate literal-0 salt column would be folded into
    # a post-join filter and the shuffle would be on the key alone). Struct
    # equality treats NULL fields as equal, keeping NULL keys one group.
    salted = with_hot.withColumn("_gc_jk", F.struct(*[F.col(k) for k in keys], salt.cast("long").alias("s")))
    cold = counts.select(
        F.struct(*[F.col(k) for k in keys], F.lit(0).cast("long").alias("s")).alias("_gc_ck"),
        F.col("_gc_n").alias("_gc_cold_n"),
    )
    joined = salted.join(cold, salted["_gc_jk"] == cold["_gc_ck"], how="left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.coalesce(F.col("_gc_hot_n"), F.col("_gc_cold_n")).alias(out),
    )


def _broadcast_counts(df: DataFrame, keys: list[str], counts: DataFrame, out: str) -> DataFrame:
    """Map-only attach of a size-checked counts table."""
    bk = [f"_gc_b_k{i}" for i in range(len(keys))]
    small = counts.select(*[F.col(k).alias(a) for k, a in zip(keys, bk)], F.col("_gc_n").alias(out))
    joined = df.join(F.broadcast(small), on=_null_safe_all([df[k] for k in keys], [small[a] for a in bk]), how="left")
    return joined.select(*[F.col(c) for c in df.columns], F.col(out))


def _null_safe_all(left, right):
    cond = None
    for a, b in zip(left, right):
        c = a.eqNullSafe(b)
        cond = c if cond is None else cond & c
    return cond

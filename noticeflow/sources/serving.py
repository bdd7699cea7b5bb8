"""Serving sinks: keyed upsert, replace load, multi-table load, run log.

The serving store is a set of Parquet tables under one directory. An
upsert is one plan - fill keys, de-duplicate the batch, anti-join the part of
the target that can hold its keys, union - written beside the table and made
current by one commit (see ``tables``), so a job that dies anywhere leaves the
old table. All tables of a load, and its row in the run log, become current
together (``tables.Run``).

Tables without a partition column of their own are kept in hash buckets of
their keys, so that an upsert reads and rewrites the buckets of its keys only.
Primary keys are proven where rows are written: on the touched partitions or
buckets, before the commit, which then records what it knows. A table whose
newest commit does not is checked as a whole, once.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, TimestampNTZType, TimestampType

from ..functions import dates, rules, text
from ..operators.partitioning import checked_broadcast
from ..schemas import RUN_LOG, SERVING_TABLES
from ..session import scratch_path
from .tables import (
    Run,
    _scan,
    commit,
    committed_append,
    committed_write,
    current_commit,
    new_version,
    partition_dirs,
    read_table,
    remove_path,
    table_exists,
    write_clustered,
)

#: Number of a spooled row, and how many rows share a row of a table of marks.
ROW = "_spool_row"
WORDS, WORD_BITS = 16, 64  # 2 ** 10 rows
#: Rows of such a table, of WORDS words each, that are broadcast.
MARKS_MAX = 500_000
#: Hidden column of tables kept in hash buckets, and their usual size in rows.
BUCKET = "_bucket"
BUCKET_ROWS, MOST_BUCKETS = 250_000, 4096

# ------------------------------------------------------------- row shaping


def _stamp(now) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp")


def to_serving_rows(df: DataFrame, now=None) -> DataFrame:
    """NaN -> NULL, dates and timestamps -> 'yyyy-MM-dd' text, add ``updated_at``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = dates.iso_date_text(c)
        cols.append(c.alias(f.name))
    return df.select(*cols, _stamp(now).alias("updated_at"))


def normalize_dates(df: DataFrame, columns=None) -> DataFrame:
    """Coerce the known date columns to DATE when present; bad values -> NULL."""
    wanted = set(columns or rules.DATE_COLUMNS)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        dates.coerce_date(c, types[c]).alias(c) if c in wanted else F.col(c) for c in df.columns
    ])


def backfill_columns(df: DataFrame, columns=None, value: str = rules.BACKFILL_VALUE) -> DataFrame:
    """Add each missing category column as a constant."""
    out = df
    for c in columns or rules.BACKFILL_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(value))
    return out


def enforce_serving_schema(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared order and types (absent -> NULL)."""
    spec = SERVING_TABLES[table]["columns"]
    present = set(df.columns)
    return df.select(*[
        (F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in spec.items()
    ])


def key_report(df: DataFrame, table: str) -> DataFrame:
    """(table, rows, null_keys, duplicate_keys) for the table's primary key."""
    keys = SERVING_TABLES[table]["keys"]
    any_null = None
    all_set = None
    for k in keys:
        a, b = F.col(k).isNull(), F.col(k).isNotNull()
        any_null = a if any_null is None else any_null | a
        all_set = b if all_set is None else all_set & b
    return df.agg(
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_null).alias("null_keys"),
        (F.count_if(all_set) - F.count_distinct(*[F.col(k) for k in keys])).alias("duplicate_keys"),
    )


# ------------------------------------------------------------------ upsert


def fill_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """NULL or '' in a key column -> 'Unknown'."""
    return df.select(*[text.fill_conflict_keys(c).alias(c) if c in keys else F.col(c) for c in df.columns])


def dedupe_latest(df: DataFrame, keys: list[str], order_first: str | None = "report_date") -> DataFrame:
    """One row per key: the latest ``order_first`` value, then the greatest
    remaining columns (a total order, NULL lowest), so the pick is
    deterministic. ``max(struct)`` is a partial aggregate: a key holding a
    third of the batch is reduced map-side before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if order_first in rest:
        rest = [order_first] + [c for c in rest if c != order_first]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in rest])).alias("_pick"))
    return picked.select(*[F.col(k) for k in keys], *[F.col(f"_pick.{c}").alias(c) for c in rest]).select(*df.columns)


def spool(df: DataFrame, numbered: bool = False) -> tuple[DataFrame, str]:
    """Rows that are read several times, written once to scratch (their columns
    are then read one by one, and no memory holds them), and the folder to remove.
    ``numbered`` gives each row a number of its own, in the column ROW."""
    path = scratch_path(df.sparkSession, "batch")
    if numbered:
        df = df.withColumn(ROW, F.monotonically_increasing_id())
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Spooled:
    """A scratch folder among what a caller unpersists."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def unpersist(self) -> None:
        remove_path(self.spark, self.path)


def latest_rows(rows: DataFrame, keys: list[str], held: list) -> DataFrame:
    """What :func:`dedupe_latest` gives, for spooled rows with filled keys:
    keys are counted first, a pass over the key columns alone, and only rows whose
    key comes more than once are aggregated; the others are neither shuffled nor
    sorted. With too many such keys for a broadcast the rows to keep are found by
    their numbers (:func:`_pick_by_number`), if they were spooled with them, and
    written to scratch once. ``held`` gets what the caller unpersists."""
    columns = [c for c in rows.columns if c != ROW]
    twice = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys).persist()
    held.append(twice)
    few = checked_broadcast(twice)
    if few is twice:
        picked = _pick_by_number(rows, keys, held) if ROW in rows.columns else dedupe_latest(rows, keys)
        picked, path = spool(picked)
        held.append(Spooled(rows.sparkSession, path))
        return picked
    once, more = (rows.join(few, keys, how).select(*columns) for how in ("left_anti", "left_semi"))
    return once.unionByName(dedupe_latest(more, keys))


def _pick_by_number(rows: DataFrame, keys: list[str], held: list) -> DataFrame:
    """:func:`dedupe_latest` of numbered rows, of which only the keys, the
    first ordering column and the numbers are shuffled. Rows that share the greatest
    value of that column under their key are compared as a whole; the others are
    marked, a bit for each row, and filtered out of one more scan."""
    spark, columns = rows.sparkSession, [c for c in rows.columns if c != ROW]
    rest = [c for c in columns if c not in keys]
    lead = "report_date" if "report_date" in rest else rest[0]
    number = F.col(ROW)
    top, path = spool(
        rows.groupBy(*keys).agg(F.max(F.struct(lead, ROW)).alias("_last"), F.max(F.struct(F.col(lead), (-number).alias(ROW))).alias("_first"))
        .select(*keys, F.col(f"_last.{lead}"), F.col(f"_last.{ROW}"), (F.col(f"_last.{ROW}") == -F.col(f"_first.{ROW}")).alias("_one"))
    )
    held.append(Spooled(spark, path))

    block, word = F.shiftrightunsigned(number, 10), (F.shiftrightunsigned(number, 6) % WORDS).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (number % WORD_BITS).cast("int"))
    marks = top.filter("_one").select(ROW, block.alias("_block")).repartition("_block").groupBy("_block").agg(
        F.array(*[F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0).cast("long")) for i in range(WORDS)]).alias("_marks")
    )
    marks, path = spool(marks)
    held.append(Spooled(spark, path))
    marked = F.get("_marks", word).bitwiseAND(bit) != 0
    one = rows.withColumn("_block", block).join(checked_broadcast(marks, MARKS_MAX), "_block").filter(marked).select(*columns)

    tied = checked_broadcast(top.filter("not _one").select(*[F.col(c).alias(f"_t_{c}") for c in [*keys, lead]]))
    same = F.lit(True)
    for c in [*keys, lead]:
        same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return one.unionByName(dedupe_latest(rows.join(tied, same, "left_semi").select(*columns), keys))


def keyed_upsert(
    target: DataFrame | None,
    updates: DataFrame,
    keys: list[str],
    now=None,
    stamp: bool = True,
    assume_unique: bool = False,
) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch (keys
    filled, one row per key, stamped with ``updated_at``).
    ``assume_unique`` skips the de-duplication for a batch the caller
    already reduced to one row per filled key."""
    batch = fill_keys(updates, keys)
    if not assume_unique:
        batch = dedupe_latest(batch, keys)
    if stamp:
        batch = batch.withColumn("updated_at", _stamp(now))
    if target is None:
        return batch
    if stamp and "updated_at" not in target.columns:
        target = target.withColumn("updated_at", F.lit(None).cast("timestamp"))
    kept = target.join(batch.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def _observed(df: DataFrame):
    """``df`` with a row counter that is filled in by the next action (no
    separate counting job)."""
    obs = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class BrokenKey(RuntimeError):
    """A write would break the primary key of its table; nothing was committed."""


def prove_keys(rows: DataFrame, keys: list[str], name: str) -> None:
    """Raise unless every row has its key and no key occurs twice."""
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    twice = rows.groupBy(*keys).agg(F.count("*").alias("_n")).agg(
        F.count_if(some_null).alias("null_keys"), F.count_if((F.col("_n") > 1) & ~some_null).alias("duplicate_keys")
    ).first()
    if twice["null_keys"] or twice["duplicate_keys"]:
        raise BrokenKey(f"primary key of {name} is broken: {twice.asDict()}")


def _proven(state: dict | None, keys: list[str]) -> bool:
    return state is not None and state.get("unique") == list(keys)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _buckets_for(rows: int) -> int:
    """A power of two that keeps buckets near BUCKET_ROWS."""
    return min(MOST_BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


def _write_bucketed(rows: DataFrame, path: str, keys: list[str], buckets: int, run: Run | None) -> None:
    """The whole table anew, in ``buckets`` buckets; its keys are proven."""
    bucketed = rows.withColumn(BUCKET, bucket_of(keys, buckets))
    committed_write(bucketed, path, BUCKET, run, {"hidden": [BUCKET], "buckets": buckets, "unique": list(keys)})


def upsert_table(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str], now=None, buckets: int | None = None,
    run: Run | None = None,
) -> int:
    """Upsert into the Parquet table at ``path``, kept in hash buckets of its
    keys: only the buckets that hold a key of the batch are read, joined and
    rewritten. Returns the number of *input* rows (not distinct keys), counted
    while the batch is built. An empty batch leaves the table's rows as they
    were. ``buckets`` is fixed when a table is first written (default: by its
    rows, BUCKET_ROWS each) and changed by :func:`rebucket`; a table in another layout
    is written anew once."""
    counted, obs = _observed(updates)
    batch = keyed_upsert(None, counted, keys, now).persist()
    try:
        n_batch = batch.count()
        state = current_commit(spark, path)
        if state is None or state.get("buckets") is None or not _proven(state, keys):
            target = _scan(spark, path, state) if table_exists(spark, path) else None
            if target is not None:
                prove_keys(target.select(*keys), keys, path)
                target = target.withColumn("updated_at", F.lit(None).cast("timestamp")) if "updated_at" not in target.columns else target
            rows = batch if target is None else target.join(
                checked_broadcast(batch.select(*keys)), keys, "left_anti"
            ).unionByName(batch, allowMissingColumns=True)
            n_all = n_batch if target is None else target.count() + n_batch
            _write_bucketed(rows, path, keys, buckets or _buckets_for(n_all), run)
            return int(obs.get.get("rows", 0))
        bucketed = batch.withColumn(BUCKET, bucket_of(keys, state["buckets"]))
        touched = {f"{BUCKET}={r[0]}" for r in bucketed.select(BUCKET).distinct().collect()}  # at most MOST_BUCKETS
        mine = [d for d in state["dirs"] if d.split("/")[-1] in touched]
        current = _scan(spark, path, state | {"dirs": mine}, hidden=True)
        kept = current.join(checked_broadcast(batch.select(*keys)), keys, "left_anti")
        _commit_part(spark, path, kept.unionByName(bucketed, allowMissingColumns=True), BUCKET, keys,
                     [d for d in state["dirs"] if d not in mine], run, {"hidden": [BUCKET], "buckets": state["buckets"]})
        return int(obs.get.get("rows", 0))
    finally:
        batch.unpersist()


def add_to_table(
    spark: SparkSession, path: str, deltas: DataFrame, keys: list[str], buckets: int | None = None, run: Run | None = None
) -> None:
    """Add signed ``deltas`` (keys, and columns to add up) to a keyed table of
    sums kept in hash buckets; only the deltas' buckets are read and rewritten. A
    key whose sums are all 0 goes. Keys may be null."""
    sums = [c for c in deltas.columns if c not in keys]
    totals = [F.sum(c).cast(deltas.schema[c].dataType).alias(c) for c in sums]
    some = F.lit(False)
    for c in sums:
        some = some | (F.col(c) != 0)
    batch = deltas.groupBy(*keys).agg(*totals).filter(some).persist()
    try:
        state = current_commit(spark, path)
        n = state["buckets"] if state else buckets or _buckets_for(batch.count())
        facts = {"hidden": [BUCKET], "buckets": n}
        bucketed = batch.withColumn(BUCKET, bucket_of(keys, n))
        if state is None:
            return committed_write(bucketed, path, BUCKET, run, facts)
        touched = {f"{BUCKET}={r[0]}" for r in bucketed.select(BUCKET).distinct().collect()}  # at most MOST_BUCKETS
        mine = [d for d in state["dirs"] if d.split("/")[-1] in touched]
        both = _scan(spark, path, state | {"dirs": mine}, hidden=True).unionByName(bucketed)
        version = new_version()
        write_clustered(both.groupBy(BUCKET, *keys).agg(*totals).filter(some).select(*bucketed.columns),
                        f"{path.rstrip('/')}/{version}", BUCKET)
        others = [d for d in state["dirs"] if d not in mine]
        commit(spark, path, bucketed.schema, others + partition_dirs(spark, path, version), run, facts)
    finally:
        batch.unpersist()


def rebucket(spark: SparkSession, path: str, keys: list[str], buckets: int | None = None) -> None:
    """Write the table anew in another number of buckets (default: by its rows)."""
    rows = read_table(spark, path)
    if not _proven(current_commit(spark, path), keys):
        prove_keys(rows.select(*keys), keys, path)
    _write_bucketed(rows, path, keys, buckets or _buckets_for(rows.count()), None)


def _commit_part(spark, path, rows, partition_col, keys, others, run, facts) -> None:
    """Write the new contents of the touched partitions, prove their keys and
    commit them beside the folders ``others``."""
    version = new_version()
    folder = f"{path.rstrip('/')}/{version}"
    write_clustered(rows, folder, partition_col)
    written = partition_dirs(spark, path, version)
    if written:
        prove_keys(spark.read.schema(rows.select(*keys).schema).parquet(folder), keys, path)
    commit(spark, path, rows.schema, others + written, run, facts | {"unique": list(keys)})


def partition_value(table: str) -> Column | None:
    """The partition column expression of a serving table (None: unpartitioned)."""
    if SERVING_TABLES[table].get("partition") == "report_month":
        return F.coalesce(F.date_format("report_date", "yyyy-MM"), F.lit("none"))
    return None


def partition_dir(spark: SparkSession, column: str, value) -> str:
    """Directory name Spark uses for a partition value."""
    esc = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={esc.escapePathName(str(value))}"


def touched_partitions(
    target: DataFrame, batch: DataFrame, batch_keys: DataFrame, keys: list[str], partition_col: str
) -> DataFrame:
    """Partitions an upsert must rewrite: those receiving batch rows and
    those holding the previous version of a batch key. With ``batch_keys``
    broadcast (a daily batch is small; see :func:`checked_broadcast`) the
    lookup is a map-only semi-join over two columns of the table instead of
    a shuffle of all its keys."""
    old_parts = target.select(*keys, partition_col).join(batch_keys, keys, "left_semi")
    return old_parts.select(partition_col).unionByName(batch.select(partition_col)).distinct()


def upsert_partitioned(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: list[str],
    partition_col: str,
    partition_expr: Column,
    now=None,
    assume_unique: bool = False,
    run: Run | None = None,
    replaced: DataFrame | None = None,
) -> int:
    """Keyed upsert into a table partitioned by ``partition_col`` (derived
    from each row by ``partition_expr``, never NULL) that rewrites only the
    partitions the batch touches: those receiving batch rows and those
    holding the previous version of a batch key. A daily batch against
    years of history rewrites a handful of partitions, not the table.

    The touched partitions are listed on the driver (the commit file lists
    the table's partitions anyway), their new contents are written as a new
    version, and one commit replaces them together - a partition that ends
    up empty is simply not named any more. A caller that has looked up the
    rows the batch replaces gives them as ``replaced`` (with ``partition_col``).
    With ``assume_unique`` the batch is read a few times: give one that is cheap
    to read, such as spooled rows.
    """
    counted, obs = _observed(updates)
    held: list[DataFrame] = []
    spooled = None
    try:
        if not assume_unique:
            counted, spooled = spool(fill_keys(counted, keys), numbered=True)
            counted = latest_rows(counted, keys, held)
        batch = keyed_upsert(None, counted, keys, now, assume_unique=True).withColumn(partition_col, partition_expr)
        if not table_exists(spark, path):
            committed_write(batch, path, partition_col, run, {"unique": list(keys)})  # one row per key by construction
            return int(obs.get.get("rows", 0))
        state = current_commit(spark, path)
        target = _scan(spark, path, state)
        batch_keys = checked_broadcast(batch.select(*keys))
        if not _proven(state, keys):
            prove_keys(target.select(*keys), keys, path)
        if state is None:  # a plain folder becomes a committed table
            kept_rows = target.join(batch_keys, keys, "left_anti")
            committed_write(
                kept_rows.unionByName(batch, allowMissingColumns=True), path, partition_col, run, {"unique": list(keys)}
            )
            return int(obs.get.get("rows", 0))
        if replaced is None:
            touched = touched_partitions(target, batch, batch_keys, keys, partition_col)
        else:
            touched = replaced.select(partition_col).unionByName(batch.select(partition_col)).distinct()
        parts = [r[0] for r in touched.collect()]
        # Literal IN list: the scan reads only the touched partitions.
        current = target.filter(F.col(partition_col).isin(parts))
        new_rows = current.join(batch_keys, keys, "left_anti").unionByName(batch, allowMissingColumns=True)
        rewritten = {partition_dir(spark, partition_col, value) for value in parts}
        kept = [d for d in state["dirs"] if d.split("/")[-1] not in rewritten]
        _commit_part(spark, path, new_rows, partition_col, keys, kept, run, {})
        return int(obs.get.get("rows", 0))
    finally:
        for df in held:
            df.unpersist()
        if spooled:
            remove_path(spark, spooled)


def replace_load(
    spark: SparkSession, path: str, rows: DataFrame, keys: list[str], now=None, partition: tuple | None = None,
    run: Run | None = None,
) -> int:
    """The table becomes exactly the (keyed) input, in one commit.
    ``partition`` = (column, expression) writes it partitioned."""
    counted, obs = _observed(rows)
    out = keyed_upsert(None, counted, keys, now)
    facts = {"unique": list(keys)}  # one row per filled key by construction
    if partition:
        committed_write(out.withColumn(partition[0], partition[1]), path, partition[0], run, facts)
    else:
        committed_write(out, path, None, run, facts)
    return int(obs.get.get("rows", 0))


def load_tables(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    serving_dir: str,
    tables: list[str] | None = None,
    replace: bool = False,
    now=None,
    run: Run | None = None,
) -> DataFrame:
    """Load all eight serving tables (or a subset): fill the keys, keep one
    row per key, enforce the declared columns and types, write. Returns
    (table, loaded) with the per-table input row counts. A write that would
    break a primary key is an error. The tables become current together,
    when all are written: by this call, or with ``run``, which the caller then
    commits."""
    from concurrent.futures import ThreadPoolExecutor

    names = tables or list(SERVING_TABLES)
    own = run or Run(spark, serving_dir)

    def load(name):
        path = f"{serving_dir.rstrip('/')}/{name}"
        keys = SERVING_TABLES[name]["keys"]
        part = SERVING_TABLES[name].get("partition")
        rows = enforce_serving_schema(sources[name], name)
        if replace:
            n = replace_load(spark, path, rows, keys, now, part and (part, partition_value(name)), own)
        elif part:
            n = upsert_partitioned(spark, path, rows, keys, part, partition_value(name), now, run=own)
        else:
            n = upsert_table(spark, path, rows, keys, now, run=own)
        return name, n

    # Independent tables: submit the loads concurrently.
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        loaded = list(pool.map(load, names))
    if run is None:
        own.commit()
    return spark.createDataFrame(loaded, "table string, loaded long")


def read_store(spark: SparkSession, serving_dir: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The serving tables as one run left them: if a run becomes current
    while they are looked up, they are looked up again."""
    names = tables or list(SERVING_TABLES)
    base = serving_dir.rstrip("/")

    def look():
        return {n: current_commit(spark, f"{base}/{n}") for n in names if table_exists(spark, f"{base}/{n}")}

    def numbers(states):
        return {n: s and s["number"] for n, s in states.items()}

    states, again = look(), look()
    while numbers(states) != numbers(again):
        states, again = again, look()
    return {n: _scan(spark, f"{base}/{n}", s) for n, s in states.items()}


def append_run_log(
    spark: SparkSession,
    log_path: str,
    source: str | None,
    bronze_path: str | None,
    records_fetched: int | None,
    records_loaded: int | None = 0,
    status: str = "success",
    warning: str | None = None,
    error: str | None = None,
    started_at: _dt.datetime | None = None,
    finished_at: _dt.datetime | None = None,
    run: Run | None = None,
) -> None:
    """Append one audit row, in a commit of its own or together with ``run``."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (
        run.id if run else uuid.uuid4().hex, started_at or now, finished_at or now, source, bronze_path,
        None if records_fetched is None else int(records_fetched),
        int(records_loaded or 0), status, warning, error,
    )
    committed_append(spark.createDataFrame([row], RUN_LOG).coalesce(1), log_path, run)

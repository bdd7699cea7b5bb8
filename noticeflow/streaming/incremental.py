"""Incremental refresh with Structured Streaming.

New bronze files are picked up by a file stream (``availableNow``: process
what has landed, then stop - the daily-job shape), and each micro-batch is
merged into the served ``recalls`` table with a keyed upsert inside
``foreachBatch``. Late and corrected records are handled by the upsert
(latest report date wins within a batch, later batches replace earlier
rows), so no watermark or streaming state is needed; progress lives in the
checkpoint, so a restarted job resumes where it stopped. The served table
is partitioned by report month, a batch rewrites only the months it
touches, and one commit makes its rows current: a batch that is replayed
after a crash, at whatever step, gives the same table.

By default scores are batch-relative, as in the source system: every row of
the batch's report window is scored (repeat-company counts see that window,
repeated records included), then keys are filled and reduced to one row
each. With ``history=True`` the repeat-company counts are exact over the
whole served table: the table keeps the records, and beside it
(:func:`counts_path`) a keyed table of records per firm is maintained by signed
deltas - plus one for each new row, minus one for each row it replaces -
in the same commit. Reading (:func:`served_table`) then is a projection and a join
with the counts; nothing is counted again, and a batch never rewrites a month
because of a firm (or missing firm) it shares with others.

With ``gold=True`` the gold summaries of a history table are maintained as well
(:func:`maintained_gold`). A record's score depends on its firm's count only up
to the cap of the repeat score, so a batch changes the scores of its own
rows, of those it replaces, and of the few rows of firms whose repeat score
moved; their old contributions are taken from tables of sums and their new ones
added, in the same commit.

Documents that cannot be read stop the stream (the batch is not committed),
or with ``on_loss="warn"`` go to a table of rejects.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import gold as G
from ..operators.explore import filter_report_date
from ..operators.partitioning import checked_broadcast
from ..operators.scoring import FIRM_KEY, add_scores, score_recalls
from ..operators.silver import silver_projection
from ..schemas import SCORED_COLUMNS, SILVER_COLUMNS
from ..sources.bronze import _texts, land_texts
from ..sources.serving import (
    ROW,
    Spooled,
    add_to_table,
    fill_keys,
    latest_rows,
    partition_value,
    spool,
    upsert_partitioned,
)
from ..sources.tables import Run, current_commit, read_table, remove_path, table_exists

KEYS = ["recall_number"]
PARTITION_COL = "report_month"
#: What the scores and the gold summaries read of a record.
GOLD_COLUMNS = [
    "classification", "status", "distribution_pattern", "recall_reason_category", FIRM_KEY, "state", "country",
    "product_category", "recall_initiation_date",
]
#: Shuffle files of a statement go when it ends, not when the driver collects its
#: garbage. Set in the session of a stream's batches, which is a copy of the caller's.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Days of the rolling report-date window of a daily refresh.
LOOKBACK_DAYS = 14


def rolling_window(lookback_days: int = LOOKBACK_DAYS, as_of: str | None = None) -> tuple[str, str]:
    """(start, end) of the report dates a daily refresh keeps: the
    ``lookback_days`` days up to and including ``as_of`` (default: today, UTC)."""
    if as_of:
        last = _dt.datetime.strptime(as_of.replace("-", "")[:8], "%Y%m%d").date()
    else:
        last = _dt.datetime.now(_dt.timezone.utc).date()
    return (last - _dt.timedelta(days=lookback_days)).isoformat(), last.isoformat()


def counts_path(served_path: str) -> str:
    """The table of records per firm beside a served table with history."""
    return f"{served_path.rstrip('/')}_firms"


def merge_batch(
    spark: SparkSession,
    batch_records: DataFrame,
    served_path: str,
    history: bool = False,
    report_start: str | None = None,
    report_end: str | None = None,
    gold: bool = False,
) -> None:
    """Upsert one micro-batch of bronze records into the served table.

    The served table is partitioned by report month and only the months
    holding replaced or new rows are rewritten (``upsert_partitioned``).
    """
    # Read by the emptiness check, the firm counts and the upsert.
    silver, spooled = spool(filter_report_date(silver_projection(batch_records), report_start, report_end), numbered=True)
    held: list = []
    try:
        if silver.isEmpty():
            return
        if history:
            return _merge_history(spark, silver, served_path, gold)
        # Scores are functions of a row and of the counts over all rows of the
        # window, so that the picked rows alone are scored.
        rows = latest_rows(fill_keys(silver.select(*SILVER_COLUMNS, ROW), KEYS), KEYS, held)
        scored, path = spool(score_recalls(rows, history=silver).select(*SCORED_COLUMNS))
        held.append(Spooled(spark, path))
        upsert_partitioned(
            spark, served_path, scored, KEYS, PARTITION_COL, partition_value("recalls"), assume_unique=True,
        )
    finally:
        for df in held:
            df.unpersist()
        remove_path(spark, spooled)


def _merge_history(spark: SparkSession, silver: DataFrame, served_path: str, gold: bool) -> None:
    """Upsert the records and add their signed deltas to the firm counts (and
    the gold sums), in one commit."""
    counts, run = counts_path(served_path), Run(spark, served_path)
    one, held = F.lit(1).cast("long"), []
    replaced, before = None, None
    try:
        rows = latest_rows(fill_keys(silver.select(*SILVER_COLUMNS, ROW), KEYS), KEYS, held)
        deltas = rows.select(FIRM_KEY, one.alias("n"))
        if table_exists(spark, served_path):
            served = read_table(spark, served_path)
            if not table_exists(spark, counts):  # a table of before the counts were kept
                add_to_table(spark, counts, served.select(FIRM_KEY, one.alias("n")), [FIRM_KEY])
            before = read_table(spark, counts)
            # One scan of three columns finds the rows to replace, their firms and months.
            replaced = served.select(*KEYS, FIRM_KEY, PARTITION_COL).join(
                checked_broadcast(rows.select(*KEYS)), KEYS, "left_semi"
            ).persist()
            held.append(replaced)
            deltas = deltas.unionByName(replaced.select(FIRM_KEY, F.lit(-1).cast("long").alias("n")))
        if gold:
            _maintain_gold(spark, served_path, rows, deltas, before, run, held)
        add_to_table(spark, counts, deltas, [FIRM_KEY], run=run)
        upsert_partitioned(
            spark, served_path, rows, KEYS, PARTITION_COL, partition_value("recalls"), assume_unique=True, run=run,
            replaced=replaced,
        )
        run.commit()
    finally:
        for df in held:
            df.unpersist()


def _gold_paths(served_path: str) -> tuple[str, str]:
    base = f"{served_path.rstrip('/')}_gold"
    return f"{base}/sums", f"{base}/dates"


def _add_gold(spark: SparkSession, served_path: str, signed: DataFrame, run: Run | None) -> None:
    sums, by_date = _gold_paths(served_path)
    # Both tables read it: the joins behind the scores run once.
    signed, spooled = spool(signed.select(*GOLD_COLUMNS, "risk_score", "risk_tier", "sign"))
    try:
        add_to_table(spark, sums, G.summary_sums(signed), G.SUM_KEYS, run=run)
        add_to_table(spark, by_date, G.date_sums(signed), G.DATE_KEYS, run=run)
    finally:
        remove_path(spark, spooled)


def _maintain_gold(spark, served_path, rows, deltas, before, run, held) -> None:
    """Take the old contributions of all rows whose score or place changes from
    the gold sums, and add their new ones."""
    if before is None:
        signed = score_recalls(rows).withColumn("sign", F.lit(1))
        return _add_gold(spark, served_path, signed, run)
    if not table_exists(spark, _gold_paths(served_path)[0]):  # maintained from now on
        _add_gold(spark, served_path, served_table(spark, served_path).withColumn("sign", F.lit(1)), None)
    # Firms of the batch and of the rows it replaces: no more than those rows.
    moved = deltas.groupBy(F.col(FIRM_KEY).alias("_firm")).agg(F.sum("n").alias("delta"))
    known = before.select(F.col(FIRM_KEY).alias("_known"), F.col("n").alias("n_before"))
    firms = moved.join(known, moved["_firm"].eqNullSafe(known["_known"]), "left").select(
        "_firm", F.coalesce("n_before", F.lit(0)).alias("n_before"), "delta"
    ).withColumn("n_after", F.col("n_before") + F.col("delta")).withColumn(
        "rescored", ~scores.repeated_company_score(F.col("n_before") - 1).eqNullSafe(scores.repeated_company_score(F.col("n_after") - 1))
    ).persist()
    held.append(firms)
    small = checked_broadcast(firms)
    keys = checked_broadcast(rows.select(F.col(KEYS[0]).alias("_key")))
    served = read_table(spark, served_path).select(*KEYS, *GOLD_COLUMNS)
    old, spooled = spool(served.join(small, served[FIRM_KEY].eqNullSafe(small["_firm"]), "left").join(
        keys, served[KEYS[0]] == keys["_key"], "left"
    ).filter("rescored or _key is not null").select(*GOLD_COLUMNS, "n_before", "n_after", "_key"))
    held.append(Spooled(spark, spooled))
    new = rows.join(small, rows[FIRM_KEY].eqNullSafe(small["_firm"]), "left")
    kept = old.filter("_key is null")

    def signed(df, count, sign):
        counted = df.withColumn("repeated_company_count", F.col(count) - 1).select(*GOLD_COLUMNS, "repeated_company_count")
        return add_scores(counted).withColumn("sign", F.lit(sign))

    changes = signed(old, "n_before", -1).unionByName(signed(kept, "n_after", 1)).unionByName(signed(new, "n_after", 1))
    _add_gold(spark, served_path, changes, run)


def maintained_gold(spark: SparkSession, served_path: str) -> dict[str, DataFrame]:
    """The nine gold tables of a history table whose summaries are
    maintained, as one commit left them."""
    def look():
        return [current_commit(spark, p) for p in (served_path, counts_path(served_path), *_gold_paths(served_path))]

    state = look()
    while True:
        sums, by_date = (read_table(spark, p) for p in _gold_paths(served_path))
        table = served_table(spark, served_path)
        if (now := look()) == state:
            break
        state = now
    out = {name: G.summary_from_sums(sums, by_date, name) for name in G.SUMMARY_SETS}
    out["open_recall_aging"] = G.open_recall_aging(table)
    out["company_watchlist"] = G.company_watchlist(out["company_risk"])
    return out


def incremental_refresh(
    spark: SparkSession,
    bronze_dir: str,
    served_path: str,
    checkpoint: str,
    history: bool = False,
    report_start: str | None = None,
    report_end: str | None = None,
    multiline: bool = False,
    max_files_per_trigger: int | None = None,
    lookback_days: int | None = None,
    as_of: str | None = None,
    on_loss: str = "error",
    rejects_path: str | None = None,
    gold: bool = False,
):
    """Process every bronze file landed under ``bronze_dir`` since the last
    run, then stop. Returns the finished StreamingQuery.

    ``gold`` keeps the gold summaries up to date beside a table with ``history``.

    ``lookback_days`` keeps only records reported in the rolling window up
    to ``as_of`` (see :func:`rolling_window`), which is how a daily run over
    a complete export catches late and corrected records without reloading
    the past; it excludes fixed bounds. Files that hold one document over many
    lines are recognised within a batch; ``multiline`` says that all do, which saves
    their first reading. Rejects of a batch are written to
    ``<rejects_path>/batch=<n>`` (default: ``<served_path>_rejects``).
    """
    if gold and not history:
        raise ValueError("gold summaries are maintained beside a table with history")
    if lookback_days is not None:
        if report_start or report_end:
            raise ValueError("give either lookback_days or fixed report dates")
        report_start, report_end = rolling_window(lookback_days, as_of)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    texts = _texts(reader, bronze_dir, multiline)
    rejects = (rejects_path or f"{served_path.rstrip('/')}_rejects").rstrip("/")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        session.conf.set(SHUFFLE_CLEANUP, "true")
        landed = land_texts(session, batch, multiline, on_loss, f"{rejects}/batch={epoch_id}")
        merge_batch(session, landed.records, served_path, history, report_start, report_end, gold)
        landed.discard()

    q = (
        texts.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def served_table(spark: SparkSession, served_path: str) -> DataFrame:
    """The served recalls with their scores. A history table gets them here
    from the maintained firm counts: one join and a projection. Both tables are
    taken as one commit left them."""
    table = read_table(spark, served_path)
    if "risk_score" not in table.columns:
        counts = counts_path(served_path)
        state = current_commit(spark, served_path)
        table, n = read_table(spark, served_path), None
        if table_exists(spark, counts):
            n = read_table(spark, counts)
            while (now := current_commit(spark, served_path)) != state:  # a batch was committed meanwhile
                state, table, n = now, read_table(spark, served_path), read_table(spark, counts)
        table = score_recalls(table.select(*SILVER_COLUMNS), counts=n)
    return table.select(*SCORED_COLUMNS)

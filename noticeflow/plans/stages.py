"""Composite runs: bronze -> silver -> window -> quality -> score -> gold -> load.

DataFrames compose end to end; tables are materialised only at silver,
scored and gold (plus the serving store), which is also where lineage is
cut - a lost executor recomputes from the last written table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, quality
from ..operators.explore import filter_report_date
from ..operators.scoring import score_recalls
from ..operators.silver import silver_projection
from ..schemas import SERVING_TABLES
from ..sources import bronze, serving
from ..sources.tables import Run, read_table, remove_path, write_table


def bronze_to_silver(
    spark: SparkSession,
    bronze_path,
    silver_path: str,
    multiline: bool | None = None,
    report_start: str | None = None,
    report_end: str | None = None,
) -> DataFrame:
    """Read bronze documents, project to silver (optionally keeping a
    report-date window), write Parquet; returns the written table. A document
    that cannot be read is an error."""
    return write_silver(bronze.read_bronze(spark, bronze_path, multiline), silver_path, report_start, report_end)


def write_silver(records: DataFrame, silver_path: str, report_start: str | None = None, report_end: str | None = None) -> DataFrame:
    silver = filter_report_date(silver_projection(records), report_start, report_end)
    write_table(silver, silver_path)
    return read_table(silver.sparkSession, silver_path)


def build_gold(spark: SparkSession, scored_path: str, gold_dir: str) -> dict[str, str]:
    """Write the nine gold tables from the scored table; returns name -> path.

    The seven group-by summaries come from one GROUPING SETS pass (one
    scan, one shuffle), written once as a small table and cut into the
    seven tables; open-recall aging is one filtered scan; the watchlist is
    sorted from the written company table. Two scans of the scored table
    in total instead of nine, with no cache of it.
    """
    base = gold_dir.rstrip("/")
    sets_path = f"{base}/_summary_sets"
    # By summary, so that each table reads its own rows only.
    summary = gold.summary_sets(read_table(spark, scored_path))
    write_table(summary, sets_path, partition_by=["_set"])
    sets = spark.read.schema(summary.schema).parquet(sets_path)  # without rows there is no file to tell it
    paths = {name: f"{base}/{name}" for name in gold.SUMMARY_SETS}
    writes = [(gold.summary_from_sets(sets, name), paths[name]) for name in gold.SUMMARY_SETS]
    paths["open_recall_aging"] = f"{base}/open_recall_aging"
    writes.append((gold.open_recall_aging(read_table(spark, scored_path)), paths["open_recall_aging"]))
    run_concurrently([lambda df=df, p=p: write_table(df, p) for df, p in writes])
    paths["company_watchlist"] = f"{base}/company_watchlist"
    write_table(gold.company_watchlist(read_table(spark, paths["company_risk"])), paths["company_watchlist"])
    return paths


def run_concurrently(actions, max_workers: int = 8):
    """Submit independent Spark actions from threads so small jobs share
    the cluster instead of queueing one after another."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        return [f.result() for f in [pool.submit(a) for a in actions]]


def serving_sources(spark: SparkSession, scored_path: str, gold_paths: dict[str, str]) -> dict[str, DataFrame]:
    out = {}
    for name, spec in SERVING_TABLES.items():
        src = spec["gold"]
        out[name] = read_table(spark, scored_path if src == "scored" else gold_paths[src])
    return out


# The warning of a run that found nothing: a fixed value of the run log.
EMPTY_WARNING = "No records found for requested date window."


def run_stages(
    spark: SparkSession,
    bronze_path: str,
    out_dir: str,
    report_start: str | None = None,
    report_end: str | None = None,
    load: bool = False,
    replace: bool = False,
    tables: list[str] | None = None,
    multiline: bool | None = None,
    now=None,
    archives: bool = False,
    on_loss: str = "error",
) -> dict:
    """The full batch run. It ends early, as success, only if every document
    announces exactly 0 records; documents without that number are read.
    A window that holds no record gives empty tables and a warning. The
    documents' warning is passed on to the result and the run log.
    ``archives`` takes ``bronze_path`` as a folder of ZIP exports.

    Documents are parsed once; unreadable ones go to ``<out_dir>/rejects``
    and are an error, or with ``on_loss="warn"`` a warning. With ``load`` the serving
    tables and the row of the run log become current in one commit; a
    failed run changes no table and is logged with its error.
    """
    base = out_dir.rstrip("/")
    args = (report_start, report_end, load, replace, tables, multiline, now, archives, on_loss)
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    try:
        return _run(spark, bronze_path, base, started, *args)
    except Exception as e:
        if load:
            serving.append_run_log(
                spark, f"{base}/pipeline_runs", None, bronze_path, None, 0, "failed", error=f"{type(e).__name__}: {e}"[:2000],
                started_at=started,
            )
        raise


def _run(spark, bronze_path, base, started, report_start, report_end, load, replace, tables, multiline, now, archives, on_loss):
    run = Run(spark, f"{base}/serving")
    log = lambda *args: serving.append_run_log(
        spark, f"{base}/pipeline_runs", source, bronze_path, *args, started_at=started, run=run
    )
    documents_path = bronze.unpack_archives(spark, bronze_path) if archives else bronze_path
    landed = bronze.land_bronze(spark, documents_path, False if archives else multiline, on_loss, f"{base}/rejects")
    if archives:
        remove_path(spark, documents_path)
    source, fetched = landed.source, landed.announced
    warnings = [w for w in (landed.warning, landed.loss) if w]
    result = {"status": "success", "bronze_path": bronze_path, "records_fetched": fetched, "loaded": {}}
    if landed.announces_nothing:
        warning = "; ".join(warnings) or EMPTY_WARNING
        if load:
            log(0, 0, "success", warning)
            run.commit()
        landed.discard()
        return result | {"records_fetched": 0, "warning": warning}

    silver_path, scored_path = f"{base}/silver", f"{base}/scored"
    # The report-date window is applied before silver is written (one write,
    # the same table as writing everything and rewriting it filtered).
    silver = write_silver(landed.records, silver_path, report_start, report_end)
    landed.discard()
    if silver.isEmpty():
        warnings.append(EMPTY_WARNING)
    warning = "; ".join(warnings) or None
    write_table(quality.dq_report(silver), f"{base}/data_quality_report")
    write_table(score_recalls(silver), scored_path)
    gold_paths = build_gold(spark, scored_path, f"{base}/gold")
    if load:
        counts = serving.load_tables(
            spark, serving_sources(spark, scored_path, gold_paths), f"{base}/serving", tables, replace, now, run
        )
        result["loaded"] = {r["table"]: r["loaded"] for r in counts.collect()}
        log(fetched, result["loaded"].get("recalls", 0), "success", warning)
        run.commit()
    return result | {"warning": warning, "scored_path": scored_path, "gold": gold_paths}


def refresh_stages(spark: SparkSession, bronze_path: str, out_dir: str, multiline: bool | None = None) -> dict:
    """Rebuild silver, quality, scores and gold with no date window and no load."""
    return run_stages(spark, bronze_path, out_dir, multiline=multiline)

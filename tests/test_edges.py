"""Hand-made edge inputs: empty documents, sparse records, archives,
upserts, search wildcards, half-even means and tier boundaries."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from noticeflow.functions import risk_tier, risk_tier_bins
from noticeflow.operators import explore, quality
from noticeflow.operators.silver import silver_projection
from noticeflow.plans.stages import run_stages
from noticeflow.sources import bronze, serving, tables


def _write_doc(path, doc):
    path.write_text(json.dumps(doc), encoding="utf-8")
    return str(path)


def test_empty_document_gives_zero_rows_and_early_exit(spark, tmp_path):
    p = _write_doc(tmp_path / "empty.json", {"meta": {"records_fetched": 0}, "results": []})
    assert bronze.read_bronze(spark, p, multiline=True).count() == 0
    out = run_stages(spark, p, str(tmp_path / "run"), load=True, multiline=True)
    assert out["records_fetched"] == 0 and out["status"] == "success"
    log = tables.read_table(spark, str(tmp_path / "run" / "pipeline_runs")).collect()
    assert len(log) == 1 and log[0]["records_loaded"] == 0 and log[0]["warning"]


def test_sparse_record_reads_nulls(spark, tmp_path):
    p = _write_doc(tmp_path / "one.json", {"results": [{"recall_number": "F-9"}]})
    row = silver_projection(bronze.read_bronze(spark, p, multiline=True)).first()
    assert row["recall_number"] == "F-9"
    assert row["status"] is None and row["is_open"] is None
    assert row["recall_reason_category"] == "Other" and row["region"] == "Unknown"
    assert row["recall_duration_days"] is None


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    path.write_bytes(buf.getvalue())


def test_archives_read_first_json_member(spark, tmp_path):
    d = tmp_path / "zips"
    d.mkdir()
    _zip(d / "a.zip", {"readme.txt": "x", "a.json": json.dumps({"results": [{"recall_number": "A-1"}, {"recall_number": "A-2"}]})})
    _zip(d / "b.zip", {"b.json": json.dumps({"results": [{"recall_number": "B-1", "state": "TX"}]})})
    rows = bronze.read_bronze_archives(spark, str(d)).orderBy("recall_number").collect()
    assert [r["recall_number"] for r in rows] == ["A-1", "A-2", "B-1"]
    assert rows[2]["state"] == "TX" and rows[0]["state"] is None


def test_archive_without_json_is_an_error(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    _zip(d / "c.zip", {"notes.txt": "no json here"})
    with pytest.raises(Exception, match="No JSON file found"):
        bronze.read_bronze_archives(spark, str(d)).count()


def test_empty_archive_listing_is_an_error(spark, tmp_path):
    d = tmp_path / "none"
    d.mkdir()
    (d / "x.txt").write_text("not a zip")
    with pytest.raises(Exception):
        bronze.read_bronze_archives(spark, str(d)).count()


def _rows(spark, data):
    return spark.createDataFrame(data, "recall_number string, report_date date, status string")


def test_upsert_fills_keys_dedupes_and_is_idempotent(spark, tmp_path):
    import datetime as dt

    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    path = str(tmp_path / "recalls")
    first = _rows(spark, [("F-1", d1, "Ongoing"), ("F-2", d1, "Ongoing"), (None, d1, "a"), ("", d2, "b")])
    assert serving.upsert_table(spark, path, first, ["recall_number"], "2020-03-01 00:00:00") == 4
    got = {r["recall_number"]: r["status"] for r in tables.read_table(spark, path).collect()}
    # NULL and '' collide on 'Unknown'; the later report date wins
    assert got == {"F-1": "Ongoing", "F-2": "Ongoing", "Unknown": "b"}
    second = _rows(spark, [("F-2", d2, "Terminated"), ("F-3", d2, "Ongoing")])
    serving.upsert_table(spark, path, second, ["recall_number"], "2020-03-02 00:00:00")
    once = sorted(tuple(r) for r in tables.read_table(spark, path).drop("updated_at").collect())
    serving.upsert_table(spark, path, second, ["recall_number"], "2020-03-03 00:00:00")
    twice = sorted(tuple(r) for r in tables.read_table(spark, path).drop("updated_at").collect())
    assert once == twice
    assert dict((r[0], r[2]) for r in twice) == {"F-1": "Ongoing", "F-2": "Terminated", "F-3": "Ongoing", "Unknown": "b"}
    assert serving.upsert_table(spark, path, second.limit(0), ["recall_number"]) == 0


def test_search_wildcards_case_and_backslash(spark):
    df = spark.createDataFrame(
        [("F-100", "Acme 50% Off"), ("F-1X0", "Beta"), ("F-200", "gamma\\delta"), ("G-1", None)],
        "recall_number string, recalling_firm string",
    )
    ids = lambda d: sorted(r["recall_number"] for r in d.collect())
    assert ids(explore.text_search(df, "f-1_0")) == ["F-100", "F-1X0"]
    assert ids(explore.text_search(df, "ACME 50%")) == ["F-100"]
    assert ids(explore.text_search(df, "a\\d")) == ["F-200"]
    assert ids(explore.text_search_literal(df, "f-1_0")) == []
    assert ids(explore.text_search_literal(df, "50% OFF")) == ["F-100"]
    assert explore.text_search(df, "").count() == 4


def test_kpi_mean_rounds_half_even(spark):
    for scores, expected in [([2.0, 2.5], 2.2), ([2.5, 3.0], 2.8), ([1.0, 1.5], 1.2)]:
        df = spark.createDataFrame([(s, "Low", "Ongoing", None) for s in scores],
                                   "risk_score double, risk_tier string, status string, report_date date")
        row = explore.kpis(df).first()
        assert row["avg_risk"] == expected
        assert row["latest_report"] == "N/A"
    empty = spark.createDataFrame([], "risk_score double, risk_tier string, status string, report_date date")
    row = explore.kpis(empty).first()
    assert row["recalls"] == 0 and row["avg_risk"] == 0.0


def test_tier_rules_at_boundaries(spark):
    vals = [39.0, 40.0, 69.0, 70.0, 89.0, 90.0, 39.5, -5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = df.select(risk_tier("s").alias("t"), risk_tier_bins("s").alias("b"),
                    risk_tier_bins("s", strict_reference=True).alias("bs")).collect()
    assert [r["t"] for r in got] == ["Low", "Medium", "Medium", "High", "High", "Critical", "Low", "Low", "Low"]
    assert [r["b"] for r in got] == ["Low", "Medium", "Medium", "High", "High", "Critical", "Medium", None, None]
    assert got[-1]["bs"] == "nan" and got[-2]["bs"] == "nan"


def test_dq_long_report_rules(spark):
    empty = spark.createDataFrame([], "recall_number string, report_date date, risk_score int")
    assert quality.dq_report_long(empty).count() == 0
    df = spark.createDataFrame([("F-1", None, 120), ("F-1", None, None)], "recall_number string, report_date date, risk_score int")
    rows = {r["metric"]: (r["value"], r["status"]) for r in quality.dq_report_long(df).collect()}
    assert rows["Duplicate recall numbers"] == ("1", "Review")
    assert "Earliest report date" not in rows and "Missing classification" not in rows
    assert rows["Missing or invalid risk scores"] == ("2", "Review")
    strict = quality.invalid_scores(df, strict_reference=True).first()["invalid_scores"]
    assert strict == 3


def test_option_list_and_backfill(spark):
    df = spark.createDataFrame([("TX",), ("",), (None,), ("AZ",), ("TX",)], "state string")
    assert [r["option"] for r in explore.option_list(df, "state").collect()] == ["All", "AZ", "TX"]
    assert [r["option"] for r in explore.option_list(df, "nope").collect()] == ["All"]
    filled = serving.backfill_columns(df)
    assert set(filled.columns) == {"state", "product_category", "distribution_scope"}


def test_serving_rows_nan_and_dates(spark):
    import datetime as dt

    df = spark.createDataFrame([(float("nan"), dt.date(2020, 5, 6)), (1.5, None)], "x double, d date")
    rows = serving.to_serving_rows(df, "2020-01-01 00:00:00").collect()
    assert rows[0]["x"] is None and rows[0]["d"] == "2020-05-06" and rows[1]["x"] == 1.5
    back = serving.normalize_dates(
        spark.createDataFrame([("2020-05-06",), ("garbage",)], "report_date string")
    ).collect()
    assert back[0]["report_date"] == dt.date(2020, 5, 6) and back[1]["report_date"] is None


def test_source_window_bounds(spark):
    df = spark.createDataFrame([("20200101",), ("20200215",), ("20200301",), ("",)], "report_date string")
    got = lambda d: sorted(r["report_date"] for r in d.collect())
    assert got(bronze.source_window(df, "report_date", "2020-01-01", "20200215")) == ["20200101", "20200215"]
    assert got(bronze.source_window(df, "report_date", None, "2020-02-01")) == ["20200101"]
    assert got(bronze.source_window(df, "report_date", "2020-02-01", None, today="2020-12-31")) == ["20200215", "20200301"]
    assert len(got(bronze.source_window(df))) == 4
    assert got(bronze.source_window(df, limit=2)) == ["20200101", "20200215"]
    assert F is not None


def test_stream_restart_is_idempotent_and_picks_up_new_files(spark, tmp_path):
    from noticeflow.sources.fixture import recall_records
    from noticeflow.streaming.incremental import incremental_refresh, served_table

    from .conftest import SF_SMALL

    recs = recall_records(spark, SF_SMALL)
    land, served, ckpt = str(tmp_path / "land"), str(tmp_path / "served"), str(tmp_path / "ckpt")
    bronze.write_bronze(recs.filter(F.col("report_date") < "19980101"), f"{land}/d1", {"source": "t"})
    incremental_refresh(spark, f"{land}/*", served, ckpt, history=True)
    first = served_table(spark, served).count()
    incremental_refresh(spark, f"{land}/*", served, ckpt, history=True)  # nothing new
    assert served_table(spark, served).count() == first
    bronze.write_bronze(recs.filter(F.col("report_date") >= "19980101"), f"{land}/d2", {"source": "t"})
    incremental_refresh(spark, f"{land}/*", served, ckpt, history=True)
    total = served_table(spark, served)
    keys = recs.select(F.coalesce("recall_number", F.lit("Unknown")).alias("k")).distinct().count()
    assert total.count() == keys
    # with history, scores equal a rebuild over the same de-duplicated rows
    from noticeflow.operators.scoring import score_recalls
    from noticeflow.operators.silver import silver_projection
    from noticeflow.schemas import SCORED_COLUMNS
    from noticeflow.sources.serving import dedupe_latest, fill_keys

    rebuild = score_recalls(dedupe_latest(fill_keys(silver_projection(recs), ["recall_number"]), ["recall_number"]))
    a, b = total.select(*SCORED_COLUMNS), rebuild.select(*SCORED_COLUMNS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partitioned_upsert_moves_rows_and_drops_emptied_partitions(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "served")
    part = F.coalesce(F.date_format("report_date", "yyyy-MM"), F.lit("none"))
    rows = lambda data: spark.createDataFrame(data, "recall_number string, report_date date, status string")
    first = rows([("A", dt.date(2020, 1, 5), "Ongoing"), ("B", dt.date(2020, 2, 5), "Ongoing"),
                  ("C", dt.date(2020, 2, 9), "Ongoing"), (None, None, "x")])
    assert serving.upsert_partitioned(spark, path, first, ["recall_number"], "report_month", part) == 4
    # A is corrected into March: January becomes empty and must vanish
    second = rows([("A", dt.date(2020, 3, 1), "Terminated"), ("D", dt.date(2020, 2, 20), "Ongoing")])
    assert serving.upsert_partitioned(spark, path, second, ["recall_number"], "report_month", part) == 2
    got = {(r["recall_number"], r["report_month"], r["status"]) for r in tables.read_table(spark, path).collect()}
    assert got == {("A", "2020-03", "Terminated"), ("B", "2020-02", "Ongoing"), ("C", "2020-02", "Ongoing"),
                   ("D", "2020-02", "Ongoing"), ("Unknown", "none", "x")}
    assert not (tmp_path / "served" / "report_month=2020-01").exists()
    # the same batch again changes nothing but the stamp
    serving.upsert_partitioned(spark, path, second, ["recall_number"], "report_month", part)
    again = {(r["recall_number"], r["report_month"], r["status"]) for r in tables.read_table(spark, path).collect()}
    assert again == got


def test_replace_load_of_all_tables(spark, tmp_path):
    from noticeflow.operators import gold
    from noticeflow.operators.scoring import score_recalls
    from noticeflow.schemas import SERVING_TABLES
    from noticeflow.sources.fixture import recall_records

    from .conftest import SF_SMALL

    sc = score_recalls(silver_projection(recall_records(spark, SF_SMALL)))
    g = gold.gold_tables(sc)
    sources = {n: (sc if s["gold"] == "scored" else g[s["gold"]]) for n, s in SERVING_TABLES.items()}
    store = str(tmp_path / "serving")
    first = {r["table"]: r["loaded"] for r in serving.load_tables(spark, sources, store, replace=True).collect()}
    again = {r["table"]: r["loaded"] for r in serving.load_tables(spark, sources, store, replace=True).collect()}
    assert first == again and first["recalls"] == sc.count()
    served = tables.read_table(spark, f"{store}/recalls")
    assert "report_month" in served.columns
    # keys are unique after the fill + de-duplication
    assert served.count() == served.select("recall_number").distinct().count()
    assert served.filter(F.col("recall_number") == "Unknown").count() == 1

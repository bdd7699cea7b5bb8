"""Batch runs: documents without metadata, warnings, archives, written tables."""

import json
import os
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from noticeflow.functions import compute_risk_score
from noticeflow.operators import explore, gold
from noticeflow.operators.partitioning import checked_broadcast, spread_scan
from noticeflow.plans import catalog, stages
from noticeflow.sources import bronze as B
from noticeflow.sources import tables as T

from .conftest import SF_SMALL
from .oracle_harness import _norm, duck

RECORD = {"recall_number": "Z-1", "status": "Ongoing", "classification": "Class II", "report_date": "20200102", "recalling_firm": "Mill"}


def land(path, *documents):
    os.makedirs(path)
    with open(f"{path}/d.json", "w", encoding="utf-8") as f:
        f.writelines(json.dumps(d) + "\n" for d in documents)
    return path


def run(spark, tmp_uri, *documents, **more):
    out = f"{tmp_uri}/out"
    result = stages.run_stages(spark, land(f"{tmp_uri}/in", *documents), out, load=True, **more)
    return result, T.read_table(spark, f"{out}/pipeline_runs").first()


@pytest.mark.parametrize("documents,fetched", [
    ([{"results": [RECORD]}], 1),
    ([{"meta": {"records_fetched": 0}, "results": []}, {"results": [RECORD]}], 1),
    ([{"meta": {"source": "s"}, "results": [RECORD, RECORD]}], 2),
])
def test_documents_that_do_not_announce_a_number_are_read(spark, tmp_uri, documents, fetched):
    result, log = run(spark, tmp_uri, *documents, tables=["recalls"])
    assert (result["records_fetched"], log.records_fetched, log.warning) == (fetched, fetched, None)
    assert T.read_table(spark, f"{tmp_uri}/out/serving/recalls").count() == 1


def test_an_announced_zero_ends_early(spark, tmp_uri):
    result, log = run(spark, tmp_uri, {"meta": {"records_fetched": 0, "source": "s"}, "results": [RECORD]})
    assert result["records_fetched"] == 0 and not os.path.exists(f"{tmp_uri}/out/silver")
    assert (log.source, log.warning) == ("s", stages.EMPTY_WARNING)


def test_warning_and_source_reach_the_log(spark, tmp_uri):
    meta = {"records_fetched": 1, "source": "s", "warning": "partial export"}
    result, log = run(spark, tmp_uri, {"meta": meta, "results": [RECORD]}, tables=["recalls"])
    assert result["warning"] == log.warning == "partial export" and log.source == "s"


def test_an_empty_drop_keeps_its_metadata(spark, tmp_uri):
    none = spark.createDataFrame([], ", ".join(f"{f} string" for f in B.RECORD_FIELDS))
    B.write_bronze(none, f"{tmp_uri}/in", {"source": "s", "warning": "nothing new"})
    result = stages.run_stages(spark, f"{tmp_uri}/in", f"{tmp_uri}/out", load=True)
    log = T.read_table(spark, f"{tmp_uri}/out/pipeline_runs").first()
    assert (log.source, log.warning, result["records_fetched"]) == ("s", "nothing new", 0)


# ------------------------------------------------------------------ archives


def pack(path, text, name="x.json"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("readme.txt", "no")
        z.writestr(name, text)


def test_archives_are_streamed_in_any_layout(spark, tmp_uri):
    records = [RECORD | {"recall_number": f"Z-{i}", "city": 'a "b", [c]\n{é}'} for i in range(2500)]
    pack(f"{tmp_uri}/a.zip", json.dumps({"results": records, "meta": {"records_fetched": 2500}}, indent=1))
    pack(f"{tmp_uri}/b.zip", json.dumps({"meta": {"skip": 1.5}, "more": [1, [2]], "results": []}))
    pack(f"{tmp_uri}/c.zip", "﻿ " + json.dumps({"results": records[:1]}, ensure_ascii=False))
    got = B.read_bronze_archives(spark, f"{tmp_uri}")
    assert got.count() == 2501 and got.select("recall_number").distinct().count() == 2500
    assert {r.city for r in got.select("city").distinct().collect()} == {'a "b", [c]\n{é}'}
    folder = B.unpack_archives(spark, f"file://{tmp_uri}")
    documents = B.read_bronze_documents(spark, folder)
    assert documents.select(F.max(F.size("results"))).first()[0] == B.DOCUMENT_RECORDS  # split, not one huge row


def test_bad_archives_are_errors(spark, tmp_uri):
    with pytest.raises(RuntimeError, match="No archives"):
        B.read_bronze_archives(spark, tmp_uri)
    pack(f"{tmp_uri}/a.zip", "x", "x.txt")
    with pytest.raises(Exception, match="No JSON file"):
        B.read_bronze_archives(spark, tmp_uri)


def test_json_values_need_little_text_at_a_time():
    import io

    document = {"a": [1, 23, {"b": "]}"}], "c": None, "d": "x\\\"y", "e": [], "f": -1.5e3}
    for chunk in (1, 2, 7, 1000):
        got = list(B._json_values(io.StringIO(json.dumps(document) + " "), chunk))
        assert [(k, json.loads(v)) for k, v in got] == [
            ("a", 1), ("a", 23), ("a", {"b": "]}"}), ("c", None), ("d", "x\\\"y"), ("f", -1500.0)]
    for broken in ('{"a": [1, 2', "[1]", '{"a" 1}'):
        with pytest.raises(ValueError):
            list(B._json_values(io.StringIO(broken)))


def test_workers_import_the_package_from_any_folder(tmp_uri):
    """A driver that only puts the repository on its own path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from noticeflow.session import local_session\n"
        "from noticeflow.plans.catalog import QUERIES\n"
        "s = local_session(2, 4)\n"
        f"print('rows', QUERIES['read_bronze_archives'](s, {SF_SMALL!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_uri, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 1" in done.stdout, done.stderr[-2000:]


# ------------------------------------------------------------ written tables


@pytest.fixture(scope="module")
def written(spark):
    from noticeflow.session import scratch_path

    out = scratch_path(spark, "run")
    return stages.run_stages(spark, catalog._bronze(spark, SF_SMALL), out)


@pytest.mark.parametrize("name", [
    "recall_overview", "recall_reason_summary", "company_risk", "company_watchlist", "monthly_recall_trends",
    "geographic_recall_summary", "risk_tier_summary", "product_category_summary", "open_recall_aging",
])
def test_contents_of_every_gold_table(spark, written, name):
    table = T.read_table(spark, written["gold"][name])
    res = duck(SF_SMALL).execute(catalog.ORACLE[name])
    names = [x[0] for x in res.description]
    want = sorted(tuple(_norm(x) for x in r) for r in res.fetchall())
    assert sorted(tuple(_norm(x) for x in r) for r in table.select(*names).collect()) == want


def test_open_recalls_are_filtered_in_the_scan(spark, written):
    df = gold.open_recall_aging(T.read_table(spark, written["scored_path"]))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(is_open,true)" in plan.replace(" ", "")


# -------------------------------------------------------------------- values


def test_unknown_repeat_count_scores_nothing(spark):
    df = spark.createDataFrame([(None,), (3,), (50,)], "n long")
    got = df.select(compute_risk_score(F.lit("Class I"), F.lit("Ongoing"), F.lit("Nationwide"), F.lit("Labeling Issue"), "n").alias("x"))
    assert [r.x for r in got.collect()] == [100, 106, 120]


def test_kpis_of_a_frame_without_their_columns(spark):
    row = explore.kpis(spark.range(3)).first()
    assert (row.recalls, row.critical, row.ongoing, row.avg_risk, row.latest_report) == (3, 0, 0, 0.0, "N/A")


def test_explore_input_repair(spark):
    df = spark.createDataFrame([("2020-01-05", 45), ("bad", 85)], "report_date string, risk_score long")
    rows = explore.prepare_explore_input(df).collect()
    assert [str(r.report_date) for r in rows] == ["2020-01-05", "None"]
    assert all(r.risk_tier and r.product_category == "Unknown" for r in rows)


def test_first_non_empty_takes_a_primary_with_rows(spark):
    assert T.first_non_empty(lambda: spark.range(2), lambda: spark.range(9)).count() == 2
    assert T.first_non_empty(spark.range(0), spark.range(9)).count() == 9


def test_broadcast_is_checked_by_rows_and_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(checked_broadcast(df))
    assert not hinted(checked_broadcast(df, max_rows=9))
    assert not hinted(checked_broadcast(df, max_bytes=9_000))


def test_scans_are_spread_only_on_request(spark):
    df = spark.range(10)
    keep = spark.conf.get("spark.noticeflow.scanPartitions", None)
    spark.conf.unset("spark.noticeflow.scanPartitions")
    try:
        assert spread_scan(df) is df
        assert spread_scan(df, 3).rdd.getNumPartitions() == 3
    finally:
        if keep:
            spark.conf.set("spark.noticeflow.scanPartitions", keep)

"""Landed documents: one parse, rejects and counts, any layout, empty windows."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from noticeflow.plans import stages
from noticeflow.sources import bronze as B
from noticeflow.sources import serving as S
from noticeflow.sources import tables as T
from noticeflow.streaming import incremental as I

A, Z = {"recall_number": "A", "report_date": "20200105"}, {"recall_number": "Z", "city": 'q " } ] {', "report_date": "20200106"}
GOOD = json.dumps({"meta": {"source": "s", "records_fetched": 2}, "results": [A, Z]})
CUT = GOOD[:-25]
PRETTY = json.dumps({"meta": {"records_fetched": 2}, "results": [A, Z]}, indent=2)


def land(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.json", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def numbers(df):
    return sorted(r.recall_number for r in df.collect())


def test_a_cut_line_is_a_reject_with_its_file_and_text(spark, tmp_uri):
    path = land(f"{tmp_uri}/in", x=GOOD + "\n" + CUT + "\n")
    with pytest.raises(B.LostRecords, match="1 unreadable document"):
        B.land_bronze(spark, path, rejects_path=f"{tmp_uri}/rejects")
    found = B.land_bronze(spark, path, on_loss="warn")
    assert numbers(found.records) == ["A", "Z"]
    assert (found.documents, found.rejected, found.announced, found.held, found.source) == (1, 1, 2, 2, "s")
    for table in (found.rejects, T.read_table(spark, f"{tmp_uri}/rejects")):
        row = table.first()
        assert row.file.endswith("/x.json") and row.text == CUT and table.count() == 1
    with pytest.raises(Exception, match="unreadable document"):
        B.read_bronze(spark, path).count()
    found.discard()


@pytest.mark.parametrize("files,records,rejects", [
    ({"p": PRETTY}, 2, 0), ({"p": PRETTY, "q": PRETTY}, 4, 0), ({"p": PRETTY, "x": GOOD}, 4, 0),
    ({"p": PRETTY[:-30], "x": GOOD}, 2, 1), ({"p": PRETTY[:-30]}, 0, 1), ({"p": "﻿" + PRETTY, "x": "﻿" + GOOD + "\r\n\n"}, 4, 0),
    ({"x": CUT + "\n" + CUT + "\n"}, 0, 2), ({"x": GOOD + GOOD}, 0, 1), ({"x": GOOD + " junk"}, 0, 1), ({"x": GOOD + "," }, 0, 1), ({"x": "{}\n[]\nnull\n5"}, 0, 1),
    ({"x": "{}\n" + GOOD}, 2, 1), ({"x": json.dumps(A) + "\n" + GOOD}, 2, 1), ({"x": ""}, 0, 0), ({"x": " \n\t\n"}, 0, 0),
    ({"x": json.dumps({"results": [1, A]}) + "\n" + GOOD}, 2, 1), ({"x": json.dumps({"meta": "text", "results": [A]}) + "\n" + GOOD}, 2, 1),
    ({"x": json.dumps({"meta": {"records_fetched": "1"}, "results": [A]})}, 1, 0),
    ({"x": json.dumps({"meta": {"records_fetched": 1}, "results": [{"recall_number": 7, "city": {"x": 1}}]})}, 1, 0),
])
def test_nothing_is_lost_silently(spark, tmp_uri, files, records, rejects):
    path = land(f"{tmp_uri}/in", **files)
    found = B.land_bronze(spark, path, on_loss="warn")
    assert (found.records.count(), found.rejects.count(), found.rejected) == (records, rejects, rejects)
    if rejects:
        with pytest.raises(B.LostRecords):
            B.land_bronze(spark, path)
    one_layout = len(files) < 2 or not ("p" in files and "x" in files)
    if not rejects and one_layout:
        assert B.read_bronze(spark, path).count() == records
    elif rejects or not one_layout:
        with pytest.raises(Exception, match="unreadable document"):
            B.read_bronze(spark, path).collect()


def test_announced_records_that_are_not_there(spark, tmp_uri):
    path = land(f"{tmp_uri}/in", x=json.dumps({"meta": {"records_fetched": 5}, "results": [A, Z]}))
    with pytest.raises(B.LostRecords, match="5 records announced, 2 read"):
        B.land_bronze(spark, path)
    assert B.land_bronze(spark, path, on_loss="warn").loss == "5 records announced, 2 read"
    result = stages.run_stages(spark, path, f"{tmp_uri}/out", load=True, on_loss="warn", tables=["recalls"])
    log = T.read_table(spark, f"{tmp_uri}/out/pipeline_runs").first()
    assert result["warning"] == log.warning == "5 records announced, 2 read" and log.status == "success"
    with pytest.raises(ValueError):
        B.land_bronze(spark, path, on_loss="drop")


def test_archives_announce_their_records_once(spark, tmp_uri):
    os.makedirs(f"{tmp_uri}/z")
    with zipfile.ZipFile(f"{tmp_uri}/z/a.zip", "w") as z:
        z.writestr("a.json", json.dumps({"meta": {"records_fetched": 2500}, "results": [A] * 2500}))
    result = stages.run_stages(spark, f"{tmp_uri}/z", f"{tmp_uri}/out", load=True, archives=True, tables=["recalls"])
    assert result["records_fetched"] == 2500 and result["loaded"] == {"recalls": 2500}


def test_one_scan_of_the_documents(spark, tmp_uri):
    """The parse is one job over the files: no second scan counts records."""
    path = land(f"{tmp_uri}/in", **{f"f{i}": GOOD + "\n" for i in range(4)})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        found = B.land_bronze(spark, path, multiline=False)
        jobs = tracker.getJobIdsForGroup("landing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and found.held == 8 == found.announced


def test_metadata_keeps_its_types(spark, tmp_uri):
    meta = {"source": "s", "records_fetched": 0, "requested_limit": 10, "downloaded_files": ["a", "b"], "manifest_total_records": 7}
    row = B.bronze_meta(spark, land(f"{tmp_uri}/in", x=json.dumps({"meta": meta, "results": []}))).first()
    assert {k: row[k] for k in meta} == meta


# -------------------------------------------------------------- empty windows


@pytest.mark.parametrize("load,replace", [(False, False), (True, False), (True, True)])
def test_a_window_without_records(spark, tmp_uri, load, replace):
    path = land(f"{tmp_uri}/in", x=GOOD)
    out = f"{tmp_uri}/out"
    result = stages.run_stages(spark, path, out, report_start="2030-01-01", load=load, replace=replace)
    assert (result["status"], result["records_fetched"], result["warning"]) == ("success", 2, stages.EMPTY_WARNING)
    assert len(result["gold"]) == 9
    for p in result["gold"].values():
        assert T.read_table(spark, p).count() == 0 and T.read_table(spark, p).columns
    assert T.read_table(spark, f"{out}/data_quality_report").count() == 1
    if load:
        assert set(result["loaded"].values()) == {0} and len(result["loaded"]) == 8
        log = T.read_table(spark, f"{out}/pipeline_runs").first()
        assert (log.status, log.records_fetched, log.records_loaded, log.warning) == ("success", 2, 0, stages.EMPTY_WARNING)
        # The next day's records land in the same store.
        again = stages.run_stages(spark, path, out, load=True)
        assert again["warning"] is None and S.read_store(spark, f"{out}/serving")["recalls"].count() == 2


# ------------------------------------------------------------------- streams


@pytest.mark.parametrize("history", [False, True])
def test_a_stream_puts_rejects_aside_or_stops(spark, tmp_uri, history):
    notice = lambda n, firm, day: {"recall_number": n, "recalling_firm": firm, "report_date": day}
    land(f"{tmp_uri}/in", a=json.dumps({"results": [notice("1", "x", "20200101"), notice("2", "x", "20200201")]}) + "\n" + CUT)
    args = (spark, f"{tmp_uri}/in", f"{tmp_uri}/served", f"{tmp_uri}/ckpt")
    with pytest.raises(Exception, match="unreadable"):
        I.incremental_refresh(*args, history=history)
    assert not T.table_exists(spark, f"{tmp_uri}/served")
    I.incremental_refresh(*args, history=history, on_loss="warn")
    land(f"{tmp_uri}/in", b=json.dumps({"results": [notice("3", "x", "20200301")]}, indent=2))
    I.incremental_refresh(*args, history=history, on_loss="warn")
    assert numbers(I.served_table(spark, f"{tmp_uri}/served")) == ["1", "2", "3"]
    assert spark.read.parquet(f"{tmp_uri}/served_rejects").filter("text is not null").count() == 1


def test_maintained_counts_equal_a_whole_count(spark, tmp_uri):
    """Late, corrected, repeated and moved records, with and without a firm."""
    notice = lambda n, firm, day: {"recall_number": n, "recalling_firm": firm, "report_date": day, "status": "Ongoing"}
    drops = [
        [notice(f"R{i}", [None, "Alpha", "Beta Inc", ""][i % 4], f"2020{1 + i % 5:02d}10") for i in range(40)],
        [notice("R1", "Beta Inc", "20200510"), notice("R2", None, "20190101"), notice("N1", "New", "20200610"), notice("N1", "New", "20200611")],
        [notice("N1", "Alpha", "20200612"), notice(None, "Alpha", "20200612"), notice("", "Gamma", "20200613")],
        [notice("R1", "Beta Inc", "20200510")],
    ]
    args = (spark, f"{tmp_uri}/in", f"{tmp_uri}/served", f"{tmp_uri}/ckpt")
    for k, drop in enumerate(drops):
        land(f"{tmp_uri}/in", **{f"d{k}": json.dumps({"results": drop})})
        I.incremental_refresh(*args, history=True)
        got = sorted(map(str, I.served_table(spark, args[2]).collect()))
        table = T.read_table(spark, args[2])
        want = sorted(map(str, I.score_recalls(table.select(*I.SILVER_COLUMNS)).select(*I.SCORED_COLUMNS).collect()))
        assert got == want
    counts = {r[0]: r.n for r in T.read_table(spark, I.counts_path(args[2])).collect()}
    assert sum(counts.values()) == table.count() == 42 and "new" not in counts


def test_reading_served_history_counts_nothing(spark, tmp_uri):
    land(f"{tmp_uri}/in", d=GOOD)
    I.incremental_refresh(spark, f"{tmp_uri}/in", f"{tmp_uri}/served", f"{tmp_uri}/ckpt", history=True)
    plan = I.served_table(spark, f"{tmp_uri}/served")._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "Window" not in plan


def test_a_history_of_before_the_counts_gets_them(spark, tmp_uri):
    from .test_commits import drop, notice, records

    drop(spark, f"{tmp_uri}/d1", [notice("R1", "A", "20200101"), notice("R2", "A", "20200102")])
    drop(spark, f"{tmp_uri}/d2", [notice("R3", "A", "20200103")])
    path = f"{tmp_uri}/served"
    I.merge_batch(spark, records(spark, f"{tmp_uri}/d1"), path, history=True)
    T.remove_path(spark, I.counts_path(path))
    assert {r.repeated_company_count for r in I.served_table(spark, path).collect()} == {1}
    I.merge_batch(spark, records(spark, f"{tmp_uri}/d2"), path, history=True)
    assert {r.repeated_company_count for r in I.served_table(spark, path).collect()} == {2}


def test_maintained_gold_equals_a_rebuild(spark, tmp_uri):
    """Nine tables after each of four drops: firms that cross the cap of the
    repeat score, moved and corrected records, latest dates that fall."""
    notice = lambda n, firm, init, **more: {
        "recall_number": n, "recalling_firm": firm, "report_date": "20200110", "recall_initiation_date": init, "state": "OH",
        "country": "US", "classification": "Class I", "status": "Ongoing", "reason_for_recall": "listeria"} | more
    drops = [
        [notice(f"R{i}", [None, "Alpha", "Beta", "Gamma"][min(i % 9, 3)], f"2020{1 + i % 9:02d}01", status=["Ongoing", "Terminated"][i % 2])
         for i in range(40)] + [notice("L", "Alpha", "20211231")],
        [notice("L", "Beta", "20190101"), notice("R1", None, None, classification="Class III", state=None), notice("N", "New", "20200505")],
        [notice(f"N{i}", "New", "20200606") for i in range(14)] + [notice("N", "Alpha", "20200505", report_date="20200301")],
        [notice(f"N{i}", "Other", "20200606", product_description="cheese") for i in range(12)],
    ]
    args = (spark, f"{tmp_uri}/in", f"{tmp_uri}/served", f"{tmp_uri}/ckpt")
    text = lambda df: sorted(str(r) for r in df.select(*sorted(df.columns)).collect())
    for k, drop in enumerate(drops):
        land(f"{tmp_uri}/in", **{f"d{k}": json.dumps({"results": drop})})
        I.incremental_refresh(*args, history=True, gold=k > 0)  # starts beside an existing table
        if k:
            want = I.G.gold_tables(I.served_table(spark, args[2]))
            got = I.maintained_gold(spark, args[2])
            assert set(got) == set(want) and len(got) == 9
            for name in want:
                assert text(got[name]) == text(want[name]), (k, name)
    with pytest.raises(ValueError):
        I.incremental_refresh(*args, gold=True)


def test_documents_are_parsed_once_for_their_records(spark, tmp_uri):
    path = land(f"{tmp_uri}/in", x=GOOD + "\n")
    records = B.read_bronze(spark, path, multiline=False)
    plan = spark._jvm.PythonSQLUtils.explainString(records._jdf.queryExecution(), "simple")
    assert plan.count("from_json(StructField(d,") == 1 and numbers(records) == ["A", "Z"]


def test_lines_of_a_multiline_file_are_not_parsed_in_a_mixed_landing(spark, tmp_uri, monkeypatch):
    path = land(f"{tmp_uri}/in", p=PRETTY, x=GOOD + "\n" + CUT + "\n", c=CUT + "\n" + CUT)
    seen, write = [], B._write_parsed
    monkeypatch.setattr(B, "_write_parsed", lambda texts, to: (seen.append(write(texts, to)), seen[-1])[1])
    found = B.land_bronze(spark, path, on_loss="warn")
    assert numbers(found.records) == ["A", "A", "Z", "Z"] and (found.rejected, found.rejects.count()) == (3, 3)
    assert [s["rejected"] for s in seen] == [3, 0]  # its lines were no rejects for a while


def test_written_documents_are_compressed_files_of_bounded_size(spark, tmp_uri, monkeypatch):
    monkeypatch.setattr(B, "FILE_DOCUMENTS", 1)
    n = 3 * B.DOCUMENT_RECORDS + 500
    df = spark.range(n).coalesce(1).select(*[
        F.col("id").cast("string").alias(f) if f == "recall_number" else F.lit("some text " * 10).alias(f) for f in B.RECORD_FIELDS
    ])
    path = f"{tmp_uri}/in"
    B.write_bronze(df, path, {"source": "s"})
    files = [x for x in os.listdir(path) if x.startswith("part-")]
    assert len(files) == 4 and all(x.endswith(".gz") for x in files)
    assert sum(os.path.getsize(f"{path}/{x}") for x in files) < n * 18 * 100 / 10
    assert not B.find_layout(spark, path) and numbers(B.read_bronze(spark, path)) == sorted(map(str, range(n)))
    found = B.land_bronze(spark, path)
    assert (found.records.count(), found.documents, found.held, found.rejected, found.source) == (n, 4, n, 0, "s")
    found.discard()
    spark.createDataFrame([(PRETTY,)], "value string").coalesce(1).write.option("compression", "gzip").text(f"{tmp_uri}/pretty")
    assert B.find_layout(spark, f"{tmp_uri}/pretty") and numbers(B.read_bronze(spark, f"{tmp_uri}/pretty")) == ["A", "Z"]

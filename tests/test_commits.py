"""Atomic table commits: a write that dies at any step leaves the old table,
and the replayed write gives the table of an unbroken run."""

import os

import pytest
from pyspark.sql import functions as F

from noticeflow.schemas import SILVER_COLUMNS
from noticeflow.sources import serving as S
from noticeflow.sources import tables as T
from noticeflow.sources.bronze import explode_records, read_bronze_documents, write_bronze
from noticeflow.streaming import incremental as I

KEYS = ["k"]


@pytest.fixture(autouse=True)
def nothing_retained():
    """Here a commit deletes what it replaces; test_snapshots.py has the rest."""
    with pytest.MonkeyPatch.context() as patch:  # of its own: the tests undo theirs
        patch.setattr(T, "RETAIN_SECONDS", 0)
        yield


def month():
    return F.date_format("report_date", "yyyy-MM")


def rows(spark, values):
    df = spark.createDataFrame(values, "k string, report_date string, v int")
    return df.withColumn("report_date", F.to_date("report_date"))


def contents(spark, path):
    return sorted((r.k, str(r.report_date), r.v) for r in T.read_table(spark, path).collect())


FIRST = [("a", "2020-01-05", 1), ("b", "2020-02-05", 1), ("c", "2020-02-06", 1)]
SECOND = [("a", "2020-05-01", 2), ("d", "2020-02-07", 2)]  # a moves from January to May
AFTER = [("a", "2020-05-01", 2), ("b", "2020-02-05", 1), ("c", "2020-02-06", 1), ("d", "2020-02-07", 2)]


class Died(Exception):
    pass


def dies(monkeypatch, name, nth):
    """Let the nth call of a step of the commit fail."""
    real, calls = getattr(T, name), []

    def step(*args, **kwargs):
        calls.append(1)
        if len(calls) == nth:
            raise Died(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(T, name, step)
    if hasattr(S, name):
        monkeypatch.setattr(S, name, step)


def upsert(spark, path, values):
    return S.upsert_partitioned(spark, path, rows(spark, values), KEYS, "month", month())


@pytest.mark.parametrize("step,nth,committed", [
    ("write_clustered", 1, False), ("partition_dirs", 1, False), ("commit", 1, False),
    ("_clean", 1, True), ("remove_path", 1, True), ("remove_path", 2, True), ("remove_path", 3, True),
])
def test_upsert_survives_a_crash_at_any_step(spark, tmp_uri, monkeypatch, step, nth, committed):
    path = f"{tmp_uri}/t"
    assert upsert(spark, path, FIRST) == 3
    dies(monkeypatch, step, nth)
    with pytest.raises(Died):
        upsert(spark, path, SECOND)
    monkeypatch.undo()
    assert contents(spark, path) == (AFTER if committed else FIRST)
    assert upsert(spark, path, SECOND) == 2
    assert contents(spark, path) == AFTER
    # Only what the commit names is left: no staging, no old version.
    state = T.current_commit(spark, path)
    tops = {d.split("/")[0] for d in state["dirs"]}
    assert set(os.listdir(path)) == tops | {T.COMMITS}
    assert [n for n in os.listdir(f"{path}/{T.COMMITS}") if not n.startswith(".")] == [f"{state['number']:012d}.json"]


@pytest.mark.parametrize("step", ["commit", "_clean"])
def test_replace_and_rewrite_are_atomic(spark, tmp_uri, monkeypatch, step):
    path = f"{tmp_uri}/t"
    S.replace_load(spark, path, rows(spark, FIRST), KEYS)
    dies(monkeypatch, step, 1)
    with pytest.raises(Died):
        S.replace_load(spark, path, rows(spark, SECOND), KEYS)
    monkeypatch.undo()
    assert contents(spark, path) == (FIRST if step == "commit" else sorted(SECOND))
    S.replace_load(spark, path, rows(spark, SECOND), KEYS)
    assert contents(spark, path) == sorted(SECOND)
    T.staged_overwrite(spark, path, lambda df: df.filter("v > 5"))
    assert contents(spark, path) == [] and T.read_table(spark, path).columns[0] == "k"


def test_a_plain_folder_becomes_a_committed_table(spark, tmp_uri):
    path = f"{tmp_uri}/t"
    T.write_table(rows(spark, FIRST), path)
    T.staged_overwrite(spark, path, lambda df: df.filter("v = 1"))
    assert contents(spark, path) == FIRST and not [n for n in os.listdir(path) if n.endswith(".parquet")]
    T.write_table(rows(spark, FIRST).withColumn("month", month()), f"{path}2", partition_by=["month"])
    upsert(spark, f"{path}2", SECOND)
    assert contents(spark, f"{path}2") == AFTER


def test_input_rows_are_counted_once(spark, tmp_uri):
    df = rows(spark, FIRST)
    n = S.upsert_partitioned(spark, f"{tmp_uri}/t", df, KEYS, "month", month(), assume_unique=True)
    assert n == 3


def test_many_partitions_take_the_same_path(spark, tmp_uri):
    path = f"{tmp_uri}/t"
    many = spark.range(400).select(
        F.col("id").cast("string").alias("k"), F.date_add(F.lit("1990-01-15").cast("date"), (F.col("id") * 31).cast("int")).alias("report_date"),
        F.lit(1).alias("v"),
    )
    S.upsert_partitioned(spark, path, many, KEYS, "month", month())
    S.upsert_partitioned(spark, path, many.filter("k % 2 = 0").withColumn("v", F.lit(2)), KEYS, "month", month())
    got = T.read_table(spark, path).groupBy("v").count().collect()
    assert {(r.v, r["count"]) for r in got} == {(1, 200), (2, 200)}


# ----------------------------------------------------------------- streaming


def notice(number, firm, report, **more):
    base = {
        "recall_number": number, "recalling_firm": firm, "classification": "Class II", "status": "Terminated",
        "distribution_pattern": "Ohio", "reason_for_recall": "undeclared milk", "report_date": report, "state": "OH",
    }
    return base | more


def drop(spark, path, notices):
    from noticeflow.schemas import RECORD_FIELDS

    df = spark.createDataFrame([tuple(n.get(f) for f in RECORD_FIELDS) for n in notices], ", ".join(f"{f} string" for f in RECORD_FIELDS))
    write_bronze(df, path, {"source": "test"})


def records(spark, path):
    return explode_records(read_bronze_documents(spark, path))


def served(spark, path):
    return sorted((r.recall_number, r.recalling_firm_clean, r.repeated_company_count, r.risk_score)
                  for r in I.served_table(spark, path).collect())


@pytest.mark.parametrize("history", [False, True])
@pytest.mark.parametrize("step,nth", [("commit", 1), ("_clean", 1), ("remove_path", 1), ("remove_path", 2)])
def test_replayed_batch_gives_the_unbroken_table(spark, tmp_uri, monkeypatch, history, step, nth):
    first = [notice("R1", "Alpha", "20200110"), notice("R2", "Alpha", "20200111"), notice("R3", "Alpha", "20200301"), notice("R4", None, "20200401")]
    second = [notice("R1", "Beta", "20200520"), notice("R5", None, "20200521")]
    drop(spark, f"{tmp_uri}/d1", first)
    drop(spark, f"{tmp_uri}/d2", second)
    for name in ("whole", "broken"):
        I.merge_batch(spark, records(spark, f"{tmp_uri}/d1"), f"{tmp_uri}/{name}", history)
    I.merge_batch(spark, records(spark, f"{tmp_uri}/d2"), f"{tmp_uri}/whole", history)
    dies(monkeypatch, step, nth)
    with pytest.raises(Died):
        I.merge_batch(spark, records(spark, f"{tmp_uri}/d2"), f"{tmp_uri}/broken", history)
    monkeypatch.undo()
    I.merge_batch(spark, records(spark, f"{tmp_uri}/d2"), f"{tmp_uri}/broken", history)
    assert served(spark, f"{tmp_uri}/broken") == served(spark, f"{tmp_uri}/whole")
    if history:
        counts = {r[0]: r[2] for r in served(spark, f"{tmp_uri}/whole")}
        assert counts == {"R1": 0, "R2": 1, "R3": 1, "R4": 1, "R5": 1}


def test_a_row_without_firm_touches_only_its_own_month(spark, tmp_uri):
    path = f"{tmp_uri}/served"
    drop(spark, f"{tmp_uri}/d1", [notice(f"R{m}", None, f"2020{m:02d}10") for m in range(1, 7)])
    I.merge_batch(spark, records(spark, f"{tmp_uri}/d1"), path, history=True)
    before = set(T.current_commit(spark, path)["dirs"])
    drop(spark, f"{tmp_uri}/d2", [notice("R9", None, "20200315")])
    I.merge_batch(spark, records(spark, f"{tmp_uri}/d2"), path, history=True)
    after = set(T.current_commit(spark, path)["dirs"])
    assert {d.split("/")[-1] for d in before - after} == {"report_month=2020-03"} and len(after) == 6
    assert {r[2] for r in served(spark, path)} == {6}
    assert set(T.read_table(spark, path).columns) >= set(SILVER_COLUMNS)


def test_one_batch_equals_the_batch_run(spark, tmp_uri):
    from noticeflow.plans.stages import run_stages

    notices = [notice("R1", "Alpha", "20200110"), notice("R1", "Alpha", "20200210"), notice("R2", "Alpha", "20200111"),
               notice("", "Alpha", "20200111"), notice(None, "Beta", "20200111"), notice("R3", "Alpha", "20210111")]
    drop(spark, f"{tmp_uri}/d1", notices)
    window = ("2020-01-01", "2020-12-31")
    run_stages(spark, f"{tmp_uri}/d1", f"{tmp_uri}/run", *window, load=True, tables=["recalls"])
    I.incremental_refresh(spark, f"{tmp_uri}/d1", f"{tmp_uri}/served", f"{tmp_uri}/ckpt", report_start=window[0], report_end=window[1])
    columns = [c for c in I.served_table(spark, f"{tmp_uri}/served").columns]
    a = sorted(map(str, (tuple(r) for r in T.read_table(spark, f"{tmp_uri}/run/serving/recalls").select(*columns).collect())))
    b = sorted(map(str, (tuple(r) for r in I.served_table(spark, f"{tmp_uri}/served").collect())))
    assert a == b and len(a) == 3


def test_rolling_window():
    assert I.rolling_window(14, "2020-03-10") == ("2020-02-25", "2020-03-10") == I.rolling_window(14, "20200310")
    start, end = I.rolling_window()
    assert start < end
    with pytest.raises(ValueError):
        I.incremental_refresh(None, "", "", "", report_start="2020-01-01", lookback_days=3)


def test_only_rows_of_repeated_keys_are_aggregated(spark, tmp_uri):
    rows = spark.createDataFrame(
        [("a", "2020-01-01", 1), ("b", "2020-01-02", 2), ("b", "2020-02-02", 1), ("b", None, 9), ("Unknown", None, 3), ("Unknown", None, 4)],
        "k string, report_date string, n int",
    )
    spooled, _ = S.spool(rows)
    held = []
    got = S.latest_rows(spooled, ["k"], held)
    assert sorted(got.collect()) == sorted(S.dedupe_latest(rows, ["k"]).collect()) == [("Unknown", None, 4), ("a", "2020-01-01", 1), ("b", "2020-02-02", 1)]
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "LeftAnti" in plan and "LeftSemi" in plan and "partial_max" in plan
    for df in held:
        df.unpersist()


def _rows_of_repeated_keys(spark):
    """Keys of one, two and many rows, ties of the latest date, whole copies, no date at all."""
    n = F.col("id")
    rows = spark.range(6000).select(
        F.when(n % 11 == 0, F.lit("Unknown")).otherwise((n % 900).cast("string")).alias("k"),
        F.when(n % 5 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (n % 13).cast("int"))).alias("report_date"),
        (n % 7).cast("int").alias("n"), F.when(n % 3 == 0, F.lit("x")).alias("t"),
    )
    return rows.unionByName(rows.filter("n = 4")).unionByName(spark.range(300).select(
        F.concat(F.lit("once"), "id").alias("k"), F.lit(None).cast("date").alias("report_date"), F.lit(1).alias("n"), F.lit("y").alias("t")
    )).repartition(5)


def test_many_repeated_keys_shuffle_numbers_not_rows(spark, tmp_uri, monkeypatch):
    """Too many repeated keys for a broadcast: the same pick, and no row that is not
    tied with another is shuffled; the pick is there to be read again."""
    rows = _rows_of_repeated_keys(spark)
    want = sorted(map(str, S.dedupe_latest(rows, ["k"]).collect()))
    real = S.checked_broadcast
    spooled, path = S.spool(rows, numbered=True)
    aggregated = []
    pick = S.dedupe_latest
    monkeypatch.setattr(S, "dedupe_latest", lambda df, keys, *a: (aggregated.append(df.count()), pick(df, keys, *a))[1])
    monkeypatch.setattr(S, "checked_broadcast", lambda df, *a: real(df, *a) if a else df)
    held = []
    got = S.latest_rows(spooled, ["k"], held)
    assert got.columns == rows.columns
    assert sorted(map(str, got.collect())) == want
    assert len(aggregated) == 1 and aggregated[0] < rows.count() / 2
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "Exchange" not in plan and "Aggregate" not in plan
    for df in held:
        df.unpersist()
    T.remove_path(spark, path)


def joins(df):
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return "Join" in plan or "InMemoryTableScan" in plan


def test_gold_sums_are_added_from_written_rows(spark, tmp_uri, monkeypatch):
    """The joins behind the scores run once, not for each table of sums, and the old
    rows are not cached; nothing stays in scratch."""
    from noticeflow.session import ensure_checkpoint_dir

    scratch, seen = f"{ensure_checkpoint_dir(spark)}/noticeflow-scratch", []
    batches = lambda: {n for n in T._list(spark, scratch) if n.startswith("batch-")}
    before, real = batches(), I.G.summary_sums
    monkeypatch.setattr(I.G, "summary_sums", lambda signed: (seen.append(joins(signed)), real(signed))[1])
    drop(spark, f"{tmp_uri}/d1", [notice(f"R{m}", "Alpha" if m < 9 else None, f"2020{m:02d}10") for m in range(1, 13)])
    drop(spark, f"{tmp_uri}/d2", [notice("R2", "Beta", "20210315", status="Ongoing"), notice("R2", "Beta", "20210316"), notice("R20", None, "20210317")])
    for d in ("d1", "d2"):
        I.merge_batch(spark, records(spark, f"{tmp_uri}/{d}"), f"{tmp_uri}/served", history=True, gold=True)
    assert seen == [False, False] and batches() == before
    kept = I.maintained_gold(spark, f"{tmp_uri}/served")
    whole = I.G.gold_tables(I.served_table(spark, f"{tmp_uri}/served"))
    for name in ("company_risk", "geographic_recall_summary", "risk_tier_summary"):
        assert sorted(map(str, kept[name].collect())) == sorted(map(str, whole[name].select(*kept[name].columns).collect())), name


def test_scored_rows_are_written_once_for_the_upsert(spark, tmp_uri, monkeypatch):
    """The upsert reads its batch several times; the counts are not joined each time."""
    seen, real = [], I.upsert_partitioned
    monkeypatch.setattr(I, "upsert_partitioned", lambda s, path, updates, *a, **k: (seen.append(joins(updates)), real(s, path, updates, *a, **k))[1])
    drop(spark, f"{tmp_uri}/d1", [notice("R1", "Alpha", "20200110"), notice("R1", "Alpha", "20200111"), notice("R2", "Alpha", "20200301")])
    drop(spark, f"{tmp_uri}/d2", [notice("R2", None, "20200520"), notice("R5", None, "20200521")])
    for d in ("d1", "d2"):
        I.merge_batch(spark, records(spark, f"{tmp_uri}/{d}"), f"{tmp_uri}/served")
    assert seen == [False, False]
    # Scores count repeated records of their own batch.
    assert [(r[0], r[2]) for r in served(spark, f"{tmp_uri}/served")] == [("R1", 2), ("R2", 1), ("R5", 1)]


def test_shuffle_files_of_a_batch_go_with_their_statement(spark, tmp_uri, monkeypatch):
    """Only in the session of the batches; the caller's stays as it was."""
    seen, real, was = [], I.merge_batch, spark.conf.get(I.SHUFFLE_CLEANUP)
    monkeypatch.setattr(I, "merge_batch", lambda session, *args: (seen.append(session.conf.get(I.SHUFFLE_CLEANUP)), real(session, *args)))
    drop(spark, f"{tmp_uri}/d1", [notice(f"R{m % 9}", "Alpha" if m < 9 else None, f"2020{m:02d}10") for m in range(1, 13)])
    I.incremental_refresh(spark, f"{tmp_uri}/d1", f"{tmp_uri}/served", f"{tmp_uri}/ckpt", history=True, gold=True)
    assert seen == ["true"] and spark.conf.get(I.SHUFFLE_CLEANUP) == was
    assert I.served_table(spark, f"{tmp_uri}/served").count() == 9

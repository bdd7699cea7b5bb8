"""Snapshots of committed tables, runs that commit several tables at once,
hash buckets, and keys proven where rows are written."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from noticeflow.plans import stages
from noticeflow.schemas import SERVING_TABLES
from noticeflow.sources import serving as S
from noticeflow.sources import tables as T

from .test_commits import AFTER, FIRST, KEYS, SECOND, Died, contents, dies, rows, upsert


def folders(path):
    return {n for n in os.listdir(path) if n.startswith("__v=")}


# ----------------------------------------------------------------- snapshots


def test_a_reader_outlives_commits(spark, tmp_uri):
    path = f"{tmp_uri}/t"
    upsert(spark, path, FIRST)
    before = T.read_table(spark, path)
    upsert(spark, path, SECOND)
    S.replace_load(spark, path, rows(spark, SECOND), KEYS)
    assert before.count() == 3 and sorted(r.k for r in before.collect()) == ["a", "b", "c"]
    numbers = [v["number"] for v in T.table_versions(spark, path)]
    assert numbers == [1, 2, 3]
    old = [sorted((r.k, str(r.report_date), r.v) for r in T.read_table(spark, path, version=n).collect()) for n in numbers]
    assert old == [FIRST, AFTER, sorted(SECOND)]
    with pytest.raises(ValueError, match=r"no version 9: \[1, 2, 3\]"):
        T.read_table(spark, path, version=9)


def test_expiry_by_time(spark, tmp_uri):
    path = f"{tmp_uri}/t"
    for values in (FIRST, SECOND, FIRST):
        S.replace_load(spark, path, rows(spark, values), KEYS)
    T.expire_versions(spark, path, 3600)
    assert len(T.table_versions(spark, path)) == 3 and len(folders(path)) == 3
    # The second version was replaced just now, the first long ago.
    name = f"{path}/{T.COMMITS}/{2:012d}.json"
    state = json.load(open(name))
    os.remove(name)
    os.path.exists(f"{path}/{T.COMMITS}/.{2:012d}.json.crc") and os.remove(f"{path}/{T.COMMITS}/.{2:012d}.json.crc")
    with open(name, "w") as f:
        json.dump(state | {"at": time.time() - 7200}, f)
    os.mkdir(f"{path}/__v=orphan")
    T.expire_versions(spark, path, 3600)
    assert [v["number"] for v in T.table_versions(spark, path)] == [2, 3] and len(folders(path)) == 2
    T.expire_versions(spark, path, 0)
    assert [v["number"] for v in T.table_versions(spark, path)] == [3] and contents(spark, path) == FIRST


@pytest.mark.parametrize("nth", [1, 2, 3])
def test_a_died_expiry_leaves_readable_versions(spark, tmp_uri, monkeypatch, nth):
    path = f"{tmp_uri}/t"
    for values in (FIRST, SECOND, FIRST):
        S.replace_load(spark, path, rows(spark, values), KEYS)
    dies(monkeypatch, "remove_path", nth)
    with pytest.raises(Died):
        T.expire_versions(spark, path, 0)
    monkeypatch.undo()
    for v in T.table_versions(spark, path):
        assert T.read_table(spark, path, version=v["number"]).count() > 0
    T.expire_versions(spark, path, 0)
    assert len(folders(path)) == 1 and contents(spark, path) == FIRST


# ---------------------------------------------------------------------- runs


def test_tables_of_a_run_become_current_together(spark, tmp_uri):
    a, b = f"{tmp_uri}/store/a", f"{tmp_uri}/store/b"
    run = T.Run(spark, f"{tmp_uri}/store")
    S.upsert_table(spark, a, rows(spark, FIRST), KEYS, run=run)
    assert not T.table_exists(spark, a)
    with pytest.raises(ValueError, match="no committed version"):
        T.read_table(spark, a)
    S.replace_load(spark, b, rows(spark, SECOND), KEYS, run=run)
    run.commit()
    assert contents(spark, a) == FIRST and contents(spark, b) == sorted(SECOND)
    with pytest.raises(RuntimeError, match="committed already"):
        run.commit()
    os.rename(f"{tmp_uri}/store", f"{tmp_uri}/moved")
    assert contents(spark, f"{tmp_uri}/moved/a") == FIRST


def test_a_dead_run_is_never_seen_and_is_cleaned_up(spark, tmp_uri):
    a = f"{tmp_uri}/store/a"
    S.upsert_table(spark, a, rows(spark, FIRST), KEYS)
    dead = T.Run(spark, f"{tmp_uri}/store")
    S.upsert_table(spark, a, rows(spark, SECOND), KEYS, run=dead)
    assert contents(spark, a) == FIRST and [v["number"] for v in T.table_versions(spark, a)] == [1]
    S.upsert_table(spark, a, rows(spark, [("z", "2021-01-01", 5)]), KEYS)
    assert contents(spark, a) == sorted(FIRST + [("z", "2021-01-01", 5)])
    dead_marker = f"{tmp_uri}/store/{T.RUNS}"
    assert not os.path.exists(dead_marker) and len(os.listdir(f"{a}/{T.COMMITS}")) >= 2
    assert {v["number"] for v in T.table_versions(spark, a)} == {1, 3}


def land(path, *documents):
    os.makedirs(path)
    with open(f"{path}/d.json", "w", encoding="utf-8") as f:
        f.writelines(json.dumps(d) + "\n" for d in documents)
    return path


def notice(i, **more):
    return {"recall_number": f"R{i}", "status": "Ongoing", "classification": "Class II", "report_date": f"202001{i:02d}",
            "recalling_firm": f"Mill {i % 3}", "state": "OH", "recall_initiation_date": "20200101"} | more


def store_state(spark, base):
    tables = S.read_store(spark, f"{base}/serving")
    rows = {n: sorted(str(r) for r in df.drop("updated_at").collect()) for n, df in tables.items()}
    return rows | {"log": sorted((r.status, r.records_loaded) for r in T.read_table(spark, f"{base}/pipeline_runs").collect())}


@pytest.mark.parametrize("nth", [4, 9])
def test_a_run_killed_between_two_tables_leaves_the_old_set(spark, tmp_uri, monkeypatch, nth):
    """``commit`` is called once for each of the eight tables and for the log."""
    first = land(f"{tmp_uri}/d1", {"results": [notice(i) for i in range(1, 8)]})
    second = land(f"{tmp_uri}/d2", {"results": [notice(i, status="Terminated", state="TX") for i in range(5, 12)]})
    for base in ("whole", "broken"):
        stages.run_stages(spark, first, f"{tmp_uri}/{base}", load=True)
    old = store_state(spark, f"{tmp_uri}/broken")
    assert len(old) == 9 and len(old["recalls"]) == 7
    dies(monkeypatch, "commit", nth)
    with pytest.raises(Died):
        stages.run_stages(spark, second, f"{tmp_uri}/broken", load=True)
    monkeypatch.undo()
    after = store_state(spark, f"{tmp_uri}/broken")
    assert after.pop("log") == [("failed", 0), ("success", 7)] and old.pop("log") == [("success", 7)]
    assert after == old
    for base in ("whole", "broken"):
        stages.run_stages(spark, second, f"{tmp_uri}/{base}", load=True)
    a, b = store_state(spark, f"{tmp_uri}/whole"), store_state(spark, f"{tmp_uri}/broken")
    assert [x for x in b.pop("log") if x[0] == "success"] == a.pop("log") == [("success", 7), ("success", 7)]
    assert a == b and len(a["recalls"]) == 11


def test_a_failed_run_is_logged_with_its_error(spark, tmp_uri):
    bad = land(f"{tmp_uri}/d", {"results": "no list"})
    with pytest.raises(Exception, match="unreadable"):
        stages.run_stages(spark, bad, f"{tmp_uri}/out", load=True)
    row = T.read_table(spark, f"{tmp_uri}/out/pipeline_runs").first()
    assert row.status == "failed" and "unreadable" in row.error and row.records_loaded == 0
    assert S.read_store(spark, f"{tmp_uri}/out/serving") == {}


def test_the_log_stays_one_table_of_few_folders(spark, tmp_uri):
    log = f"{tmp_uri}/log"
    one = spark.createDataFrame([(1,)], "n int")
    one.write.parquet(log)  # a log of before commits
    for _ in range(4):
        T.committed_append(one, log, most_dirs=3)
    assert T.read_table(spark, log).count() == 5
    assert len(T.current_commit(spark, log)["dirs"]) <= 3


# ------------------------------------------------------------------- buckets


def many(spark, lo, hi, v):
    return spark.range(lo, hi).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("2020-01-01").cast("date").alias("report_date"),
                                      F.lit(v).alias("v"))


def test_an_upsert_rewrites_only_its_buckets(spark, tmp_uri):
    path = f"{tmp_uri}/t"
    assert S.upsert_table(spark, path, many(spark, 0, 5000, 1), KEYS, buckets=64) == 5000
    before = set(T.current_commit(spark, path)["dirs"])
    assert S.upsert_table(spark, path, many(spark, 4990, 5010, 2), KEYS) == 20
    after = set(T.current_commit(spark, path)["dirs"])
    batch = many(spark, 4990, 5010, 2).select(S.bucket_of(KEYS, 64).alias("b")).distinct().collect()
    assert {d.split("=")[-1] for d in before - after} == {str(r.b) for r in batch} and len(before & after) >= 64 - 20
    table = T.read_table(spark, path)
    assert set(table.columns) == {"k", "report_date", "v", "updated_at"}
    assert {(r.v, r["count"]) for r in table.groupBy("v").count().collect()} == {(1, 4990), (2, 20)}
    S.rebucket(spark, path, KEYS, 4)
    assert len(T.current_commit(spark, path)["dirs"]) == 4 and T.read_table(spark, path).count() == 5010
    assert S.upsert_table(spark, path, many(spark, 0, 0, 3), KEYS) == 0
    assert T.read_table(spark, path).count() == 5010


def test_buckets_follow_the_rows():
    assert [S._buckets_for(n) for n in (0, 1, 250_000, 250_001, 1_000_000, 10**12)] == [1, 1, 1, 2, 4, S.MOST_BUCKETS]


def test_a_plain_or_replaced_table_is_bucketed_once(spark, tmp_uri):
    plain, replaced = f"{tmp_uri}/p", f"{tmp_uri}/r"
    T.write_table(rows(spark, FIRST), plain)
    S.replace_load(spark, replaced, rows(spark, FIRST), KEYS)
    for path in (plain, replaced):
        S.upsert_table(spark, path, rows(spark, SECOND), KEYS)
        assert contents(spark, path) == AFTER and T.current_commit(spark, path)["buckets"] == 1


def test_additive_upsert(spark, tmp_uri):
    path = f"{tmp_uri}/n"
    frame = lambda values: spark.createDataFrame(values, "k string, n long, s double")
    S.add_to_table(spark, path, frame([("a", 2, 1.5), (None, 1, 1.0), ("b", 1, 2.0), ("b", 1, 2.0)]), ["k"], buckets=8)
    S.add_to_table(spark, path, frame([("a", -2, -1.5), (None, 3, 0.5), ("c", 0, 0.0)]), ["k"])
    assert sorted(map(tuple, T.read_table(spark, path).collect()), key=str) == [("b", 2, 4.0), (None, 4, 1.5)]


# ---------------------------------------------------------------------- keys


def test_a_planted_duplicate_is_found(spark, tmp_uri):
    """By another writer: its commit proves nothing, so all is checked."""
    for name, write in (("t", lambda p, df: S.upsert_table(spark, p, df, KEYS)), ("m", lambda p, df: upsert(spark, p, df))):
        path = f"{tmp_uri}/{name}"
        T.committed_write(rows(spark, FIRST + FIRST[:1]).withColumn("month", F.date_format("report_date", "yyyy-MM")), path, "month")
        with pytest.raises(S.BrokenKey, match="duplicate_keys': 1"):
            write(path, rows(spark, SECOND).withColumn("month", F.date_format("report_date", "yyyy-MM")) if name == "t" else SECOND)
        assert len(contents(spark, path)) == 4  # nothing was committed


def test_a_duplicate_in_touched_rows_is_found(spark, tmp_uri):
    """Planted into a month that the batch rewrites, behind the commit's back."""
    path = f"{tmp_uri}/t"
    upsert(spark, path, FIRST)
    folder = next(d for d in T.current_commit(spark, path)["dirs"] if d.endswith("month=2020-02"))
    spark.read.parquet(f"{path}/{folder}").filter("k = 'b'").write.mode("append").parquet(f"{path}/{folder}")
    with pytest.raises(S.BrokenKey):
        upsert(spark, path, SECOND)


def test_a_daily_load_reads_no_untouched_rows_for_its_keys(spark, tmp_uri, monkeypatch):
    path = f"{tmp_uri}/t"
    S.upsert_table(spark, path, many(spark, 0, 2000, 1), KEYS, buckets=32)
    seen = []
    real = S.prove_keys
    monkeypatch.setattr(S, "prove_keys", lambda df, keys, name: (seen.append(df.count()), real(df, keys, name)))
    S.upsert_table(spark, path, many(spark, 0, 1, 2), KEYS)
    assert len(seen) == 1 and 0 < seen[0] < 200  # one bucket of 32


def test_every_serving_table_is_loaded_twice_the_same(spark, tmp_uri):
    d = land(f"{tmp_uri}/d", {"results": [notice(i) for i in range(1, 9)]})
    stages.run_stages(spark, d, f"{tmp_uri}/o", load=True)
    once = store_state(spark, f"{tmp_uri}/o")
    stages.run_stages(spark, d, f"{tmp_uri}/o", load=True)
    twice = store_state(spark, f"{tmp_uri}/o")
    assert once.pop("log") + [("success", 8)] == twice.pop("log") and once == twice and set(once) == set(SERVING_TABLES)

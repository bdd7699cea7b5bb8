"""Parquet tables: scan, overwrite sink, fallback choice, atomic commits,
snapshots and run commits.

A *committed* table keeps its data in version folders and numbered commit
files, each of which names the folders making up the table's contents::

    <path>/_commits/000000000007.json     {"schema": ..., "dirs": [...], "at": ...}
    <path>/__v=<id>/...                   data of one write

New files land first, then one commit file appears by a rename. A reader or a
replayed job therefore sees the table before or after a write, never in
between, whatever step a lost driver stopped at.

*Snapshots.* A replaced version stays readable for ``RETAIN_SECONDS`` after
it was replaced: a DataFrame planned before a commit still reads its own files
after it, and :func:`read_table` takes the number of any version that is
left (:func:`table_versions`). :func:`expire_versions` deletes what is older, and
folders that no commit names; each commit ends with it.

*Runs.* Commits made for a :class:`Run` name its marker file and count only
once that file exists. So any number of tables, prepared one after the other,
become current together by one rename. A run that dies leaves the old tables;
its commits are never seen and the next commit deletes them.

One writer per table is assumed. A path without commits is a plain Parquet
folder.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_LOG = logging.getLogger(__name__)

VERSION_COL = "__v"
COMMITS = "_commits"
RUNS = "_runs"
#: Seconds for which a replaced version stays readable; the session setting
#: RETAIN_CONF overrides it.
RETAIN_SECONDS = 24 * 3600
RETAIN_CONF = "spark.noticeflow.retainSeconds"


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority Spark resolves it to, so that
    tasks using another file-system client open the same place."""
    fs, p = _hadoop_fs(spark, path)
    return fs.makeQualified(p).toUri().toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _list(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


# ------------------------------------------------------------------ commits


def _commit_numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _list(spark, f"{path.rstrip('/')}/{COMMITS}") if n[:-5].isdigit() and n.endswith(".json")]


def _read_json(spark: SparkSession, name: str) -> dict:
    fs, p = _hadoop_fs(spark, name)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_json(spark: SparkSession, name: str, value: dict) -> bool:
    """Create the file whole, by a rename; False if it exists."""
    folder, leaf = name.rsplit("/", 1)
    fs, parent = _hadoop_fs(spark, folder)
    fs.mkdirs(parent)
    _, draft = _hadoop_fs(spark, f"{folder}/.draft-{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    _, final = _hadoop_fs(spark, f"{folder}/{leaf}")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        return False
    return True


def _commit_name(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{COMMITS}/{number:012d}.json"


class Run:
    """Writes to several tables of a store that become current together,
    when :meth:`commit` puts the marker file in place."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.id = spark, uuid.uuid4().hex
        self.marker = f"{store.rstrip('/')}/{RUNS}/{self.id}.json"

    def name_from(self, path: str) -> str:
        """The marker relative to a table, so that a store may be moved."""
        here, there = path.rstrip("/").split("/"), self.marker.split("/")
        same = next((i for i, (a, b) in enumerate(zip(here, there)) if a != b), len(here))
        return "/".join([".."] * (len(here) - same) + there[same:])

    def commit(self) -> None:
        if not _write_json(self.spark, self.marker, {"run": self.id, "at": time.time()}):
            raise RuntimeError(f"run {self.id} is committed already")


def _marker_of(path: str, name: str) -> str:
    base = path.rstrip("/")
    while name.startswith("../"):
        base, name = base.rsplit("/", 1)[0], name[3:]
    return f"{base}/{name}"


def _visible(spark: SparkSession, path: str, state: dict) -> bool:
    return not state.get("run") or path_exists(spark, _marker_of(path, state["run"]))


def _commits(spark: SparkSession, path: str):
    """The visible commits of a table, newest first."""
    for number in sorted(_commit_numbers(spark, path), reverse=True):
        state = _read_json(spark, _commit_name(path, number)) | {"number": number}
        if _visible(spark, path, state):
            yield state


def current_commit(spark: SparkSession, path: str) -> dict | None:
    """The newest commit of a table that counts: its schema and data folders;
    None for a plain folder."""
    return next(_commits(spark, path), None)


def table_versions(spark: SparkSession, path: str) -> list[dict]:
    """(number, at, run) of the versions that can be read, oldest first."""
    return [{k: c.get(k) for k in ("number", "at", "run")} for c in _commits(spark, path)][::-1]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a plain folder with data and for a table with a commit that
    counts; what only a write under way (or dead) has left is no table yet."""
    names = _list(spark, path)
    if COMMITS in names:
        return current_commit(spark, path) is not None
    return any(n.endswith(".parquet") or ("=" in n and not n.startswith(f"{VERSION_COL}=")) for n in names)


def new_version() -> str:
    """Folder name of a new write (relative to the table)."""
    return f"{VERSION_COL}={uuid.uuid4().hex[:12]}"


def commit(
    spark: SparkSession, path: str, schema: StructType, dirs: list[str], run: Run | None = None, facts: dict | None = None
) -> None:
    """Make ``dirs`` (relative to the table) its contents - at once, or with
    the other tables of ``run`` -, then delete what is out of date. ``facts``
    are kept with the commit: ``hidden`` columns that readers do not get,
    and what the writer knows of the rows."""
    base = path.rstrip("/")
    number = max(_commit_numbers(spark, path), default=0) + 1
    state = {"schema": schema.jsonValue(), "dirs": dirs, "at": time.time()} | (facts or {})
    if run is not None:
        state["run"] = run.name_from(base)
    if not _write_json(spark, _commit_name(base, number), state):
        raise RuntimeError(f"another writer committed {base} meanwhile")
    _clean(spark, base, number)


def expire_versions(spark: SparkSession, path: str, retain_seconds: float | None = None) -> None:
    """Delete the versions that were replaced more than ``retain_seconds``
    ago (default: RETAIN_SECONDS), commits of runs that never came about, and all
    files that no commit names. Not while a run that writes the table is under way."""
    state = current_commit(spark, path)
    if state is not None:
        _clean(spark, path.rstrip("/"), state["number"], retain_seconds)


def _retained(spark: SparkSession, base: str, number: int, retain: float) -> dict[int, dict]:
    """Commits to keep: ``number`` (whose run may be under way), the newest
    that counts, and those replaced less than ``retain`` seconds ago."""
    kept, replaced = {number: _read_json(spark, _commit_name(base, number))}, None
    for state in _commits(spark, base):
        if replaced is None or (retain > 0 and replaced > time.time() - retain):
            kept[state["number"]] = state
        replaced = state.get("at", 0)
    return kept


def _clean(spark: SparkSession, base: str, number: int, retain: float | None = None) -> None:
    """Delete everything under the table that no retained commit names; the
    commits go first, so that no version is listed without its files."""
    if retain is None:
        retain = float(spark.conf.get(RETAIN_CONF, str(RETAIN_SECONDS)))
    kept = _retained(spark, base, number, retain)
    for name in _list(spark, f"{base}/{COMMITS}"):
        if name not in {f"{n:012d}.json" for n in kept}:
            remove_path(spark, f"{base}/{COMMITS}/{name}")
    dirs = {d for state in kept.values() for d in state["dirs"]}
    tops = {d.split("/")[0] for d in dirs}
    for name in _list(spark, base):
        if name in (COMMITS, RUNS):
            continue
        if name not in tops:
            remove_path(spark, f"{base}/{name}")
        elif name not in dirs:  # some partitions of this version are retained
            for part in _list(spark, f"{base}/{name}"):
                if f"{name}/{part}" not in dirs:
                    remove_path(spark, f"{base}/{name}/{part}")


def partition_dirs(spark: SparkSession, path: str, version: str) -> list[str]:
    """Partition folders of one version, relative to the table."""
    return [f"{version}/{n}" for n in _list(spark, f"{path.rstrip('/')}/{version}") if "=" in n]


# ---------------------------------------------------------------- scan, sink


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Scan of a table: the folders of its newest commit - or of the retained
    ``version`` -, or all part files of a plain Parquet folder. The result
    keeps reading this version when later commits replace it."""
    if version is None:
        state = current_commit(spark, path)
    else:
        state = next((c for c in _commits(spark, path) if c["number"] == version), None)
        if state is None:
            raise ValueError(f"{path} has no version {version}: {[v['number'] for v in table_versions(spark, path)]}")
    return _scan(spark, path, state)


def _scan(spark: SparkSession, path: str, state: dict | None, hidden: bool = False) -> DataFrame:
    """The rows of a commit; ``hidden`` shows its hidden columns as well."""
    if state is None:
        if not table_exists(spark, path) and path_exists(spark, path):
            raise ValueError(f"{path} has no committed version")
        return spark.read.parquet(path)
    schema = StructType.fromJson(state["schema"])
    names = [n for n in schema.fieldNames() if hidden or n not in state.get("hidden", [])]
    if not state["dirs"]:
        return spark.createDataFrame([], schema).select(*names)
    base = path.rstrip("/")
    with_version = StructType(schema.fields).add(VERSION_COL, StringType())
    scan = spark.read.schema(with_version).option("basePath", base).parquet(*[f"{base}/{d}" for d in state["dirs"]])
    return scan.select(*names)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_clustered(df: DataFrame, path: str, partition_col: str, mode: str = "errorifexists") -> None:
    """Partitioned write with each partition's rows brought together first.
    The rebalance step sizes its tasks at run time: a partition that holds a
    third of the rows is split over many tasks, small ones share a task, and
    (unlike range partitioning) nothing is sampled, so the input runs once."""
    clustered = df.hint("rebalance", F.col(partition_col))
    # Static semantics whatever the session default: an overwrite replaces
    # the whole table, not only the partitions present in ``df``.
    clustered.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path)


def committed_write(
    df: DataFrame, path: str, partition_col: str | None = None, run: Run | None = None, facts: dict | None = None
) -> None:
    """Make the table exactly ``df`` in one atomic step (that of ``run``). ``df`` may read the
    table itself; until the commit the old contents stay readable."""
    spark = df.sparkSession
    version = new_version()
    target = f"{path.rstrip('/')}/{version}"
    if partition_col:
        write_clustered(df, target, partition_col)
        dirs = partition_dirs(spark, path, version)
    else:
        df.write.parquet(target)
        dirs = [version]
    commit(spark, path, df.schema, dirs, run, facts)


def committed_append(df: DataFrame, path: str, run: Run | None = None, most_dirs: int = 100) -> None:
    """Add rows to a table in one atomic step. Small appends gather: beyond
    ``most_dirs`` of them the table is written anew."""
    spark = df.sparkSession
    state = current_commit(spark, path)
    if state is None and table_exists(spark, path):
        return committed_write(spark.read.parquet(path).unionByName(df, allowMissingColumns=True), path, run=run)
    if state is not None and len(state["dirs"]) >= most_dirs:
        return committed_write(_scan(spark, path, state).unionByName(df, allowMissingColumns=True), path, run=run)
    version = new_version()
    df.write.parquet(f"{path.rstrip('/')}/{version}")
    commit(spark, path, df.schema, (state["dirs"] if state else []) + [version], run)


def staged_write(df: DataFrame, target: str) -> None:
    """Replace a table that ``df`` itself may read."""
    committed_write(df, target)


def staged_overwrite(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Rewrite a table in place: read, transform (e.g. a date filter), commit."""
    staged_write(transform(read_table(spark, path)), path)


def first_non_empty(primary: Callable[[], DataFrame] | DataFrame, fallback: Callable[[], DataFrame] | DataFrame) -> DataFrame:
    """The primary source unless it fails or has no rows, else the fallback.
    The emptiness probe is ``isEmpty`` (a LIMIT 1 job), not a count."""
    try:
        df = primary() if callable(primary) else primary
        if not df.isEmpty():
            return df
    except Exception as e:  # a failed read counts as empty
        _LOG.warning("primary source failed, taking the fallback: %s", e)
    return fallback() if callable(fallback) else fallback

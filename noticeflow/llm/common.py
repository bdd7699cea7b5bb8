"""Small helpers shared by the operators: scratch tables, checked joins,
identifier handling."""

from __future__ import annotations

import gc
import math
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from ..sources.tables import remove_path

#: Words: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """All words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


class Scratch:
    """The scratch tables written while it is entered (by this thread). Its
    owner frees them once what was built on them is written; tables of others
    are never touched. Scopes nest: a table belongs to the innermost one, and
    to nobody outside of any - those stay as long as their lazy results may be read."""

    _open: ContextVar[Scratch | None] = ContextVar("scratch", default=None)

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self._token = self._open.set(self)
        return self

    def __exit__(self, *error) -> None:
        self._open.reset(self._token)

    def free(self) -> None:
        paths, self.paths = self.paths, []
        for path in paths:
            remove_path(self.spark, path)
        release(self.spark)


def new_scratch(spark: SparkSession, name: str) -> str:
    """The path of a new scratch table, owned by the scope that is entered."""
    path = scratch_path(spark, name)
    owner = Scratch._open.get()
    if owner is not None:
        owner.paths.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, survives lost executors, and lets several consumers share it."""
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases now
    rather than at the driver's next garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ready(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    ship_package(spark)


def finite_vectors(vectors: DataFrame, column: str = "embedding") -> Column:
    """True for vectors without null, NaN or infinite components (not for a
    null vector). Built-ins that compile: ``array_contains`` is null, not
    false, if the value is missing beside a null."""
    x, inf = F.col(column), F.lit(float("inf"))
    element = vectors.schema[column].dataType.elementType
    clean = ~F.array_contains(x, F.lit(float("nan")).cast(element))
    return x.isNotNull() & (
        (F.size(x) == 0) | F.coalesce(clean & (F.array_max(x) < inf) & (F.array_min(x) > -inf), F.lit(False))
    )


def join_small(big: DataFrame, small: DataFrame, key: str, how: str = "left", spread: str = "doc_id",
               max_rows: int = 100_000, salts: int = 32) -> DataFrame:
    """Join a table with one row per ``key`` value to a large one whose keys
    may be hot. Up to ``max_rows`` (counted) rows are broadcast; beyond that
    the small side is copied ``salts`` times and hot keys spread over them."""
    renamed = small.withColumnRenamed(key, "_small_key")
    n = renamed.limit(max_rows + 1).count()
    if n <= max_rows:
        return big.join(F.broadcast(renamed), big[key].eqNullSafe(renamed["_small_key"]), how).drop("_small_key")
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = renamed.withColumn("_small_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = salted[key].eqNullSafe(copies["_small_key"]) & (salted["_salt"] == copies["_small_salt"])
    return salted.join(copies, on, how).drop("_salt", "_small_key", "_small_salt")


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """A partition count that grows with the data."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_each))

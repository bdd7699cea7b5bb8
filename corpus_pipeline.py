"""The corpus pipeline: documents through five training-data operators.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next stage's ``docs``. All stages but the last return the
columns of ``docs``. A stage owns the scratch tables it writes; as its result is
written before the next stage is called, that call frees them. Tables of
anything else in the session are not touched.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import decontaminate, minmax_dedup, quality_rules, substring_dedup, viterbi
from noticeflow.llm.common import Scratch, new_scratch, read_table
from noticeflow.sources.tables import remove_path

#: The scratch of this thread's stage before.
_BEFORE = threading.local()


def _stage(f):
    @functools.wraps(f)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = getattr(_BEFORE, "scratch", None)
        if before is not None:
            before.free()
        with Scratch(spark) as scratch:
            out = f(spark, docs, sf_dir)
        _BEFORE.scratch = scratch
        return out

    return call


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_quality(docs, read_table(spark, sf_dir, "labels"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles,
    similarity 0.8 or more)."""
    return minmax_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


@_stage
def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that occur earlier are cut from the texts;
    documents stay, n_chars follows the text."""
    cut = substring_dedup.cut_repeats(docs, window=20)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@_stage
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text: doc_id, n_tokens, ids_crc32, exact, ids."""
    return viterbi.encode_pieces(docs)


STAGES = [
    ("quality_rules", quality),
    ("minmax_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("latent_decontamination", decontamination),
    ("streaming_viterbi", sentencepiece),
]

#: The later stages have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. The table between two stages goes
    once the next one is written; the last stage's input stays, as its result is lazy."""
    docs, path = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out, before, path = stage(spark, docs, sf_dir), path, new_scratch(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove_path(spark, before)
    out = STAGES[-1][1](spark, docs, sf_dir)
    _BEFORE.scratch = None  # what the lazy result reads is nobody's to free
    return out

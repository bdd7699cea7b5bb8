"""Bronze records -> silver: one projection, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions import rules
from ..schemas import SILVER_COLUMNS


def silver_projection(records: DataFrame) -> DataFrame:
    """24 projected/standardised columns plus ``is_open`` and duration.

    Narrow only (no shuffle): it runs inside the scan's codegen stage.
    """
    c = F.col
    projected = records.select(
        c("recall_number"),
        c("event_id"),
        text.standard_status("status").alias("status"),
        text.standard_classification("classification").alias("classification"),
        c("product_type"),
        c("recalling_firm"),
        text.clean_firm("recalling_firm").alias("recalling_firm_clean"),
        c("product_description"),
        c("reason_for_recall"),
        text.reason_category("reason_for_recall").alias("recall_reason_category"),
        text.product_category("product_description").alias("product_category"),
        c("distribution_pattern"),
        text.distribution_scope("distribution_pattern").alias("distribution_scope"),
        c("state"),
        text.region("state").alias("region"),
        c("country"),
        c("city"),
        c("postal_code"),
        c("product_quantity"),
        c("voluntary_mandated"),
        c("initial_firm_notification"),
        dates.parse_compact_date("recall_initiation_date").alias("recall_initiation_date"),
        dates.parse_compact_date("report_date").alias("report_date"),
        dates.parse_compact_date("termination_date").alias("termination_date"),
    )
    return projected.select(
        *[c(x) for x in SILVER_COLUMNS[:-2]],
        text.is_open("status").alias("is_open"),
        dates.recall_duration_days("recall_initiation_date", "termination_date", "report_date").alias(
            "recall_duration_days"
        ),
    )


def region_map(spark: SparkSession) -> DataFrame:
    """The fixed 51-row (state, region) lookup table."""
    return spark.createDataFrame(text.region_map_rows(), "state_code string, region string")


def region_join(df: DataFrame, state_col: str = "state", out: str = "region") -> DataFrame:
    """Region through a lookup join. The map is a fixed 51 rows, so the
    broadcast is bounded regardless of data size; same answer as
    :func:`noticeflow.functions.region`."""
    spark = df.sparkSession
    m = region_map(spark)
    keyed = df.withColumn("_state_code", F.lower(F.trim(F.col(state_col))))
    joined = keyed.join(F.broadcast(m), keyed["_state_code"] == m["state_code"], "left")
    return joined.select(
        *[keyed[x] for x in df.columns if x != out],
        F.coalesce(m["region"], F.lit(rules.REGION_DEFAULT)).alias(out),
    )

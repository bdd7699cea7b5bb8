"""Recall-shaped records derived from the driver's TPC-H-like tables.

One record per order (``orders JOIN customer``), carrying the 19 flat
bronze fields as text, with deliberate NULLs, blanks, padded codes,
mixed-case classes and unparseable dates. The join is left to Catalyst
and AQE: ``customer`` grows with the data, so it is not force-broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioning import spread_scan
from ..schemas import RECORD_FIELDS


def read_driver_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_scan(df) if spread else df


def _case(key, mapping: dict[int, str]):
    expr = None
    for k, v in mapping.items():
        cond = key == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr  # no otherwise: unmatched keys give NULL


def _compact(d):
    return F.date_format(d, "yyyyMMdd")


def recall_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat bronze records (19 string fields) derived from orders x customer."""
    orders = read_driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    # Text rules downstream are CPU-bound: spread a few-split input if asked to.
    orders = spread_scan(orders)
    customer = read_driver_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    ok = F.col("o_orderkey")
    ck = F.col("c_custkey")
    day = F.to_date(F.col("o_orderdate"))

    recall_number = F.when(ok % 97 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("F-"), F.lpad(ok.cast("string"), 7, "0"))
    )
    status = (
        F.when(ok % 89 == 0, F.lit(None))
        .when(ok % 53 == 0, F.lit("Pending"))
        .when(F.col("o_orderstatus") == "F", F.lit("Terminated"))
        .when(F.col("o_orderstatus") == "O", F.lit("ONGOING"))
        .otherwise(F.lit("Completed"))
    )
    prio = F.col("o_orderpriority")
    classification = (
        F.when(ok % 83 == 0, F.lit(None))
        .when(prio == "1-URGENT", F.lit("Class I"))
        .when(prio == "2-HIGH", F.lit("class ii"))
        .when(prio == "3-MEDIUM", F.lit("CLASS  III"))
        .when(prio == "4-NOT SPECIFIED", F.lit("Class II"))
        .otherwise(F.lit("Not Yet Classified"))
    )
    firm = F.when(ok % 101 == 0, F.lit(None)).otherwise(
        F.concat(F.col("c_name"), F.when(ck % 2 == 0, F.lit(", Inc.")).otherwise(F.lit(" & Co")))
    )
    product = _case(ok % 12, {
        0: "Cheddar Cheese block", 1: "Ground BEEF patties", 2: "Smoked salmon", 3: "Spinach salad",
        4: "Infant cereal", 5: "Vitamin C 500", 6: "Oat cookie pack", 7: "Sparkling water",
        8: "Frozen pizza", 9: "Ice Cream bar", 10: "Rice crackers",
    })
    reason = _case(ok % 7, {
        0: "Potential Listeria monocytogenes", 1: "Undeclared allergen: milk", 2: "Mislabeled package",
        3: "Foreign material: metal fragments", 4: "E. coli O157:H7", 5: "Quality complaint",
    })
    distribution = _case((ok + ck) % 6, {
        0: "NATIONWIDE", 1: "Sold nationally, incl. Canada", 2: "AZ, CA, NV",
        3: "Exported to Mexico", 4: "Local stores",
    })
    state = _case(F.col("c_nationkey") % 9, {
        0: "AZ", 1: " ny ", 2: "TX", 3: "oh", 4: "PR", 5: "", 6: "CA", 7: "DC",
    })
    country = F.when(F.col("c_nationkey") == 24, F.lit("Canada")).otherwise(F.lit("United States"))
    initiation = F.when(ok % 71 == 0, F.lit(None)).otherwise(_compact(day))
    report = _compact(F.date_add(day, (ok % 30).cast("int")))
    termination = (
        F.when(F.col("o_orderstatus") != "F", F.lit(""))
        .when(ok % 61 == 0, F.lit("N/A"))
        .otherwise(_compact(F.date_add(day, (ok % 365).cast("int"))))
    )
    cols = {
        "recall_number": recall_number,
        "event_id": (ok % 500).cast("string"),
        "status": status,
        "classification": classification,
        "product_type": F.lit("Food"),
        "recalling_firm": firm,
        "product_description": product,
        "reason_for_recall": reason,
        "distribution_pattern": distribution,
        "state": state,
        "country": country,
        "city": F.col("c_mktsegment"),
        "postal_code": F.lpad(ck.cast("string"), 5, "0"),
        "product_quantity": F.concat((ok % 400).cast("string"), F.lit(" cases")),
        "voluntary_mandated": F.lit("Voluntary: Firm initiated"),
        "initial_firm_notification": F.lit("Letter"),
        "recall_initiation_date": initiation,
        "report_date": report,
        "termination_date": termination,
    }
    return j.select(*[cols[f].cast("string").alias(f) for f in RECORD_FIELDS])

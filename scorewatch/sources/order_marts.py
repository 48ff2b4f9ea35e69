"""Score and performance marts derived from order, customer and line item tables.

One scored account per order: the order's price stands for the score, its month
for the score month, its status for the channel. Line items give the features
and, through returned lines, the outcomes.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.functions.columns import indicator, shift_month_col
from scorewatch.plans.ranking import equal_bins, ntile_ranks
from scorewatch.plans.staging import staged
from scorewatch.spec import MATURITIES

# Outcomes are known up to this month; later months of the mart are not mature.
OBSERVED_UNTIL = "2001-05"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _order_month() -> F.Column:
    return F.date_format("o_orderdate", "yyyy-MM").alias("score_month")


def score_mart(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders")
    customers = _table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    lines = (_table(spark, folder, "lineitem").groupBy("l_orderkey")
             .agg(F.sum("l_quantity").alias("quantity"),
                  F.round(F.avg("l_discount"), 6).alias("discount"),
                  F.round(F.avg("l_tax"), 6).alias("tax"),
                  F.count(F.lit(1)).alias("lines"),
                  F.max("l_linenumber").alias("last_line")))
    price = F.col("o_totalprice")
    orders = orders.withColumn("risk_score", F.when(price >= 6000, price / 479909))
    # Binned before the joins: deciles depend on the orders alone.
    orders = equal_bins(orders, ["o_orderstatus"], "risk_score", "o_orderkey", "score_decile_static",
                        ntile_ranks(10), 10)
    return (orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_orderkey").alias("creditaccountid"),
                F.col("o_custkey").alias("customerid"),
                F.col("o_orderstatus").alias("channel"),
                F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
                       F.col("o_orderpriority")).alias("source"),
                F.col("c_mktsegment").alias("line"),
                "risk_score", "score_decile_static",
                F.when(F.col("c_nationkey") < 12, "SC001").otherwise("SC002").alias("scorecard_id"),
                indicator(F.col("c_acctbal") < -900).alias("is_excluded_from_monitoring"),
                price.alias("saleamount"),
                F.col("lines").cast("int").alias("salecount"),
                F.col("last_line").cast("int").alias("mob_pti"),
                F.col("c_acctbal").alias("endingreceivable"),
                "quantity", "discount", "tax", "lines",
                F.col("c_acctbal").alias("balance"),
                _order_month()))


def performance_mart(spark: SparkSession, folder: str) -> DataFrame:
    returned = (_table(spark, folder, "lineitem").groupBy("l_orderkey")
                .agg(F.avg(indicator(F.col("l_returnflag") == "R")).alias("r")))
    reached = {"edr30_m3": 0.5, "edr60_m6": 0.6, "edr90_m9": 0.75, "co_m12": 1.0,
               "bad30_m3": 0.4, "bad60_m6": 0.5, "bad90_m9": 0.6, "badco_m12": 0.75}
    flags = [indicator(F.col("score_month") <= shift_month_col(F.lit(OBSERVED_UNTIL), -m.months_back))
             .alias(m.flag) for m in MATURITIES]
    return (_table(spark, folder, "orders").select("o_orderkey", _order_month())
            .join(returned, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.col("o_orderkey").alias("creditaccountid"),
                    *[indicator(F.col("r") >= share).alias(name) for name, share in reached.items()],
                    *flags, "score_month"))


_BUILDERS = {"score_mart": score_mart, "performance_mart": performance_mart}


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The mart as a table partitioned by month, written once per application."""
    return staged(spark, f"{os.path.abspath(folder)}:{name}",
                  lambda: _BUILDERS[name](spark, folder), ["score_month"])

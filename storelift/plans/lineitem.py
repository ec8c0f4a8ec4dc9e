"""The attribution operators applied to the TPC-H order tables: the same
range join and net-amount roll-up, on the largest given tables, as scale
checks of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import money, positive_amount, returned_amount
from ..operators.attribution import window_join
from ..params import Params

RETURN_FLAG = "R"


def ship_windows(orders: DataFrame, lineitem: DataFrame, params: Params = Params()) -> DataFrame:
    """Per order day: line items shipped 0, 7 and 30 days after the order
    day (count, quantity, extended price), from a bucketed range join on the
    order key."""
    o = orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    li = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.to_date("l_shipdate").alias("ship_day"),
        "l_quantity",
        money("l_extendedprice").alias("price"),
    )
    pairs = window_join(o, li, ["o_orderkey"], "order_day", "ship_day", params.max_window, params.bucket_days)
    aggs = []
    for w in params.windows:
        inw = F.col("dd") <= w
        aggs += [
            F.count(F.when(inw, F.lit(1))).alias(f"lines_{w}d"),
            F.sum(F.when(inw, F.col("l_quantity"))).alias(f"qty_{w}d"),
            F.sum(F.when(inw, F.col("price"))).cast("decimal(18,2)").alias(f"price_{w}d"),
        ]
    return pairs.groupBy("order_day").agg(*aggs)


def net_sales(df: DataFrame, keys: list[str], qty: str, amt: str) -> DataFrame:
    """Positive-quantity amounts minus the absolute amounts of negative
    quantities, per key (NULL amounts are skipped by the sums)."""
    return df.groupBy(*keys).agg(
        (F.sum(positive_amount(qty, amt)) - F.sum(returned_amount(qty, amt))).cast("decimal(18,2)").alias("net_amt"),
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col(qty) < 0, F.lit(1))).alias("returned_lines"),
    )


def supplier_daily_net_sales(lineitem: DataFrame) -> DataFrame:
    """Net extended price per supplier and ship day, returned lines
    (return flag R) counting negative."""
    li = lineitem.select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("ship_day"),
        F.when(F.col("l_returnflag") == RETURN_FLAG, F.lit(-1)).otherwise(F.lit(1)).alias("qty"),
        money("l_extendedprice").alias("amt"),
    )
    return net_sales(li, ["l_suppkey", "ship_day"], "qty", "amt")

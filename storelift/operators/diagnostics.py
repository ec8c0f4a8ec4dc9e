"""Key checks of the dimension inputs.

The source never declares its dimension keys, and the reports deliberately
keep the row repetitions that non-unique keys cause (the joins fan out).
Rather than de-duplicating, this reports where a key repeats, so the owner
of the data can see which output rows are multiplied.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import member_key
from ..params import Params
from ..sources.tables import Sources


def dimension_key_report(src: Sources, params: Params = Params()) -> DataFrame:
    """One row per dimension: rows, distinct keys, keys with more than one
    row, and the rows beyond the first per key (the extra join matches)."""
    checks = [
        ("phy_store", src.phy_store.select(F.col("lego_store_code").alias("key"))),
        ("app_store", src.app_store.select(F.col("store_id").cast("string").alias("key"))),
        ("member_detail", src.member_detail.select("member_detail_id", "join_time", "eff_reg_store").distinct()
         .select(member_key("member_detail_id", params).cast("string").alias("key"))),
        ("campaign_code", src.campaign_code.select(F.col("campaign_code").alias("key"))),
    ]
    per_key = [df.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("dimension", F.lit(name))
               for name, df in checks]
    return reduce(DataFrame.unionByName, per_key).groupBy("dimension").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("n") > 1, F.lit(1))).alias("repeated_keys"),
        F.sum(F.col("n") - 1).alias("extra_rows"),
    )

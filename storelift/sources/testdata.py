"""Role mapping of the generated test tables onto the seven inputs.

The test folders hold TPC-H-like tables plus an ``events`` stream.  The
mapping below (documented in FIXTURES.md section 2) derives every input from
them with built-in expressions, so the work of every registered query grows
with the tables.  ``oracle_sql.py`` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .tables import Sources

# Fixed values of the mapping (FIXTURES.md section 2).
STATUS_RESERVED = "已预约"
LIFECYCLE_REPEAT = "repurchase"
OTHER_COUPON_CODE = "Q0"
COUPON_ISSUED = "issued"


# Column types of the generated test tables that the queries read (as stored
# in their parquet files; timestamps carry no time zone).  Declaring them
# skips schema inference from the file footers on every query.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _home(extra: str = "k % 3") -> str:
    """Store number of an event: near the user's home store, so that a user's
    visits and purchases meet; it grows with the users as the suppliers do."""
    return f"((user_id * 2) div 3 + {extra})"


def _padded(text: str, width: int) -> str:
    return f"lpad(CAST({text} AS STRING), {width}, '0')"


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The seven inputs.  Every row of the tables takes part.  Store, campaign,
    agent and event codes come from ranges that grow with the tables; some codes
    are missing from each dimension, listed twice, padded or NULL, so that every
    join also misses, repeats and meets NULL keys."""
    ev = read_table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type", "value",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    ).selectExpr("*", f"CAST({_home()} AS BIGINT) AS store_no", "user_id div 5 AS circle")

    supplier = read_table(spark, sf_dir, "supplier")
    stores = (supplier.join(read_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
                      .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
                      .select("s_suppkey", "s_name", "n_name", "r_name"))
    # Codes starting with X, and negative numbers, are named by no fact.
    code = "concat(CASE WHEN s_suppkey % 17 = 3 THEN 'X' ELSE 'S' END, CAST(s_suppkey AS STRING))"
    distributor = ("CASE WHEN s_suppkey % 5 = 0 THEN 'LBR' WHEN s_suppkey % 11 = 7 THEN 'OTHER' "
                   "ELSE concat('LCS ', r_name) END")
    phy_store = stores.selectExpr(f"{code} AS lego_store_code", f"{distributor} AS distributor",
                                  "r_name AS region", "s_name AS partner")
    app_store = stores.selectExpr("CAST(CASE WHEN s_suppkey % 13 = 4 THEN -1 - s_suppkey ELSE s_suppkey END AS INT) AS store_id",
                                  "n_name AS city_name", "s_name AS name")
    # Each supplier lists one campaign; every tenth one is listed as both types.
    campaign_code = supplier.selectExpr(
        "concat(CASE WHEN s_suppkey % 5 = 2 THEN 'U' ELSE 'C' END, CAST(s_suppkey AS STRING)) AS campaign_code",
        "explode(CASE WHEN s_suppkey % 10 = 5 THEN array('LTP', 'MBB') WHEN s_suppkey % 2 = 0 THEN array('LTP') "
        "ELSE array('MBB') END) AS campaign_type")

    reservation = ev.where("event_type IN ('signup', 'view', 'error')").selectExpr(
        "concat('C', CAST(circle * 2 + (k div 10) % 2 AS STRING)) AS campaign_code",
        "concat('Camp ', CAST(circle * 2 + (k div 10) % 2 AS STRING)) AS campaign_name",
        "concat('A', CAST((user_id div 25) * 2 + event_id % 2 AS STRING)) AS agent_id",
        "concat('S', CAST(store_no AS STRING)) AS store_code",
        "CAST(store_no AS INT) AS store_id",
        "CASE WHEN event_id % 83 = 1 THEN NULL ELSE concat('E', CAST(circle AS STRING), '-', CAST(k div 50 AS STRING)) END AS event_id",
        f"CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 31 = 7 THEN {_padded('user_id', 8)} "
        "ELSE CAST(user_id AS STRING) END AS type_value",
        f"CASE WHEN event_type = 'error' THEN '{P.STATUS_CANCELLED}' "
        f"WHEN event_id % 5 = 0 THEN '{STATUS_RESERVED}' ELSE '{P.STATUS_VERIFIED}' END AS res_status",
        "CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS source_type",
        "ts AS verification_time",
    )

    # A row for the user's first event; for some users also one for the last
    # event, or one for another store at the same time.
    per_user = ev.groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min_by("store_no", "event_id").alias("first_store"), F.max_by("store_no", "event_id").alias("last_store"))
    member_detail = per_user.selectExpr(
        f"CASE WHEN user_id % 53 = 52 THEN NULL WHEN user_id % 7 = 3 THEN {_padded('user_id', 10)} "
        "ELSE CAST(user_id AS STRING) END AS member_detail_id",
        "explode(filter(array(named_struct('t', first_ts, 's', first_store), "
        "CASE WHEN user_id % 4 = 1 THEN named_struct('t', last_ts, 's', last_store) END, "
        "CASE WHEN user_id % 6 = 5 THEN named_struct('t', first_ts, 's', last_store) END), x -> x IS NOT NULL)) AS m",
    ).selectExpr("member_detail_id", "m.t AS join_time", "concat('S', CAST(m.s AS STRING)) AS eff_reg_store")

    coupon_benefit = ev.where("event_type = 'click'").selectExpr(
        "CAST(user_id AS STRING) AS member_detail_id",
        "ts AS redeemed_time",
        "concat('S', CAST(store_no AS STRING)) AS redeemed_channel_code",
        f"CASE WHEN event_id % 2 = 0 THEN '{P.RECRUITMENT_COUPON_CODE}' ELSE '{OTHER_COUPON_CODE}' END AS coupon_code",
        f"CASE WHEN event_id % 4 = 2 THEN '{COUPON_ISSUED}' ELSE '{P.COUPON_STATUS_REDEEMED}' END AS coupon_status_code",
    )

    purchases = ev.where("event_type = 'purchase'")
    first_purchase = purchases.groupBy("user_id").agg(F.min("event_id").alias("first_event_id"))
    store_dist = phy_store.selectExpr("lego_store_code AS _store", "distributor AS distributor_name")
    member_order_detail = (
        purchases.selectExpr("*", "concat('S', CAST(store_no AS STRING)) AS _store")
        .join(first_purchase, "user_id", "left")
        .join(store_dist, "_store", "left")
        .selectExpr(
            f"CASE WHEN event_id % 61 = 9 THEN NULL WHEN event_id % 9 = 4 THEN {_padded('user_id', 10)} "
            "ELSE CAST(user_id AS STRING) END AS crm_member_id",
            "to_date(ts) AS date_id",
            "_store AS lego_store_code",
            "CAST(event_id div 2 AS STRING) AS original_order_id",
            "event_id % 7 <> 0 AS if_eff_order_tag",
            "CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS is_rrp_sales_type",
            "distributor_name",
            f"CASE WHEN event_id = first_event_id THEN '{P.LIFECYCLE_FIRST_ORDER}' "
            f"ELSE '{LIFECYCLE_REPEAT}' END AS initial_vs_repurchase_lifecycle",
            "CASE WHEN event_id % 11 = 0 THEN -1 ELSE 1 END AS sales_qty",
            "CAST(CASE WHEN event_id % 41 = 3 THEN NULL WHEN event_id % 17 = 2 THEN -value ELSE value END AS DECIMAL(18,2)) "
            "AS order_rrp_amt",
        )
    )

    return Sources(
        campaign_reservation=reservation,
        phy_store=phy_store,
        app_store=app_store,
        member_detail=member_detail,
        campaign_code=campaign_code,
        coupon_benefit=coupon_benefit,
        member_order_detail=member_order_detail,
    )

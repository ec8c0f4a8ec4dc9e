"""Schemas of the seven inputs, as far as the jobs use them.

The source warehouse publishes no DDL; the types are inferred from use.  Only
the listed columns are read, so wider tables are fine (column pruning reaches
the scan).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, B = T.StringType(), T.IntegerType(), T.BooleanType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CAMPAIGN_RESERVATION = _schema(
    ("campaign_code", S), ("campaign_name", S), ("agent_id", S), ("store_code", S),
    ("store_id", I), ("event_id", S), ("type_value", S), ("res_status", S),
    ("source_type", I), ("verification_time", TS),
)
PHY_STORE = _schema(("lego_store_code", S), ("distributor", S), ("region", S), ("partner", S))
APP_STORE = _schema(("store_id", I), ("city_name", S), ("name", S))
MEMBER_DETAIL = _schema(("member_detail_id", S), ("join_time", TS), ("eff_reg_store", S))
CAMPAIGN_CODE = _schema(("campaign_code", S), ("campaign_type", S))
COUPON_BENEFIT = _schema(
    ("member_detail_id", S), ("redeemed_time", TS), ("redeemed_channel_code", S),
    ("coupon_code", S), ("coupon_status_code", S),
)
MEMBER_ORDER_DETAIL = _schema(
    ("crm_member_id", S), ("date_id", T.DateType()), ("lego_store_code", S),
    ("original_order_id", S), ("if_eff_order_tag", B), ("is_rrp_sales_type", I),
    ("distributor_name", S), ("initial_vs_repurchase_lifecycle", S), ("sales_qty", I),
    ("order_rrp_amt", MONEY),
)

SCHEMAS = {
    "campaign_reservation": CAMPAIGN_RESERVATION,
    "phy_store": PHY_STORE,
    "app_store": APP_STORE,
    "member_detail": MEMBER_DETAIL,
    "campaign_code": CAMPAIGN_CODE,
    "coupon_benefit": COUPON_BENEFIT,
    "member_order_detail": MEMBER_ORDER_DETAIL,
}

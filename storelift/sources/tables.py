"""The seven inputs as one bundle of DataFrames."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .schemas import SCHEMAS


def _usable(wanted: T.DataType, given: T.DataType, column: str) -> bool:
    """Whether a column of type ``given`` can stand for the declared one.

    Whole numbers of any width, exact decimals of any size, and dates or
    timestamps of either kind are interchangeable; the day column of the order
    lines may also be text.  Floating-point amounts are not exact and refused.
    """
    days = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(wanted, days):
        return isinstance(given, days) or (column == "date_id" and isinstance(given, T.StringType))
    if isinstance(wanted, T.IntegralType):
        return isinstance(given, T.IntegralType)
    if isinstance(wanted, T.DecimalType):
        return isinstance(given, (T.DecimalType, T.IntegralType))
    if isinstance(wanted, T.StringType):
        return isinstance(given, T.StringType)
    return type(wanted) is type(given)


@dataclasses.dataclass(frozen=True)
class Sources:
    """Reservation fact, four dimensions, coupon fact and order-line fact."""

    campaign_reservation: DataFrame
    phy_store: DataFrame
    app_store: DataFrame
    member_detail: DataFrame
    campaign_code: DataFrame
    coupon_benefit: DataFrame
    member_order_detail: DataFrame

    def __post_init__(self) -> None:
        wrong = []
        for name, schema in SCHEMAS.items():
            have = {f.name: f.dataType for f in getattr(self, name).schema.fields}
            for f in schema.fields:
                if f.name not in have:
                    wrong.append(f"{name} lacks column {f.name}")
                elif not _usable(f.dataType, have[f.name], f.name):
                    wrong.append(f"{name}.{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
        if wrong:
            raise ValueError("; ".join(wrong))

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str]) -> "Sources":
        """Read the seven tables from the session catalog (role -> table name)."""
        return cls(**{role: spark.table(names[role]) for role in SCHEMAS})

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> "Sources":
        """Read the seven tables from files (one path or folder per role)."""
        return cls(**{role: spark.read.format(fmt).load(paths[role]) for role in SCHEMAS})

    @classmethod
    def from_rows(cls, spark: SparkSession, rows: dict[str, list[tuple]]) -> "Sources":
        """Build small frames with the declared schemas (tests and examples)."""
        return cls(**{role: spark.createDataFrame(rows.get(role, []), SCHEMAS[role]) for role in SCHEMAS})

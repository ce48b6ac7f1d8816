"""Event contracts: each row gets the list of rules it breaks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    required: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    country: tuple[str, ...] = ()
    currency: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def rules(self) -> dict[str, Column]:
        """Rule name to a column that is true where the rule is broken; NULL values only break 'required'."""
        broken = {f"required:{c}": F.col(c).isNull() for c in self.required}
        broken |= {f"non_negative:{c}": F.col(c) < 0 for c in self.non_negative}
        broken |= {f"positive:{c}": F.col(c) <= 0 for c in self.positive}
        broken |= {f"iso_country:{c}": ~F.col(c).rlike("^[A-Z]{2}$") for c in self.country}
        broken |= {f"iso_currency:{c}": ~F.col(c).rlike("^[A-Z]{3}$") for c in self.currency}
        broken |= {f"allowed:{c}": ~F.col(c).isin(list(v)) for c, v in self.allowed.items()}
        return broken


def with_violations(df: DataFrame, contract: Contract) -> DataFrame:
    marks = [F.when(bad, F.lit(name)) for name, bad in contract.rules().items()]
    return df.withColumn("violations", F.array_compact(F.array(*marks)))


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and violating rows with their reasons."""
    checked = with_violations(df, contract)
    bad = F.size("violations") > 0
    return checked.filter(~bad).drop("violations"), checked.filter(bad)


# Contracts of the two event feeds and the two cleaned tables.
ORDER_EVENT = Contract(
    required=("event_id", "order_id", "event_ts"), non_negative=("total_amount",), country=("country_code",),
    currency=("currency",), allowed={"event_type": ("order.created", "order.updated", "order.cancelled")})
PAYMENT_EVENT = Contract(
    required=("event_id", "payment_id", "order_id", "event_ts"), non_negative=("amount",), currency=("currency",),
    allowed={"status": ("authorized", "captured", "declined", "refunded"),
             "payment_method": ("card", "wallet", "transfer", "cash")})
FILE_PAYMENT = Contract(required=("payment_id", "order_id", "amount", "currency", "event_ts"),
                        non_negative=("amount",), currency=("currency",))
CLEAN_CUSTOMER = Contract(required=("customer_id", "customer_hash", "source_record_hash"))
CLEAN_ORDER = Contract(
    required=("order_id", "customer_id", "order_ts", "status", "currency_code", "total_amount"),
    positive=("total_amount",),
    allowed={"status": ("created", "paid", "shipped", "delivered", "cancelled", "returned")})

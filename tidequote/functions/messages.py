"""Message classification and the one-shape message projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.schema import BUY, SELL

# Which columns each kind of message fills; the first group with an order id names the message.
GROUPS = {
    "add": ("side", "price", "qty"),
    "update": ("side", "price", "qty"),
    "delete": ("side",),
    "trade": ("side", "price", "qty"),
}


def action_of(kinds: Sequence[str] = tuple(GROUPS)) -> Column:
    """The first of ``kinds`` whose order id is set, else other."""
    return F.coalesce(
        *[F.when(F.col(f"{g}_order_id").isNotNull(), F.lit(g)) for g in kinds], F.lit("other")
    )


def _active(field: str, kinds: Sequence[str]) -> Column:
    """``field`` of the column group that ``action`` names; null where the group lacks it."""
    cases = [
        F.when(F.col("action") == g, F.col(f"{g}_{field}"))
        for g in kinds
        if field == "order_id" or field in GROUPS[g]
    ]
    return F.coalesce(*cases)


def l3_messages(
    l3: DataFrame, key_cols: Sequence[str] = (), kinds: Sequence[str] = tuple(GROUPS)
) -> DataFrame:
    """Sixteen sparse columns to (keys, seq_num, time, action, order_id, side, price, qty).

    With fewer ``kinds`` the columns of the others are not read and their rows become other.
    """
    return l3.withColumn("action", action_of(kinds)).select(
        *key_cols,
        "seq_num",
        "time",
        "action",
        *[_active(f, kinds).alias(f) for f in ("order_id", "side", "price", "qty")],
    )


def is_number(price: Column) -> Column:
    """False for null and NaN, which sort below and above every price."""
    return price.isNotNull() & ~F.isnan(price)


def is_quote() -> Column:
    """Adds and updates with a known side and a usable price move the quote."""
    return (
        F.col("action").isin("add", "update")
        & F.col("side").isin(BUY, SELL)
        & is_number(F.col("price"))
    )


def quote_messages(l3: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """What the quote depends on: (keys, seq_num, time, is_bid, price, qty).

    ``is_bid`` is true for a bid, false for an ask and null for a row that quotes nothing.
    Columns of deletes and trades are not read, and only these few are shuffled. Rows that
    already have this shape pass through.
    """
    if "is_bid" in l3.columns:
        return l3
    messages = l3 if "action" in l3.columns else l3_messages(l3, key_cols, ("add", "update"))
    quoted = {"is_bid": F.col("side") == BUY, "price": F.col("price"), "qty": F.col("qty")}
    return messages.select(
        *key_cols, "seq_num", "time", *[F.when(is_quote(), c).alias(k) for k, c in quoted.items()]
    )


def two_sided() -> Column:
    """Both prices positive; an empty side is null and does not pass."""
    bid, ask = F.col("bid_price"), F.col("ask_price")
    return (bid > 0) & (ask > 0) & ~F.isnan(bid) & ~F.isnan(ask)

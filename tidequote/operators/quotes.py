"""Level-3 messages to Level-1 quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.functions.messages import (
    is_number,
    l3_messages,
    quote_messages,
    two_sided,
)
from tidequote.operators.book import full_book
from tidequote.operators.ranges import SeqRanges, plan_ranges
from tidequote.operators.scan import Running, scan
from tidequote.schema import BUY

MODES = ("best_quote", "event_quote", "as_coded", "full_book")
# Modes whose state is a few values per instrument, so that a stream can carry it.
CARRIED_MODES = ("best_quote", "event_quote", "as_coded")
INT_MAX = (1 << 31) - 1
ZEROS = {"price": 0.0, "qty": 0}
# Packing of (order value, size): sizes count down from the largest, a missing one is last.
_NUMBER = "decimal(20,0)"
BEFORE_ALL = str(-(1 << 63) - 1)
NO_SIZE = 1 << 32
SIZES = 1 << 33


def _bid(when: Column, price: Column, qty: Column) -> Column:
    """Greatest is the highest price; of one price the first message, of peers the largest size.

    A null order value comes before all others. Its bitwise complement turns the order of any long around.
    """
    seq = F.coalesce("seq_num", F.lit(0))
    fields = {"price": price, "unnumbered": F.col("seq_num").isNull(), "first": F.bitwise_not(seq), "qty": qty}
    return F.when(when, F.struct(*[c.alias(k) for k, c in fields.items()]))


def _ask(when: Column, price: Column, qty: Column) -> Column:
    """Least is the lowest price; of one price as in ``_bid``."""
    fields = {
        "price": price,
        "numbered": F.col("seq_num").isNotNull(),
        "first": F.coalesce("seq_num", F.lit(0)),
        "less": F.coalesce(F.bitwise_not(qty.cast("int")), F.lit(INT_MAX)),
        "qty": qty,
    }
    return F.when(when, F.struct(*[c.alias(k) for k, c in fields.items()]))


def quote_state(mode: str = "best_quote") -> list[Running]:
    """What a quote depends on: best bid, best ask and, by event, the last quoting message.

    Of quoting messages with one order value the last is a bid before an ask, then the one of
    the higher price and of the larger size.
    """
    if mode == "as_coded":
        buy, price, qty = F.col("is_buy"), F.col("price"), F.col("qty")
        return [
            Running("low_bid", F.min, _ask(buy & is_number(price), price, qty)),
            Running("high_ask", F.max, _bid(~buy & is_number(price), price, qty)),
        ]
    is_bid, price, qty = F.col("is_bid"), F.col("price"), F.col("qty")
    state = [
        Running("bid", F.max, _bid(is_bid, price, qty)),
        Running("ask", F.min, _ask(~is_bid, price, qty)),
    ]
    if mode == "event_quote":
        last = F.struct("seq_num", "is_bid", "price", "qty")
        state.append(Running("last", F.max, F.when(is_bid.isNotNull(), last)))
    return state


def first_at_price(messages: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """Of each group, side and price the message that ``quote_state`` would keep.

    Order value and size are packed into one decimal, whose minimum a hash aggregate can hold,
    so that messages are not sorted to be folded; what is left are price levels. ``more`` are
    further aggregates of a group, side and price.
    """
    sizes, before_all = F.lit(SIZES).cast("decimal(11,0)"), F.lit(BEFORE_ALL).cast(_NUMBER)
    number = F.coalesce(F.col("seq_num").cast(_NUMBER), before_all)
    size = F.coalesce(F.lit(INT_MAX).cast("long") - F.col("qty"), F.lit(NO_SIZE))
    packed = F.min(number * sizes + size.cast("decimal(11,0)")).alias("_packed")
    levels = messages.groupBy(*by, "is_bid", "price").agg(packed, *more)
    size = F.pmod(F.col("_packed"), sizes)
    number = ((F.col("_packed") - size) / sizes).cast(_NUMBER)
    return levels.select(
        "*",
        F.when(number != before_all, number).cast("long").alias("seq_num"),
        F.when(size != NO_SIZE, (F.lit(INT_MAX) - size).cast("long")).cast("int").alias("qty"),
    ).drop("_packed")


def _best_quote() -> dict[str, Column]:
    return {
        "bid_price": F.col("bid.price"),
        "ask_price": F.col("ask.price"),
        "bid_size": F.col("bid.qty"),
        "ask_size": F.col("ask.qty"),
    }


def _book_quote() -> dict[str, Column]:
    return {c: F.col(c) for c in ("bid_price", "ask_price", "bid_size", "ask_size")}


def _event_quote() -> dict[str, Column]:
    # Between quoting messages neither side moves, so the last quote is the last quoting
    # message on its own side and today's best on the other.
    own_bid = F.col("last.is_bid")
    own_price, own_qty = F.col("last.price"), F.col("last.qty")
    return {
        "bid_price": F.when(own_bid, own_price).otherwise(F.col("bid.price")),
        "ask_price": F.when(~own_bid, own_price).otherwise(F.col("ask.price")),
        "bid_size": F.when(own_bid, own_qty).otherwise(F.col("bid.qty")),
        "ask_size": F.when(~own_bid, own_qty).otherwise(F.col("ask.qty")),
    }


def _emit(rows: DataFrame, quote: dict[str, Column], key_cols: Sequence[str]) -> DataFrame:
    return rows.select(
        *key_cols, "time", *[c.alias(name) for name, c in quote.items()], "seq_num"
    ).where(two_sided())


def book_l1(book: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """The Level-1 rows of ``full_book``."""
    return _emit(book, _book_quote(), key_cols)


def _coded_messages(l3: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Every message read as an add, with zeros where it is none."""
    if "is_buy" in l3.columns:
        return l3
    if "action" in l3.columns:
        is_add = F.col("action") == "add"
        source = {c: F.when(is_add, F.col(c)) for c in ("side", "price", "qty")}
    else:
        source = {c: F.col(f"add_{c}") for c in ("side", "price", "qty")}
    return l3.select(
        *key_cols,
        "seq_num",
        "time",
        source["side"].eqNullSafe(BUY).alias("is_buy"),
        *[F.coalesce(source[c], F.lit(zero)).alias(c) for c, zero in ZEROS.items()],
    )


def _coded_quote() -> dict[str, Column]:
    """The stored bid only ever falls from 0, the stored ask only rises."""
    buy, price, qty = F.col("is_buy"), F.col("price"), F.col("qty")
    falls, rises = F.col("low_bid.price") < 0, F.col("high_ask.price") > 0

    def stored(name: str, moved: Column, field: str) -> Column:
        return F.when(moved, F.col(f"{name}.{field}")).otherwise(F.lit(ZEROS[field]))

    return {
        "bid_price": F.when(buy, price).otherwise(stored("low_bid", falls, "price")),
        "ask_price": F.when(buy, stored("high_ask", rises, "price")).otherwise(price),
        "bid_size": F.when(buy, qty).otherwise(stored("low_bid", falls, "qty")),
        "ask_size": F.when(buy, stored("high_ask", rises, "qty")).otherwise(qty),
    }


def carried_messages(l3: DataFrame, mode: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """What ``quote_state(mode)`` folds; rows that already have this shape pass through."""
    return _coded_messages(l3, key_cols) if mode == "as_coded" else quote_messages(l3, key_cols)


def l3_to_l1(
    l3: DataFrame,
    mode: str = "best_quote",
    key_cols: Sequence[str] = (),
    ranges: SeqRanges | None = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """One Level-1 row per message once both sides are quoted, in ``seq_num`` order.

    ``l3`` is the sixteen-column feed or its ``l3_messages`` form (but for full_book also
    ``carried_messages``); it is read several times, so land an input that
    is costly to compute. ``opening`` is the quote state before the first message (all modes
    but full_book).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if opening is not None and mode not in CARRIED_MODES:
        raise ValueError(f"mode {mode!r} takes no opening state")
    if mode == "full_book":
        messages = l3 if "action" in l3.columns else l3_messages(l3, key_cols)
        return book_l1(full_book(messages, key_cols, ranges), key_cols)
    messages = carried_messages(l3, mode, key_cols)
    ranges = ranges or plan_ranges(messages, key_cols=key_cols)
    rows = scan(
        messages,
        quote_state(mode),
        ranges,
        key_cols=key_cols,
        opening=opening,
        moves=None if mode == "as_coded" else F.col("is_bid").isNotNull(),
        reduce=first_at_price if mode == "best_quote" else None,
    )
    quote = {"best_quote": _best_quote, "event_quote": _event_quote, "as_coded": _coded_quote}
    return _emit(rows, quote[mode](), key_cols)

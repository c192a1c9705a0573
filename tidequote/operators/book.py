"""Top of the full order book after every message.

Three steps. (1) Per order: what each message adds to or takes from a price level.
(2) Per level and range of the feed: the size it opens the range with, and, for the levels
a range does not touch, only the best of them. (3) Per range: the best live level after
each message. A range thus needs its own messages and little more, however deep the book.

A delete is final, an update reopens a filled or unknown order, a trade on an unknown order
does nothing. Messages of one order that share a seq_num take effect together: trades
first, then the add or update, a delete last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidequote.functions.messages import is_number
from tidequote.operators.cover import partition_quotes
from tidequote.operators.ranges import RANGE, SeqRanges, plan_ranges
from tidequote.operators.scan import Running, join_states, scan
from tidequote.schema import BUY, SELL
from tidequote.sources.landing import land

AT = "_at"
# Order value of a null seq_num (before all others), of what the book opens with, and of a range's
# opening sizes.
FIRST_AT = -(1 << 63) + 2
BOOK_OPENS_AT = -(1 << 63) + 1
OPENING_AT = -(1 << 63)
NO_TIME = -(1 << 63)
SIDES = {BUY: 1, SELL: -1}


def _level(order: str, traded: str, gone: str) -> dict[str, Column]:
    """Side, price and remaining quantity of an order in one of its states; 0 when not live."""
    since_open = F.coalesce(F.col(traded), F.lit(0)) - F.col(f"{order}.traded")
    left = F.greatest(F.lit(0), F.col(f"{order}.qty") - since_open)
    live = (
        F.col(gone).isNull()
        & F.col(f"{order}.side").isin(*SIDES)
        & is_number(F.col(f"{order}.price"))
    )
    return {
        "side": F.col(f"{order}.side"),
        "price": F.col(f"{order}.price"),
        "left": F.when(live, F.coalesce(left, F.lit(0))).otherwise(F.lit(0)),
    }


def with_at(messages: DataFrame) -> DataFrame:
    return messages.withColumn(AT, F.coalesce("seq_num", F.lit(FIRST_AT)))


def order_states(
    messages: DataFrame,
    key_cols: Sequence[str] = (),
    ranges: SeqRanges | None = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """State of each order before and after each of its messages. ``messages`` carries ``_at``.

    ``opening`` (keys, order_id, side, price, left, gone) is what orders begin with; it counts as a
    message at ``BOOK_OPENS_AT``. Only orders with more than a range's worth of messages are cut into
    ranges; all others take one shuffle by order and plain windows.
    """
    order_key = [*key_cols, "order_id"]
    acts = messages.where(F.col("order_id").isNotNull() & (F.col("action") != "other"))
    acts = acts.select(*order_key, AT, "action", "side", "price", F.col("qty").cast("long").alias("qty"))
    if opening is not None:
        action = F.when(F.col("gone"), F.lit("delete")).otherwise(F.lit("add"))
        own = opening.withColumns({AT: F.lit(BOOK_OPENS_AT).cast("long"), "action": action, "qty": F.col("left")})
        acts = acts.unionByName(own.select(*acts.columns))
    ranges = ranges or plan_ranges(acts, AT, order_key)
    if not ranges.is_split:
        return _states(acts, key_cols, ranges)
    whole = SeqRanges(key_cols=tuple(order_key), partitions=ranges.partitions)
    long = ranges.key_is_split()
    return _states(acts.where(~long), key_cols, whole).unionByName(_states(acts.where(long), key_cols, ranges))


def level_moves(
    messages: DataFrame, key_cols: Sequence[str] = (), ranges: SeqRanges | None = None
) -> DataFrame:
    """(keys, _at, side, price, amount): changes of level sizes. ``messages`` carries ``_at``."""
    return moves_of(order_states(messages, key_cols, ranges), key_cols)


def closing_orders(states: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """(keys, order_id, side, price, left, gone) behind the last message of each order."""
    last = F.max_by(F.struct("now", "traded", "gone"), AT).alias("end")
    level = _level("end.now", "end.traded", "end.gone")
    return states.groupBy(*key_cols, "order_id").agg(last).select(
        *key_cols,
        "order_id",
        level["side"].alias("side"),
        level["price"].alias("price"),
        level["left"].cast("long").alias("left"),
        F.col("end.gone").isNotNull().alias("gone"),
    )


def _states(acts: DataFrame, key_cols: Sequence[str], ranges: SeqRanges) -> DataFrame:
    order_key = [*key_cols, "order_id"]
    if not ranges.is_split:
        acts = acts.repartition(ranges.partitions, *order_key)
    opens = F.col("action").isin("add", "update")
    per_seq = acts.groupBy(*order_key, AT).agg(
        F.sum(F.when(F.col("action") == "trade", F.col("qty"))).alias("sold"),
        F.max(F.when(opens, F.struct("side", "price", "qty"))).alias("opened"),
        F.max(F.when(F.col("action") == "delete", F.lit(1))).alias("deleted"),
    )
    sold = F.col("sold")
    traded = scan(
        per_seq,
        [Running("traded", F.sum, sold), Running("traded_before", F.sum, sold, before=True)],
        ranges,
        AT,
        order_key,
        placed=True,
    )
    opened = F.when(
        F.col("opened").isNotNull(),
        F.struct(
            F.col(AT),
            F.coalesce("traded", F.lit(0)).alias("traded"),
            F.col("opened.side").alias("side"),
            F.col("opened.price").alias("price"),
            F.col("opened.qty").alias("qty"),
        ),
    )
    return scan(
        traded,
        [
            Running("now", F.max, opened),
            Running("was", F.max, opened, before=True),
            Running("gone", F.max, F.col("deleted")),
            Running("was_gone", F.max, F.col("deleted"), before=True),
        ],
        ranges,
        AT,
        order_key,
        placed=True,
    )


def moves_of(states: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """What each message adds to or takes from price levels."""
    now, was = _level("now", "traded", "gone"), _level("was", "traded_before", "was_gone")
    stays = now["side"].eqNullSafe(was["side"]) & now["price"].eqNullSafe(was["price"])

    def move(level: dict[str, Column], amount: Column) -> Column:
        return F.struct(
            level["side"].alias("side"), level["price"].alias("price"), amount.alias("amount")
        )

    moves = F.array(
        move(was, F.when(stays, F.lit(0)).otherwise(-was["left"])),
        move(now, now["left"] - F.when(stays, was["left"]).otherwise(F.lit(0))),
    )
    return (
        states.select(*key_cols, AT, F.explode(moves).alias("move"))
        .select(
            *key_cols,
            AT,
            F.coalesce(*[F.when(F.col("move.side") == s, F.lit(v)) for s, v in SIDES.items()]).alias(
                "side"
            ),
            "move.price",
            F.col("move.amount").cast("long").alias("amount"),
        )
        .where(F.col("amount") != 0)
    )


def _best(levels: DataFrame, by: list[str], depth: int = 1) -> DataFrame:
    """Best price and its size per group, or the ``depth`` best; ``worth`` grows towards the better price.

    A group has a price once, or, where spans and blocks of one level meet, with one size.
    """
    if depth > 1:
        best_first = Window.partitionBy(*by).orderBy(F.desc("worth"))
        once = levels.groupBy(*by, "worth").agg(F.max("size").alias("size"))
        # Spark limits each partition before the shuffle to the rows that can still count
        return once.withColumn("_rank", F.row_number().over(best_first)).where(F.col("_rank") <= depth).drop("_rank")
    return levels.groupBy(*by).agg(
        F.max("worth").alias("worth"), F.max_by("size", "worth").alias("size")
    )


def _idle_best(idle: DataFrame, asked: DataFrame, ranges: SeqRanges, keys: list[str], depth: int) -> DataFrame:
    """Best level per (keys, range, side) among those that sit through the whole range.

    ``idle`` holds (keys, side, first, last, worth, size) over range numbers. Each span is
    cut into power-of-two blocks and each range looks up the blocks it lies in, so the work
    grows with the logarithm of the number of ranges, not with the length of the spans.
    """
    heights = F.sequence(F.lit(0), F.lit(ranges.count.bit_length()))
    lo, hi = F.col("lo"), F.col("hi")
    spans = _best(idle, [*keys, "side", "first", "last"], depth).withColumn("height", F.explode(heights))
    ends = spans.withColumns(
        {
            "lo": F.expr("shiftright(first + shiftleft(1, height) - 1, height)"),
            "hi": F.expr("shiftright(last + 1, height)"),
        }
    ).where(lo < hi)
    odd_ends = F.array(F.when(lo % 2 == 1, lo), F.when(hi % 2 == 1, hi - 1))
    blocks = _best(
        ends.withColumn("block", F.explode(F.array_distinct(F.array_compact(odd_ends)))),
        [*keys, "side", "height", "block"],
        depth,
    )
    lookups = asked.withColumn("height", F.explode(heights)).withColumn(
        "block", F.expr(f"shiftright({RANGE}, height)")
    )
    found = join_states(lookups, blocks, [*keys, "height", "block"], False)
    return _best(found.where(F.col("side").isNotNull()), [*keys, RANGE, "side"], depth)


def full_book(
    messages: DataFrame,
    key_cols: Sequence[str] = (),
    ranges: SeqRanges | None = None,
    moves: DataFrame | None = None,
    depth: int = 1,
) -> DataFrame:
    """Best live price and the total size at it, per message (null or NaN where a side is empty).

    With a ``depth`` of more than one it is that many best levels, in columns ``bid_price_1`` and so on.

    ``moves`` are the level moves if they are known, those at ``BOOK_OPENS_AT`` being what the levels
    hold before the first message; they are read several times.
    """
    keys = list(key_cols)
    group = [*keys, RANGE]
    messages = with_at(messages)
    if moves is None:
        moves = land(level_moves(messages, keys), "level-moves")
    ranges = ranges or plan_ranges(messages, AT, keys)
    worth = F.col("price") * F.col("side")
    asked = messages.select(*keys, AT, "seq_num", "time").withColumn(RANGE, ranges.range_of(AT))
    moves = moves.withColumn(RANGE, ranges.range_of(AT))
    opening, hot_quotes = None, None

    if ranges.is_split:
        # The null check is there for both uses of the levels to share one shuffle.
        touched = moves.where(ranges.key_is_split() & F.col("side").isNotNull())
        touched = touched.groupBy(*group, "side", "price")
        in_order = Window.partitionBy(*keys, "side", "price").orderBy(RANGE)
        levels = (
            touched.agg(F.sum("amount").alias("amount"))
            .withColumn("size", F.sum("amount").over(in_order))
            .withColumn("first", F.col(RANGE) + 1)
            .withColumn(
                "last", F.coalesce(F.lead(RANGE).over(in_order) - 1, F.lit(ranges.count - 1))
            )
            .withColumn("worth", worth)
        )
        idle = levels.where((F.col("size") > 0) & (F.col("first") <= F.col("last")))
        if keys:
            places = asked.where(ranges.key_is_split()).select(*group).distinct()
        else:
            places = messages.sparkSession.range(ranges.count).select(
                F.col("id").cast("int").alias(RANGE)
            )
        idle = _idle_best(idle.drop(RANGE, "amount"), places, ranges, keys, depth)
        held = levels.withColumn("size", F.col("size") - F.col("amount")).where("size > 0")
        columns = [*group, "side", "worth", "size"]
        opening = held.select(*columns).unionByName(idle.select(*columns))
        if ranges.hot_ranges:
            is_hot = F.col(RANGE).isin(ranges.hot_ranges)
            closing = levels.where("size > 0").select(*columns).unionByName(idle.select(*columns))
            best = _best(closing.where(is_hot), [*group, "side"], depth)
            hot_quotes = join_states(asked.where(is_hot), _by_side(best, group, depth), group, not keys)
            asked, moves, opening = (d.where(~is_hot) for d in (asked, moves, opening))

    micros = F.coalesce(F.unix_micros(F.col("time").cast("timestamp")), F.lit(NO_TIME))
    nothing = {"price": F.lit(0.0), "amount": F.lit(0).cast("long"), "micros": F.lit(NO_TIME)}
    rows = asked.select(
        *group, F.col(AT).alias("at"), micros.alias("micros"), F.lit(0).alias("side"),
        nothing["price"].alias("price"), nothing["amount"].alias("amount"),
    ).unionByName(
        moves.select(
            *group, F.col(AT).alias("at"), nothing["micros"].alias("micros"),
            "side", "price", "amount",
        )
    )
    if opening is not None:
        rows = rows.unionByName(
            opening.select(
                *group, F.lit(OPENING_AT).alias("at"), nothing["micros"].alias("micros"),
                "side", worth_price().alias("price"), F.col("size").alias("amount"),
            )
        )
    columns = level_columns(depth)
    result = T.StructType(
        [asked.schema[k] for k in keys]
        + [T.StructField(c, T.LongType()) for c in ("at", "micros")]
        + [T.StructField(c, T.DoubleType() if "price" in c else T.LongType()) for c in columns]
    )
    in_order = ranges.place(rows).sortWithinPartitions(*group, "at", F.col("side") == 0)
    deeper = {"depth": depth} if depth > 1 else {}
    worked = partition_quotes(group, keys, OPENING_AT, **deeper)
    quotes = (
        in_order.mapInPandas(worked, result)
        .select(
            *keys,
            F.nullif("at", F.lit(FIRST_AT)).alias("seq_num"),
            F.timestamp_micros(F.nullif("micros", F.lit(NO_TIME)))
            .cast(messages.schema["time"].dataType)
            .alias("time"),
            *columns,
        )
    )
    return quotes if hot_quotes is None else quotes.unionByName(hot_quotes.select(*quotes.columns))


def worth_price() -> Column:
    return F.col("worth") * F.col("side")


def level_columns(depth: int) -> list[str]:
    if depth == 1:
        return ["bid_price", "ask_price", "bid_size", "ask_size"]
    return [f"{side}_{c}_{i + 1}" for i in range(depth) for c in ("price", "size") for side in ("bid", "ask")]


def _by_side(best: DataFrame, group: list[str], depth: int) -> DataFrame:
    def of(side: int, column: Column) -> Column:
        return F.max(F.when(F.col("side") == side, column))

    if depth == 1:
        return best.groupBy(*group).agg(
            of(1, worth_price()).alias("bid_price"),
            of(-1, worth_price()).alias("ask_price"),
            of(1, F.col("size")).alias("bid_size"),
            of(-1, F.col("size")).alias("ask_size"),
        )
    at = F.row_number().over(Window.partitionBy(*group, "side").orderBy(F.desc("worth")))
    return (
        best.withColumn("_at", at)
        .groupBy(*group)
        .agg(
            *[
                F.max(F.when((F.col("side") == side) & (F.col("_at") == i + 1), column)).alias(f"{name}_{c}_{i + 1}")
                for i in range(depth)
                for c, column in (("price", worth_price()), ("size", F.col("size")))
                for name, side in (("bid", 1), ("ask", -1))
            ]
        )
    )


def book_depth(
    messages: DataFrame, depth: int, key_cols: Sequence[str] = (), ranges: SeqRanges | None = None
) -> DataFrame:
    """The ``depth`` best levels of both sides after each message, once both sides are quoted.

    (keys, seq_num, time, bid_price_1, ask_price_1, bid_size_1, ask_size_1, bid_price_2, ...); null
    where there are fewer levels. ``messages`` are as ``l3_messages`` gives them.
    """
    if depth < 2:
        raise ValueError("l3_to_l1 gives the best level; depth begins at 2")
    book = full_book(messages, key_cols, ranges, depth=depth)
    shown = [
        F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if "price" in c
        else F.when(F.col(c) > 0, F.col(c)).alias(c)
        for c in level_columns(depth)
    ]
    both = (F.col("bid_price_1") > 0) & (F.col("ask_price_1") > 0)
    return book.select(*key_cols, "seq_num", "time", *shown).where(both)

"""The full book over an endless feed.

Between micro-batches two things are kept. Orders, by id: the price and what is left of live ones,
and ids that were deleted, because a delete is final. And the size of every price level. A
micro-batch looks up only the orders that its messages name, opens its book with the levels, and
runs the same ranges as the batch job; then it adds the new state of these orders as a version.

A filled order is not kept: an update would open it anew as it would an unknown one. A deleted id is
forgotten once no message has named it for ``forget_after`` of event time, so the state holds the
live orders and the ids deleted of late, however long the feed runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tidequote.functions.messages import l3_messages
from tidequote.operators.book import AT, BOOK_OPENS_AT, closing_orders, full_book, moves_of, order_states, with_at
from tidequote.operators.quotes import book_l1
from tidequote.operators.windows import micros
from tidequote.sources.landing import land, landing_area
from tidequote.streaming.per_batch import batch_ranges, write_sized_batch
from tidequote.streaming.versioned import VersionedTable, read_progress, write_progress

LATE = "_late"


def order_table(state_path: str, key_fields: Sequence[T.StructField] = (), compact_every: int = 8) -> VersionedTable:
    """The kept orders; ``gone_at`` is the latest time of the feed when a deleted id was last named."""
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("order_id", T.LongType()),
            T.StructField("side", T.StringType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("left", T.LongType()),
            T.StructField("gone", T.BooleanType()),
            T.StructField("gone_at", T.LongType()),
        ]
    )
    keys = (*(f.name for f in key_fields), "order_id")
    return VersionedTable(f"{state_path}/orders", keys, schema, compact_every)


def level_table(state_path: str, key_fields: Sequence[T.StructField] = (), compact_every: int = 8) -> VersionedTable:
    """The size of every price level; a level that was emptied goes with the next base."""
    keys = [*key_fields, T.StructField("side", T.IntegerType()), T.StructField("price", T.DoubleType())]
    schema = T.StructType([*keys, T.StructField("amount", T.LongType())])
    return VersionedTable(f"{state_path}/levels", tuple(f.name for f in keys), schema, compact_every)


def continuous_book_sink(
    path: str,
    state_path: str,
    key_fields: Sequence[T.StructField] = (),
    drop_later_than: str | None = None,
    forget_after: str = "7 days",
    block_size: int = 128,
    delimiter: str = ",",
    header: bool | str = True,
    compact_every: int = 8,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that goes on with the book of the batch before.

    Messages count in the order of ``seq_num`` within a batch, after all of earlier batches.
    ``drop_later_than`` bounds the lateness, as in ``continuous_sink``.
    """
    keys = [f.name for f in key_fields]
    orders = order_table(state_path, key_fields, compact_every)
    levels = level_table(state_path, key_fields, compact_every)
    progress = f"{state_path}/progress"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest, dropped = read_progress(spark, progress, batch_id)
        is_late = F.lit(False)
        if drop_later_than is not None and latest is not None:
            is_late = F.coalesce(F.unix_micros("time") < latest - micros(drop_later_than), F.lit(False))
        arrived = l3_messages(batch, keys).withColumn(LATE, is_late).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with landing_area(spark):
                messages = arrived.where(~F.col(LATE)).drop(LATE)
                seen = arrived.agg(
                    F.max(F.when(~F.col(LATE), F.unix_micros("time"))).alias("latest"),
                    F.count_if(LATE).alias("late"),
                ).first()
                known = orders.current(spark, batch_id, messages.where("order_id is not null"))
                known = known.where(_remembered(latest, forget_after))
                states = land(order_states(with_at(messages), keys, opening=known), "order-states")
                # levels at prices that this batch does not move may still be the best
                open_levels = levels.current(spark, batch_id).where("amount != 0")
                opening = open_levels.select(*keys, F.lit(BOOK_OPENS_AT).cast("long").alias(AT), "side", "price", "amount")
                moves = land(moves_of(states, keys).where(F.col(AT) > BOOK_OPENS_AT).unionByName(opening), "level-moves")
                book = full_book(messages, keys, batch_ranges(messages, keys), moves)
                write_sized_batch(book_l1(book, keys), batch_id, path, block_size, delimiter, header)
                latest = max((t for t in (latest, seen["latest"]) if t is not None), default=None)
                gone_at = F.when(F.col("gone"), F.lit(latest).cast("long"))
                orders.write(closing_orders(states, keys).withColumn("gone_at", gone_at), batch_id)
                totals = moves.groupBy(*levels.keys).agg(
                    F.sum("amount").alias("amount"), F.max(AT).alias("moved")
                )
                levels.write(totals.where(F.col("moved") > BOOK_OPENS_AT), batch_id)
        finally:
            arrived.unpersist()
        orders.compact(spark, batch_id, _remembered(latest, forget_after) & (F.col("gone") | (F.col("left") > 0)))
        levels.compact(spark, batch_id, F.col("amount") != 0)
        write_progress(spark, progress, batch_id, latest, dropped + seen["late"])

    return write


def _remembered(latest: int | None, forget_after: str):
    """False for a deleted id that no message has named for long."""
    if latest is None:
        return F.lit(True)
    return ~F.col("gone") | F.coalesce(F.col("gone_at") >= latest - micros(forget_after), F.lit(True))


def kept_orders(spark: SparkSession, state_path: str, key_fields: Sequence[T.StructField], batch_id: int, compact_every: int = 8) -> DataFrame:
    """The orders that are known before batch ``batch_id``."""
    return order_table(state_path, key_fields, compact_every).current(spark, batch_id)

"""Best quote over all instruments or venues, after every quote of any of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.operators.book import full_book, level_moves, with_at
from tidequote.operators.quotes import book_l1
from tidequote.operators.ranges import ROWS_PER_RANGE, plan_ranges
from tidequote.schema import BUY, SELL
from tidequote.sources.landing import land


def consolidated(l1: DataFrame, key_cols: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One Level-1 row per row of ``l1``: the best of the keys' latest quotes, sizes at a price added up.

    A key's quote on a side holds until its next one, so it is to the consolidated book what an
    order is to a full book: the next quote updates it. The moves of each side of each key, and then
    the best level over the lifetimes, are those of the full book, by ranges of ``seq_num``; a
    key with most of the rows is cut into ranges too. ``l1`` is read several times.
    """
    sides = F.array(
        *[
            F.struct(F.lit(side).alias("side"), F.col(f"{name}_price").alias("price"), F.col(f"{name}_size").cast("long").alias("qty"))
            for side, name in ((BUY, "bid"), (SELL, "ask"))
        ]
    )
    quotes = l1.select(*key_cols, "seq_num", "time", F.explode(sides).alias("own")).select(
        "seq_num", "time", F.lit("update").alias("action"), F.struct(*key_cols, "own.side").alias("order_id"), "own.*"
    )
    quotes = with_at(quotes)
    of_sides = plan_ranges(quotes, "_at", ["order_id"], rows_per_range)
    moves = land(level_moves(quotes, (), of_sides), "quote-moves")
    asked = l1.select("seq_num", "time")
    return book_l1(full_book(asked, (), plan_ranges(asked, rows_per_range=rows_per_range), moves))

"""Messages that a feed delivers more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COPIES, CONFLICTS = "copies", "versions"


def counted_messages(l3: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """Each different message once, with ``copies`` and, for its ``seq_num``, the number of ``versions``.

    Equal rows are counted before they are dealt, so however often a message is repeated it is one row
    of the shuffle. Rows without a ``seq_num`` cannot be told from each other: they are all kept, as
    rows of one copy, and are no versions of one another.
    """
    numbered = l3.where(F.col("seq_num").isNotNull())
    once = numbered.groupBy(*l3.columns).agg(F.count("*").alias(COPIES))
    same = Window.partitionBy(*key_cols, "seq_num")
    told = once.withColumn(CONFLICTS, F.count("*").over(same))
    one = F.lit(1).cast("long")
    return told.unionByName(l3.where(F.col("seq_num").isNull()).withColumn(COPIES, one).withColumn(CONFLICTS, one))


def without_replays(l3: DataFrame, key_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(messages, conflicts): every message once, and apart those that share a ``seq_num`` and differ."""
    told = counted_messages(l3, key_cols)
    return (
        told.where(F.col(CONFLICTS) == 1).select(*l3.columns),
        told.where(F.col(CONFLICTS) > 1).select(*l3.columns, COPIES, CONFLICTS),
    )

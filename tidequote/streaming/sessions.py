"""Sessions over an endless feed, each written once when it can no longer grow.

Kept between micro-batches are the panes of sessions that are still open. A batch merges its own panes
into them, puts the sessions together over ranges as the batch job does, writes those that ended before the
watermark, and marks their panes as done, which go with the next base. Spark's own session
windows need a key besides the session and hold all of a key in one task; this needs neither.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tidequote.functions.messages import quote_messages
from tidequote.operators.quotes import quote_state
from tidequote.operators.sessions import FIRST, LAST, PANE, SESSION, session_panes, sessions_of, with_sessions
from tidequote.operators.windows import micros, shape_windows
from tidequote.sources.landing import land, landing_area
from tidequote.streaming.corrected import ASK, BID, LATE
from tidequote.streaming.per_batch import write_sized_batch
from tidequote.streaming.versioned import VersionedTable, read_progress, write_progress


def pane_table(state_path: str, key_fields: Sequence[T.StructField] = (), compact_every: int = 8) -> VersionedTable:
    longs = [T.StructField(c, T.LongType()) for c in (PANE, FIRST, LAST)]
    folds = [T.StructField("bid", BID), T.StructField("ask", ASK), T.StructField("n", T.LongType())]
    schema = T.StructType([*key_fields, *longs, *folds, T.StructField("done", T.BooleanType())])
    return VersionedTable(f"{state_path}/panes", (*(f.name for f in key_fields), PANE), schema, compact_every)


def session_sink(
    path: str,
    state_path: str,
    gap: str,
    lateness: str = "30 minutes",
    key_fields: Sequence[T.StructField] = (),
    block_size: int = 128,
    delimiter: str = ",",
    header: bool | str = True,
    compact_every: int = 8,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: sized CSV of the sessions that a micro-batch closes.

    A session is closed when its end is before the latest time seen less ``lateness``. Rows behind what
    that was for the batch before are dropped and counted; rows without a time are in no session.
    """
    keys = [f.name for f in key_fields]
    table = pane_table(state_path, key_fields, compact_every)
    progress = f"{state_path}/progress"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest, dropped = read_progress(spark, progress, batch_id)
        is_late = F.lit(False)
        if latest is not None:
            is_late = F.coalesce(F.unix_micros("time") < latest - micros(lateness), F.lit(False))
        arrived = quote_messages(batch, keys).withColumn(LATE, is_late).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with landing_area(spark):
                seen = arrived.agg(
                    F.max(F.when(~F.col(LATE), F.unix_micros("time"))).alias("latest"), F.count_if(LATE).alias("late")
                ).first()
                latest = max((t for t in (latest, seen["latest"]) if t is not None), default=None)
                own = session_panes(arrived.where(~F.col(LATE)).drop(LATE), gap, keys).withColumn("_new", F.lit(True))
                known = table.current(spark, batch_id).where(~F.col("done"))
                known = known.select(*keys, PANE, FIRST, LAST, "bid", "ask", "n", F.lit(False).alias("_new"))
                folds = [r.fold(F.col(r.name)).alias(r.name) for r in quote_state()]
                merged = own.unionByName(known).groupBy(*keys, PANE).agg(
                    F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST), *folds, F.sum("n").alias("n"),
                    F.max("_new").alias("_new"),
                )
                panes = land(with_sessions(land(merged, "open-panes"), gap, keys), "panes-with-sessions")
                sessions = sessions_of(panes, gap, keys)
                limit = -(1 << 62) if latest is None else latest - micros(lateness)
                ends = F.col(LAST) + micros(gap) < limit
                write_sized_batch(shape_windows(sessions.where(ends), keys), batch_id, path, block_size, delimiter, header)
                closed = sessions.where(ends).select(
                    *[F.col(k).alias(f"_right_{k}") for k in keys], F.col(SESSION).alias(f"_right_{SESSION}"), F.lit(True).alias("_closed")
                )
                on = F.col(SESSION) == F.col(f"_right_{SESSION}")
                for k in keys:
                    on = on & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
                marked = panes.join(closed, on, "left").withColumn("done", F.coalesce("_closed", F.lit(False)))
                table.write(marked.where(F.col("_new") | F.col("done")), batch_id)
        finally:
            arrived.unpersist()
        table.compact(spark, batch_id, ~F.col("done"))
        write_progress(spark, progress, batch_id, latest, dropped + seen["late"])

    return write

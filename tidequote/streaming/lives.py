"""The lives of orders over an endless feed: a join of two streams by order and time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidequote.operators.lives import order_lives
from tidequote.sources.files import stream_settings
from tidequote.streaming.windowed import watermarked


def life_stream(
    stream: DataFrame, most: str = "1 hour", lateness: str = "30 minutes", key_cols: Sequence[str] = ()
) -> DataFrame:
    """``order_lives`` for an append sink: an ending at once, an add without one when it expires.

    Kept are adds for ``most`` and endings for as long as adds before them may arrive, so the state is bounded
    by the messages of ``most`` and ``lateness`` whatever the length of the feed. Either side may come first;
    rows later than ``lateness`` are dropped. An add expires when the watermark is ``most`` behind it, so the
    last ones of a feed that has stopped wait for a message of a later time; one without any order will do.
    Start it inside ``life_state``, so that what is kept need not fit into memory.
    """
    return order_lives(watermarked(stream, lateness), most, key_cols)


@contextmanager
def life_state(spark: SparkSession, stores: int | None = None) -> Iterator[None]:
    """Settings of the state of a ``life_stream`` started inside the block: on disk, few stores.

    By default Spark keeps four stores for each shuffle partition in memory and writes a file for each of
    them in every micro-batch, also where it has no rows. Here it is one store on disk for each of ``stores``
    partitions, by default two per core at hand and no more than the session's shuffle partitions. Rows kept
    are not counted in the progress, as that reads before every write. A checkpoint holds on to the format and
    the number of stores of its first start.
    """
    state, rocksdb = "spark.sql.streaming.stateStore", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    partitions = "spark.sql.shuffle.partitions"
    stores = stores or min(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get(partitions)))
    wanted = {
        partitions: str(stores),
        f"{state}.providerClass": rocksdb,
        f"{state}.rocksdb.changelogCheckpointing.enabled": "true",
        f"{state}.rocksdb.boundedMemoryUsage": "true",
        f"{state}.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.streaming.join.stateFormatVersion": "3",
    }
    with stream_settings(spark, wanted):
        yield

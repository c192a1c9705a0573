"""Rows of a text feed that do not hold, split off with a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote.functions.messages import GROUPS
from tidequote.schema import BUY, L3_SCHEMA, SELL
from tidequote.sources.landing import land_measured

REASON, LINE = "reason", "line"


@dataclass(frozen=True)
class Intake:
    """``good`` is typed, ``bad`` holds the line as it came and the reason; counts are exact."""

    good: DataFrame
    bad: DataFrame
    rows: int
    good_rows: int
    bad_rows: int


def feed_rules() -> list[tuple[str, Column]]:
    """(reason, condition of a bad row) over the typed columns of the Level-3 feed, first match counts."""
    ids = [F.when(F.col(f"{g}_order_id").isNotNull(), 1).otherwise(0) for g in GROUPS]
    filled = sum(ids[1:], ids[0])
    sides = [F.col(f"{g}_side") for g in GROUPS]
    unknown = [s.isNotNull() & ~s.isin(BUY, SELL) for s in sides]
    amounts = [F.col(f"{g}_qty") < 0 for g, own in GROUPS.items() if "qty" in own]
    any_of = lambda conditions: F.coalesce(F.greatest(*[F.coalesce(c, F.lit(False)) for c in conditions]), F.lit(False))
    return [
        ("seq_num: missing", F.col("seq_num").isNull()),
        ("several kinds of message", filled > 1),
        ("side: unknown", any_of(unknown)),
        ("qty: negative", any_of(amounts)),
    ]


def intake(
    spark: SparkSession,
    path: str,
    schema: T.StructType = L3_SCHEMA,
    delimiter: str = ",",
    header: bool | str = True,
    rules: Sequence[tuple[str, Column]] | None = None,
) -> Intake:
    """Reads a CSV once and splits it: rows that parse and pass ``rules``, and all others.

    A row has too few or too many fields, or a field that is not of its type (``<column>: not <type>``),
    or meets a rule. Good and bad rows add up to the lines read. The split is landed, so both sides are
    scans of it, and the counts are taken while it is written.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    with_line = T.StructType([*texts.fields, T.StructField(LINE, T.StringType())])
    reader = spark.read.schema(with_line).option("sep", delimiter).option("header", str(header).lower())
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    wrong = [
        F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}"))
        for f in schema.fields
    ]
    line = F.coalesce(LINE, F.to_csv(F.struct(*texts.names), {"sep": delimiter}))
    cast = raw.select(
        F.coalesce(F.when(F.col(LINE).isNotNull(), F.lit("number of fields")), *wrong).alias(REASON),
        line.alias(LINE),
        *[c.alias(name) for name, c in typed.items()],
    )
    chosen = feed_rules() if rules is None and schema == L3_SCHEMA else rules or []
    reason = F.coalesce(F.col(REASON), *[F.when(bad, F.lit(why)) for why, bad in chosen], F.lit(None).cast("string"))
    split = cast.withColumn(REASON, reason)
    # the line is kept of bad rows alone
    split = split.withColumn(LINE, F.when(F.col(REASON).isNotNull(), F.col(LINE)))
    landed, seen = land_measured(split, "intake", rows=F.count("*"), bad_rows=F.count(REASON))
    good = landed.where(F.col(REASON).isNull()).select(*schema.names)
    bad = landed.where(F.col(REASON).isNotNull()).select(REASON, LINE)
    return Intake(good, bad, seen["rows"], seen["rows"] - seen["bad_rows"], seen["bad_rows"])

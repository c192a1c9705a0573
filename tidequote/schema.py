"""Fixed input and output schemas."""

from pyspark.sql import types as T

# The feed's column names, order and types.
L3_SCHEMA = T.StructType(
    [
        T.StructField("seq_num", T.LongType()),
        T.StructField("add_order_id", T.LongType()),
        T.StructField("add_side", T.StringType()),
        T.StructField("add_price", T.DoubleType()),
        T.StructField("add_qty", T.IntegerType()),
        T.StructField("update_order_id", T.LongType()),
        T.StructField("update_side", T.StringType()),
        T.StructField("update_price", T.DoubleType()),
        T.StructField("update_qty", T.IntegerType()),
        T.StructField("delete_order_id", T.LongType()),
        T.StructField("delete_side", T.StringType()),
        T.StructField("trade_order_id", T.LongType()),
        T.StructField("trade_side", T.StringType()),
        T.StructField("trade_price", T.DoubleType()),
        T.StructField("trade_qty", T.IntegerType()),
        T.StructField("time", T.TimestampType()),
    ]
)

# The Level-1 record.
L1_SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("bid_size", T.IntegerType()),
        T.StructField("ask_size", T.IntegerType()),
        T.StructField("seq_num", T.LongType()),
    ]
)

# Side names.
BUY = "BUY"
SELL = "SELL"


def keyed_schema(schema: T.StructType, key_fields: list[T.StructField]) -> T.StructType:
    """``schema`` followed by instrument key columns."""
    return T.StructType(schema.fields + list(key_fields))

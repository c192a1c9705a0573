"""Token counts by rank-synchronous array merging (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.llm import bpe
from tidequote.llm.textbytes import chunks


def count_tokens(
    docs: DataFrame, limit: int = 512, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (``n_tokens > limit``).

    Counts are those of the ``tokenizers`` library for the byte-level BPE file at ``path``
    (executors look up their own installed copy where it is None). Other columns are not read,
    so clashing names do no harm. A null or empty text has 0 bytes and 0 tokens; repeated rows
    are counted one by one; an empty table gives an empty result; a null id is kept. One pass
    without a shuffle; memory is bounded by 2 MB of text or the longest text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(path)
        for batch in batches:
            for rows, data, offsets in chunks(batch, "t"):
                tokens = model.token_counts(data, offsets)
                yield pa.record_batch(
                    [rows.column("i"), pa.array(np.diff(offsets)), pa.array(tokens.astype(np.int64))],
                    names=[id_col, "n_bytes", "n_tokens"],
                )

    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    counted = own.mapInArrow(count, f"`{id_col}` long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

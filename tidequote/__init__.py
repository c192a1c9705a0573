"""Level-3 order messages to Level-1 quotes, on PySpark."""

from tidequote.functions.messages import l3_messages
from tidequote.operators.asof import asof_join
from tidequote.operators.book import book_depth
from tidequote.operators.consolidated import consolidated
from tidequote.operators.quotes import MODES, l3_to_l1
from tidequote.operators.replays import without_replays
from tidequote.operators.sessions import l1_sessions
from tidequote.operators.weighted import time_weighted
from tidequote.operators.windows import l1_windows
from tidequote.plans.jobs import BatchOptions, StreamOptions, run_batch, run_stream
from tidequote.schema import L1_SCHEMA, L3_SCHEMA
from tidequote.sources.quarantine import intake

__all__ = [
    "BatchOptions",
    "L1_SCHEMA",
    "L3_SCHEMA",
    "MODES",
    "StreamOptions",
    "asof_join",
    "book_depth",
    "consolidated",
    "intake",
    "l1_sessions",
    "l1_windows",
    "l3_messages",
    "l3_to_l1",
    "run_batch",
    "run_stream",
    "time_weighted",
    "without_replays",
]

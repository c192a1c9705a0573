"""Repair of conversation structure by iterative-deepening A* (operator 12).

A conversation is well formed if its role initials are ``(s?(ua)+)?``. Edits delete a row, insert an
empty one, keep a row or give it another role; their initials in order are the audit. The search goes
depth first through the edits in ASCII order under a bound on the cost that rises to the least
cost not yet tried, so that the first accepting path is the cheapest one and of equals the ASCII-least.
A table keeps, for every (row, last role), the cost that was found not to be enough from there.

Rows are dealt by ranges of (conversation, turn, role, text). A conversation that lies within one task
and one block of ``BLOCK_ROWS`` rows is done there. A longer one, or one across tasks, goes on as
blocks: the cost of a block from every last role to every other is a small matrix, those matrices give
the least cost from the end of every block on, blocks are then searched in parallel for each last role
they may begin with, and a last pass puts the searched pieces together. That pass reads a
conversation in order, row block by row block, as its digest has to; it holds one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.llm.columns import free_names
from tidequote.sources.landing import land

BLOCK_ROWS = 64
BLOCK_BYTES = 4 << 20
PREFIX = 64  # characters of a text that range bounds look at
MOST = (1 << 63) - 1

# The last role of what is repaired so far: none, system, user, assistant; also the kinds of rows.
START, S, U, A = range(4)
OTHER = START
AFTER = {START: U, S: U, U: A, A: U}
DELETE, RENAME, INSERT, CUT_OFF = 3, 2, 2, 1
# Cost of what has to be inserted behind the last row, and its edits.
CLOSING = (0, 4, 2, 0)
CLOSING_EDITS = ("", "II", "I", "")
NAMES = {U: "user", A: "assistant"}
# A row as one byte: its kind, whether it must go, whether its text is cut off.
MUST_GO, TRUNCATED = 4, 8
FAR = 1 << 40

STATS = ("blank", "duplicate", "truncated", "illegal")
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_LEGAL = {(S, U), (U, A), (A, U)}


def _row_costs(code: int) -> np.ndarray:
    """Least cost from each last role to each over inserts and then one row."""
    inserts = np.full((4, 4), FAR)
    for p in range(4):
        q, cost = p, 0
        for _ in range(3):
            inserts[p, q] = min(inserts[p, q], cost)
            q, cost = AFTER[q], cost + INSERT
    step = np.full((4, 4), FAR)
    for p in range(4):
        step[p, p] = DELETE
        if not code & MUST_GO:
            own, extra = code & 3, CUT_OFF if code & TRUNCATED else 0
            if own == S and p == START:
                step[p, S] = extra
            step[p, AFTER[p]] = min(step[p, AFTER[p]], extra + (0 if own == AFTER[p] else RENAME))
    return (inserts[:, :, None] + step[None]).min(1)


ROW_COSTS = [_row_costs(code) for code in range(16)]


def block_costs(codes: bytes) -> np.ndarray:
    total = np.where(np.eye(4, dtype=bool), 0, FAR)
    for code in codes:
        total = (total[:, :, None] + ROW_COSTS[code][None]).min(1)
    return np.minimum(total, FAR)


def search(codes: bytes, start: int = START, ahead: tuple[int, ...] = CLOSING, bound: int = 0) -> tuple[str, int, int]:
    """(edits, last role, cost) of the ASCII-least cheapest path over the rows ``codes``.

    ``ahead`` is the least cost behind these rows for each last role; ``bound``, if known, the
    least cost of all. Inserts behind the last row belong to what is ahead.
    """
    n = len(codes)
    least = [0] * (n + 1)  # what the rows from here on cost at least, whatever the last role
    least[n] = min(ahead)
    for i in range(n - 1, -1, -1):
        code = codes[i]
        own = DELETE if code & MUST_GO else (CUT_OFF if code & TRUNCATED else 0) + (RENAME if code & 3 == OTHER else 0)
        least[i] = least[i + 1] + min(own, DELETE)
    short: dict[int, int] = {}  # (row, last role) -> least cost from there that is not refuted

    def needed(i: int, p: int) -> int:
        return short.get(4 * i + p, least[i] if i < n else ahead[p])

    def edits(i: int, p: int) -> Iterator[tuple[str, int, int, int]]:
        if i == n:
            return
        code, then = codes[i], AFTER[p]
        yield "D", DELETE, i + 1, p
        yield "I", INSERT, i, then
        if not code & MUST_GO:
            own, extra = code & 3, CUT_OFF if code & TRUNCATED else 0
            if own == then or own == S and p == START:
                yield "K", extra, i + 1, own
            if own != then:
                yield "R", extra + RENAME, i + 1, then

    bound = max(bound, needed(0, start))
    while True:
        path, stack = [], [[0, start, 0, edits(0, start), FAR]]
        if n == 0:
            return "", start, bound
        while stack:
            i, p, spent, options, beyond = top = stack[-1]
            edit = next(options, None)
            if edit is None:  # all edits failed: remember how much this place needs
                stack.pop()
                short[4 * i + p] = max(needed(i, p), beyond)
                if stack:
                    path.pop()
                    stack[-1][4] = min(stack[-1][4], beyond + spent - stack[-1][2])
                continue
            letter, cost, j, q = edit
            want = cost + needed(j, q)
            if spent + want > bound:
                top[4] = min(beyond, want)
                continue
            path.append(letter)
            if j == n:
                return "".join(path), q, bound
            stack.append([j, q, spent + cost, edits(j, q), FAR])
        bound = needed(0, start)


def applied(codes: bytes, edits: str, last: int, kept: list[tuple[str, str]]) -> tuple[list[str], int]:
    """(repaired lines, last role); ``kept`` are role and text of the rows that need not go."""
    lines, row, at = [], 0, 0
    for edit in edits:
        if edit == "I":
            last = AFTER[last]
            lines.append(f"{NAMES[last]}:")
            continue
        code = codes[row]
        row += 1
        if edit != "D":
            role, text = kept[at]
            last = code & 3 if edit == "K" else AFTER[last]
            lines.append(f"{role if edit == 'K' else NAMES[last]}:{text}")
        at += not code & MUST_GO
    return lines, last


def damaged(table: DataFrame) -> DataFrame:
    """(conv_id, gone, turn, role, text, n): rows after damage, equal ones counted.

    A conversation whose rows were dropped keeps one row that is ``gone``.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = table.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key) % 20).alias("damage"),
    )
    hit = [F.col("damage") == k for k in range(5)]
    text = F.when(hit[1], "").when(hit[2], F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        own.select(
            "conv_id",
            hit[0].alias("gone"),
            F.when(~hit[0], F.col("turn")).alias("turn"),
            F.when(hit[0], "").when(hit[4], "user").otherwise(F.col("role")).alias("role"),
            F.when(hit[0], "").otherwise(text).alias("text"),
            F.when(hit[3], 2).otherwise(1).alias("copies"),
        )
        .groupBy("conv_id", "gone", "turn", "role", "text")
        .agg(F.sum("copies").alias("n"))
    )


def _kind(role: Column) -> Column:
    initial = F.left(role, F.lit(1))
    return F.coalesce(*[F.when(initial == c, F.lit(k)) for c, k in (("s", S), ("u", U), ("a", A))], F.lit(OTHER))


def marked(rows: DataFrame) -> DataFrame:
    """Adds ``kind``, ``blank``, ``truncated`` and ``seen``: role and text are in an earlier row."""
    own = rows.withColumns(
        {
            "kind": _kind(F.col("role")),
            "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
            "truncated": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
            "digest": F.sha2("text", 256),
        }
    )
    # only groups with several turns matter; their first turn is null if any is
    first = (
        own.where(~F.col("gone"))
        .groupBy("conv_id", "role", "digest")
        .agg(F.min("turn").alias("first"), (F.count("*") > F.count("turn")).alias("unturned"), F.count("*").alias("turns"))
        .where("turns > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first", "unturned", F.lit(True).alias("many"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    is_first = F.when(F.col("unturned"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    seen = F.coalesce("many", F.lit(False)) & ~F.coalesce(is_first, F.lit(False))
    return own.join(first, same, "left").withColumn("seen", seen).drop("c", "r", "d", "digest", "first", "unturned", "many")


_BLOCK = {
    "conv_id": pa.int64(), "block": pa.int64(), "codes": pa.binary(), "roles": pa.list_(pa.string()),
    "texts": pa.list_(pa.string()), "costs": pa.list_(pa.int64()), "turns": pa.list_(pa.int64()),
    "first_kind": pa.int32(), "last_kind": pa.int32(), "gaps": pa.int64(), **dict.fromkeys(STATS, pa.int64()),
    "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string(),
}
BLOCK_SCHEMA = (
    "conv_id long, block long, codes binary, roles array<string>, texts array<string>, costs array<long>, "
    "turns array<long>, first_kind int, last_kind int, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string, repaired_sha256 string"
)
_OUT_ROWS = 1024


class _Block:
    def __init__(self):
        self.codes, self.kept, self.bytes = bytearray(), [], 0
        self.turns: list[int] = []  # least, most, number
        self.stats = dict.fromkeys(STATS, 0)
        self.first = self.last = None

    def add(self, row: dict, seen: bool) -> None:
        kind, blank = row["kind"], row["blank"]
        fault = "blank" if blank else "duplicate" if seen else "truncated" if row["truncated"] else None
        if fault:
            self.stats[fault] += 1
        if self.last is None:
            self.first = kind
        elif (self.last, kind) not in _LEGAL:
            self.stats["illegal"] += 1
        self.last = kind
        turn = row["turn"]
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        if blank or seen:
            self.codes.append(kind | MUST_GO)
        else:
            self.codes.append(kind | (TRUNCATED if fault else 0))
            self.kept.append((row["role"], row["text"]))
            self.bytes += len(row["text"])


def _gaps(turns: list[int]) -> int:
    return min(turns[1] - turns[0] + 1 - turns[2], MOST) if turns else 0


def _batches(rows: Iterator[dict], fields: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row.get("texts") or ()))
        if len(held) >= _OUT_ROWS or size > BLOCK_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in held], t) for c, t in fields.items()], names=list(fields))
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in held], t) for c, t in fields.items()], names=list(fields))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for a in range(0, batch.num_rows, _OUT_ROWS):
            yield from batch.slice(a, _OUT_ROWS).to_pylist()


def _repaired(conv: int | None, block: _Block) -> dict:
    """The result for a conversation of one block."""
    codes = bytes(block.codes)
    edits, last, cost = search(codes)
    lines, _ = applied(codes, edits + CLOSING_EDITS[last], START, block.kept)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return {
        "conv_id": conv, "gaps": _gaps(block.turns), **block.stats, "cost": cost,
        "audit": edits + CLOSING_EDITS[last], "repaired_sha256": digest,
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a task to results, or to blocks where a conversation may go on elsewhere."""

    def rows() -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 40
        conv, block, alone, first = None, None, True, True

        def part() -> dict:
            return {
                "conv_id": conv, "block": number, "codes": bytes(block.codes), "roles": [r for r, _ in block.kept],
                "texts": [t for _, t in block.kept], "costs": block_costs(block.codes).ravel().tolist(),
                "turns": block.turns, "first_kind": block.first, "last_kind": block.last, **block.stats,
            }

        for row in _read(batches):
            if block is None or row["conv_id"] != conv:
                if block is not None:
                    # the first conversation of a task may have begun in the one before it
                    yield _repaired(conv, block) if alone and not first else part()
                    number, first = number + 1, False
                conv, block, alone = row["conv_id"], _Block(), True
            if row["gone"]:
                continue
            for copy in range(row["n"]):
                if len(block.codes) >= BLOCK_ROWS or block.bytes > BLOCK_BYTES:
                    yield part()
                    number, block, alone = number + 1, _Block(), False
                block.add(row, row["seen"] or copy > 0)
        if block is not None:
            yield part()

    yield from _batches(rows(), _BLOCK)


def _ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of conversations from the last to the first: the least cost behind each."""
    fields = {"conv_id": pa.int64(), "block": pa.int64(), "codes": pa.binary(), "ahead": pa.list_(pa.int64()), "first": pa.bool_()}

    def rows() -> Iterator[dict]:
        held, ahead = None, None
        for row in _read(batches):
            same = held is not None and held["conv_id"] == row["conv_id"]
            if held is not None:
                yield held | {"first": not same}
            if not same:
                ahead = np.array(CLOSING)
            held = {"conv_id": row["conv_id"], "block": row["block"], "codes": row["codes"], "ahead": ahead.tolist()}
            ahead = (np.array(row["costs"]).reshape(4, 4) + ahead).min(1)
        if held is not None:
            yield held | {"first": True}

    yield from _batches(rows(), fields)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each block for every last role that it may begin with."""
    fields = {"conv_id": pa.int64(), "block": pa.int64(), "edits": pa.list_(pa.string()), "ends": pa.list_(pa.int64()), "total": pa.int64()}

    def rows() -> Iterator[dict]:
        for row in _read(batches):
            codes, ahead = row["codes"], tuple(row["ahead"])
            total = (block_costs(codes) + np.array(ahead)).min(1)
            found = [("", p, 0) for p in range(4)]
            for p in (START,) if row["first"] else range(4):
                found[p] = search(codes, p, ahead, int(total[p]))
            yield {
                "conv_id": row["conv_id"], "block": row["block"], "edits": [f[0] for f in found],
                "ends": [f[1] for f in found], "total": int(total[START]) if row["first"] else None,
            }

    yield from _batches(rows(), fields)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, each as its rows and then its edits, to the results of their conversations."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    fields = {c: _BLOCK[c] for c in names}

    def rows() -> Iterator[dict]:
        out = digest = content = None
        audit: list[str] = []
        last, turns, kind, empty = START, [], None, True

        def put(lines: list[str]) -> None:
            nonlocal empty
            for line in lines:
                digest.update((line if empty else "\n" + line).encode())
                empty = False

        def closed() -> dict:
            put(applied(b"", CLOSING_EDITS[last], last, [])[0])
            audit.append(CLOSING_EDITS[last])
            return out | {"gaps": _gaps(turns), "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        for row in _read(batches):
            if row["edits"] is None:
                if out is None or row["conv_id"] != out["conv_id"]:
                    if out is not None:
                        yield closed()
                    out = {"conv_id": row["conv_id"], **dict.fromkeys(STATS, 0), "cost": 0}
                    digest, audit, last, turns, kind, empty = hashlib.sha256(), [], START, [], None, True
                content = row
                for k in STATS:
                    out[k] += row[k]
                if kind is not None and row["first_kind"] is not None and (kind, row["first_kind"]) not in _LEGAL:
                    out["illegal"] += 1
                kind = kind if row["last_kind"] is None else row["last_kind"]
                own = row["turns"]
                if own:
                    turns = [turns[0], own[1], turns[2] + own[2] - (turns[1] == own[0])] if turns else list(own)
            else:
                if row["total"] is not None:
                    out["cost"] = row["total"]
                kept = list(zip(content["roles"], content["texts"], strict=True))
                lines, end = applied(content["codes"], row["edits"][last], last, kept)
                put(lines)
                audit.append(row["edits"][last])
                last = row["ends"][last] if content["codes"] else end
        if out is not None:
            yield closed()

    yield from _batches(rows(), fields)


def repaired(table: DataFrame) -> DataFrame:
    """Damages the conversations of ``table`` (conv_id, turn, role, text) and repairs them.

    Per conversation, also one without rows after damage (zeros, an empty audit, the digest of the
    empty string): gaps, counts of faults and of illegal neighbours, the cost and audit of the
    cheapest repair, and the digest of what is repaired. A null conv_id is a conversation of its own;
    null turns come first, and rows of one turn are in order of role and text. A null role or text is one
    space. A role whose first character is not s, u or a, or that is empty, cannot be kept as it is. Equal
    rows are counted before they are dealt, so repeats of any number are one row in the shuffle. An
    empty table gives an empty result; other columns are not read. A very long text is in memory as
    a whole, and gaps beyond the longs are the largest long.
    """
    keys = ["conv_id", "turn", "role", "text"]
    rows = marked(land(damaged(table.select(*keys)), "damaged"))
    (prefix,) = free_names(rows, "prefix")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = rows.withColumn(prefix, F.left("text", F.lit(PREFIX))).repartitionByRange(*order, F.col(prefix))
    blocks = land(dealt.sortWithinPartitions(*order, F.col("text")).mapInArrow(_blocks, BLOCK_SCHEMA), "conversation-blocks")
    done = blocks.where(F.col("block").isNull()).select(*[c.split()[0] for c in RESULT.split(", ")])
    parts = blocks.where(F.col("block").isNotNull())
    backwards = [F.col("conv_id").asc_nulls_first(), F.col("block").desc()]
    ahead = parts.select("conv_id", "block", "codes", "costs").repartition("conv_id").sortWithinPartitions(*backwards)
    ahead = ahead.mapInArrow(_ahead, "conv_id long, block long, codes binary, ahead array<long>, first boolean")
    searched = ahead.repartition("block").mapInArrow(
        _searched, "conv_id long, block long, edits array<string>, ends array<long>, total long"
    )
    own = parts.select("conv_id", "block", "codes", "roles", "texts", "turns", "first_kind", "last_kind", *STATS)
    both = own.unionByName(searched, allowMissingColumns=True).repartition("conv_id")
    forwards = [F.col("conv_id").asc_nulls_first(), F.col("block"), F.col("edits").isNotNull()]
    return done.unionByName(both.sortWithinPartitions(*forwards).mapInArrow(_joined, RESULT))

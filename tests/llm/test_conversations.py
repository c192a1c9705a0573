import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from tidequote.llm import conversations as C

COLUMNS = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    """Rows after damage, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else "".join(c for c in text if c not in ".!?") if hit == 2 else text
        own += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def plain(conv, rows):
    """Row by row, the cheapest and then ASCII-least way to every last role."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
    blank = duplicate = truncated = illegal = 0
    seen, marked = set(), []
    for turn, role, text in rows:
        signs = [c for c in text if c not in " \t\n\v\f\r"]
        fault = "blank" if not signs else "dup" if (role, text) in seen else "cut" if signs[-1] not in ".!?" else ""
        seen.add((role, text))
        blank, duplicate, truncated = blank + (fault == "blank"), duplicate + (fault == "dup"), truncated + (fault == "cut")
        marked.append((role, text, fault))
    for x, y in itertools.pairwise(marked):
        illegal += x[0][:1] + y[0][:1] not in ("su", "ua", "au")
    ways = {"": (0, "", ())}

    def grown(ways):
        out = dict(ways)
        for _ in range(3):
            for last, (cost, audit, lines) in list(out.items()):
                then = NEXT[last]
                new = (cost + 2, audit + "I", (*lines, f"{ROLE[then]}:"))
                if then not in out or new < out[then]:
                    out[then] = new
        return out

    for role, text, fault in marked:
        new = {}

        def put(last, way):
            if last not in new or way < new[last]:
                new[last] = way

        for last, (cost, audit, lines) in grown(ways).items():
            put(last, (cost + 3, audit + "D", lines))
            if fault in ("blank", "dup"):
                continue
            extra, then = int(fault == "cut"), NEXT[last]
            if role[:1] == then or (role[:1] == "s" and not last):
                put(role[:1], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            put(then, (cost + extra + 2, audit + "R", (*lines, f"{ROLE[then]}:{text}")))
        ways = new
    cost, audit, lines = min(way for last, way in grown(ways).items() if last in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return conv, gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def check(spark, table):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.select("conv_id", "turn", "role", "text").collect()]
    expected = sorted((plain(c, own) for c, own in damage(rows).items()), key=str)
    got = C.repaired(table)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    return expected


def some_rows(seed, n, convs):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "unit"]
    texts = ["Hi.", "Why?", "so", " \t", None, "Fine!\n", "Hi.", "é漢.", "x" * 70 + "1.", "x" * 70 + "2", *(f"t{i}." for i in range(9))]
    return [(rng.choice(convs), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_search_finds_the_first_of_the_cheapest():
    rng = random.Random(5)
    for _ in range(120):
        codes = bytes(rng.choice([1, 2, 3, 0, 2 | 8, 3 | 8, 2 | 4, 3 | 4, 1 | 8]) for _ in range(rng.randrange(5)))
        marked = [({0: "x", 1: "s", 2: "u", 3: "a"}[c & 3], "." if not c & 8 else "z", c & 4) for c in codes]
        best = None
        for size in range(len(codes) + 5):
            for edits in itertools.product("DIKR", repeat=size):
                if sum(e != "I" for e in edits) != len(codes):
                    continue
                last, cost, i, right = "", 0, 0, True
                for e in edits:
                    if e == "I":
                        last, cost = NEXT[last], cost + 2
                        continue
                    role, text, must_go = marked[i]
                    i += 1
                    if e == "D":
                        cost += 3
                        continue
                    if must_go or (e == "K" and not (role == NEXT[last] or (role == "s" and not last))):
                        right = False
                        break
                    cost += (e == "R") * 2 + (text == "z")
                    last = role if e == "K" else NEXT[last]
                if right and last in ("", "a"):
                    best = min(best or (99, ""), (cost, "".join(edits)))
        edits, last, cost = C.search(codes)
        assert (cost, edits + C.CLOSING_EDITS[last]) == best, codes


@pytest.mark.parametrize("rows", [1, 3, 64])
def test_blocks_and_tasks_do_not_show(spark, monkeypatch, rows):
    monkeypatch.setattr(C, "BLOCK_ROWS", rows)
    table = spark.createDataFrame(some_rows(rows, 900, [1, 1, 1, 1, 2, 3, None, *range(10, 40)]), COLUMNS)
    check(spark, table)


def test_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"t{t}.", "same.", "cut"])) for t in range(1500)]
    got = check(spark, spark.createDataFrame(rows, COLUMNS).repartition(5))
    assert len(got) == 1 and len(got[0][7]) > 1000


def test_many_equal_rows_of_a_turn(spark):
    rows = [(1, None, "user", "Hi.")] * 300 + [(1, 4, "assistant", "So.")] * 200 + [(2, 0, "user", "Hi.")]
    check(spark, spark.createDataFrame(rows, COLUMNS))


def test_whole_table(spark, sf_dir):
    check(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def test_everything_dropped_and_clashing_names(spark):
    dropped = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    rows = [(i, 0, "user", "Hi.") for i in dropped] + [(None, None, None, None), (500, 1, "user", "Long. " * 300_000)]
    table = spark.createDataFrame(rows, COLUMNS)
    for name in ("block", "codes", "kind", "blank", "seen", "n", "prefix", "damage", "gone", "cost"):
        table = table.selectExpr("*", f"'other' as `{name}`")
    got = {r[0]: r[1:] for r in check(spark, table)}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[dropped[0]] == (0, 0, 0, 0, 0, 0, "", empty)


def test_nothing(spark):
    assert C.repaired(spark.createDataFrame([], COLUMNS)).collect() == []


def test_block_costs_are_those_of_single_searches():
    rng = np.random.default_rng(2)
    for _ in range(30):
        codes = bytes(rng.integers(0, 16, 8).astype(np.uint8))
        costs = C.block_costs(codes)
        for p in range(4):
            for q in range(4):
                ahead = tuple(0 if k == q else 1000 for k in range(4))
                cost = C.search(codes, p, ahead)[2]
                assert min(cost, 1000) == min(int(costs[p, q]), 1000) or costs[p, q] >= C.FAR

"""Golden inputs and outputs, and a plain replay of the quote rules to compare with."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tidequote.schema import L3_SCHEMA

SEQ = 1627942268920653000
START = datetime(2021, 8, 3, 1, 0, 0)
MESSAGE = "seq_num long, time timestamp, action string, order_id long, side string, price double, qty int"

# The golden Level-3 sample, (seq_num, order, side, price, qty, time) of adds in
# file order. The second row comes before the first in seq_num order.
SAMPLE = [
    (1627942268920653172, 7456389231055194163, "BUY", 218.0, 300, "2021-08-02 22:11:21.94404"),
    (1627942268920653171, 7455201758497478055, "BUY", 228.0, 50, "2021-08-02 22:11:21.94404"),
    (1627942268920653173, 7457972527797789251, "BUY", 228.2, 300, "2021-08-03 01:00:01.107428"),
    (1627942268920653174, 7457972527797789252, "SELL", 230.2, 300, "2021-08-03 01:00:01.107502"),
    (1627942268920653175, 7457972527797789518, "BUY", 228.4, 300, "2021-08-03 01:00:01.326608"),
    (1627942268920653176, 7457972527797790256, "BUY", 229.13, 1000, "2021-08-03 01:00:03.22333"),
    (1627942268920653177, 7457972527797790258, "SELL", 229.35, 1000, "2021-08-03 01:00:03.225576"),
    (1627942268920653178, 7457972527797790267, "BUY", 227.07, 5000, "2021-08-03 01:00:03.256427"),
    (1627942268920653179, 7457972527797790268, "SELL", 231.42, 5000, "2021-08-03 01:00:03.256497"),
]

# seq_num less SEQ -> (bid, bid size, ask, ask size)
SAMPLE_QUOTES = {
    "best_quote": {
        174: (228.2, 300, 230.2, 300),
        175: (228.4, 300, 230.2, 300),
        176: (229.13, 1000, 230.2, 300),
        177: (229.13, 1000, 229.35, 1000),
        178: (229.13, 1000, 229.35, 1000),
        179: (229.13, 1000, 229.35, 1000),
    },
    "event_quote": {
        174: (228.2, 300, 230.2, 300),
        175: (228.4, 300, 230.2, 300),
        176: (229.13, 1000, 230.2, 300),
        177: (229.13, 1000, 229.35, 1000),
        178: (227.07, 5000, 229.35, 1000),
        179: (229.13, 1000, 231.42, 5000),
    },
    "as_coded": {
        175: (228.4, 300, 230.2, 300),
        176: (229.13, 1000, 230.2, 300),
        178: (227.07, 5000, 230.2, 300),
    },
}

EDGES = [
    (1, "add", 1, "BUY", 100.0, 10),
    (2, "add", 2, "SELL", 105.0, 10),
    (3, "add", 3, "BUY", 101.0, 5),
    (4, "add", 4, "BUY", 101.0, 7),
    (5, "update", 2, "SELL", 104.0, 8),
    (6, "delete", 3, "BUY", None, None),
    (7, "trade", 4, "BUY", 101.0, 7),
    (8, "add", 5, "SELL", 103.0, 1),
    (9, "delete", 5, "SELL", None, None),
    (10, "other", None, None, None, None),
    (11, "add", 6, None, 99.0, 1),
    (12, "update", 2, "SELL", 106.0, 8),
    (13, "trade", 1, "BUY", 100.0, 4),
]

_CALM = (101.0, 5, 103.0, 1)
EDGE_QUOTES = {
    "best_quote": {
        2: (100.0, 10, 105.0, 10),
        3: (101.0, 5, 105.0, 10),
        4: (101.0, 5, 105.0, 10),
        5: (101.0, 5, 104.0, 8),
        6: (101.0, 5, 104.0, 8),
        7: (101.0, 5, 104.0, 8),
        **dict.fromkeys(range(8, 14), _CALM),
    },
    "event_quote": {
        2: (100.0, 10, 105.0, 10),
        3: (101.0, 5, 105.0, 10),
        4: (101.0, 7, 105.0, 10),
        5: (101.0, 5, 104.0, 8),
        6: (101.0, 5, 104.0, 8),
        7: (101.0, 5, 104.0, 8),
        **dict.fromkeys(range(8, 12), _CALM),
        12: (101.0, 5, 106.0, 8),
        13: (101.0, 5, 106.0, 8),
    },
    "as_coded": {3: (101.0, 5, 105.0, 10), 4: (101.0, 7, 105.0, 10)},
    "full_book": {
        2: (100.0, 10, 105.0, 10),
        3: (101.0, 5, 105.0, 10),
        4: (101.0, 12, 105.0, 10),
        5: (101.0, 12, 104.0, 8),
        6: (101.0, 7, 104.0, 8),
        7: (100.0, 10, 104.0, 8),
        8: (100.0, 10, 103.0, 1),
        9: (100.0, 10, 104.0, 8),
        10: (100.0, 10, 104.0, 8),
        11: (100.0, 10, 104.0, 8),
        12: (100.0, 10, 106.0, 8),
        13: (100.0, 6, 106.0, 8),
    },
}


def wide_row(seq, action, order_id, side, price, qty, time) -> tuple:
    """A message in the sixteen-column form."""
    values = {"seq_num": seq, "time": time}
    if action != "other":
        own = {"order_id": order_id, "side": side, "price": price, "qty": qty}
        values |= {f"{action}_{k}": v for k, v in own.items()}
    return tuple(values.get(name) for name in L3_SCHEMA.names)


def sample_l3(spark: SparkSession):
    rows = [
        wide_row(s, "add", o, side, p, q, datetime.fromisoformat(t))
        for s, o, side, p, q, t in SAMPLE
    ]
    return spark.createDataFrame(rows, L3_SCHEMA)


def sample_csv(path) -> str:
    """The sample as the feed delivers it."""
    lines = [",".join(L3_SCHEMA.names)]
    for s, o, side, p, q, t in SAMPLE:
        price = f"{p:g}" if p == int(p) else str(p)
        lines.append(f"{s},{o},{side},{price},{q}{',' * 11}{t} UTC")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def edge_l3(spark: SparkSession):
    rows = [wide_row(*m, START + timedelta(seconds=m[0])) for m in EDGES]
    return spark.createDataFrame(rows, L3_SCHEMA)


def messages_frame(spark: SparkSession, messages, key: str | None = None):
    """``messages`` as (seq, action, order, side, price, qty[, key]) in the one-shape form."""
    schema = MESSAGE + (f", {key} long" if key else "")
    rows = [
        (m[0], START if m[0] is None else START + timedelta(milliseconds=m[0]), *m[1:])
        for m in messages
    ]
    return spark.createDataFrame(rows, schema)


def quotes_by_seq(l1, base: int = 0) -> dict:
    return {
        r["seq_num"] - base: (r["bid_price"], r["bid_size"], r["ask_price"], r["ask_size"])
        for r in l1.collect()
    }


def replay(messages, mode: str) -> dict:
    """Row-by-row quotes of messages with unique, ascending seq numbers."""
    bid = ask = last = None
    orders, dead, out = {}, set(), {}
    for seq, action, order, side, price, qty in messages:
        quotes = action in ("add", "update") and side in ("BUY", "SELL") and price is not None
        if quotes and side == "BUY" and (bid is None or price > bid[0]):
            bid = (price, qty)
        if quotes and side == "SELL" and (ask is None or price < ask[0]):
            ask = (price, qty)
        if quotes:
            last = (side, (price, qty))
        if order is not None and order not in dead:
            if action in ("add", "update"):
                orders[order] = [side, price, qty]
            elif action == "trade" and order in orders:
                orders[order][2] = max(0, orders[order][2] - qty)
            elif action == "delete":
                dead.add(order)
                orders.pop(order, None)
        shown = {"BUY": bid, "SELL": ask}
        if mode == "event_quote" and last:
            shown[last[0]] = last[1]
        if mode == "full_book":
            for s, best in (("BUY", max), ("SELL", min)):
                live = [o for o in orders.values() if o[0] == s and o[1] is not None and o[2] > 0]
                top = best((o[1] for o in live), default=None)
                shown[s] = live and (top, sum(o[2] for o in live if o[1] == top)) or None
        b, a = shown["BUY"], shown["SELL"]
        if b and a and b[0] > 0 and a[0] > 0:
            out[seq] = (*b, *a)
    return out


def random_messages(rng, count: int, gaps: int = 1, orders: int = 12) -> list:
    """Messages over few orders and prices, so that ties, refills and emptied sides occur."""
    out, seq = [], 0
    for _ in range(count):
        seq += rng.randint(1, gaps)
        action = rng.choice(["add", "add", "update", "delete", "trade", "trade", "other"])
        order = rng.choice([None, *range(orders)]) if action != "add" else rng.randrange(orders * 3)
        side = rng.choice(["BUY", "SELL", "BUY", "SELL", None])
        price = float(rng.choice([95, 96, 97, 98, 99, 100, 101, 102]))
        if action == "other":
            out.append((seq, action, None, None, None, None))
        elif action == "delete":
            out.append((seq, action, order, side, None, None))
        else:
            out.append((seq, action, order, side, price, rng.randint(1, 9)))
    return out

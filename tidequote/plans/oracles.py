"""The registered queries as plain SQL, with one unpartitioned window where Spark scans ranges."""

from __future__ import annotations

_L3 = """
tagged as (
  select event_id, ts, user_id, value,
    case event_type when 'click' then 'add' when 'view' then 'add' when 'signup' then 'update'
      when 'error' then 'delete' when 'purchase' then 'trade' end as kind,
    max(case when event_type in ('click', 'view') then event_id end)
      over (partition by user_id order by event_id) as linked
  from events),
l3 as (
  select t.event_id as seq_num, t.ts as time, t.user_id % 8 as instrument,
    case when linked is null then 'other' else kind end as action,
    linked as order_id,
    case a.event_type when 'click' then 'BUY' when 'view' then 'SELL' end as side,
    case when kind <> 'delete' and linked is not null then
      case a.event_type when 'click' then 500 - floor(t.value) else 500 + floor(t.value) end
    end as price,
    case when kind <> 'delete' and linked is not null then
      cast(floor(t.value * 10) as integer) + 1 end as qty
  from tagged t left join events a on a.event_id = t.linked)
"""

_WIDE = """
  select seq_num,
    case action when 'add' then order_id end as add_order_id,
    case action when 'add' then side end as add_side,
    case action when 'add' then price end as add_price,
    case action when 'add' then qty end as add_qty,
    case action when 'update' then order_id end as update_order_id,
    case action when 'update' then side end as update_side,
    case action when 'update' then price end as update_price,
    case action when 'update' then qty end as update_qty,
    case action when 'delete' then order_id end as delete_order_id,
    case action when 'delete' then side end as delete_side,
    case action when 'trade' then order_id end as trade_order_id,
    case action when 'trade' then side end as trade_side,
    case action when 'trade' then price end as trade_price,
    case action when 'trade' then qty end as trade_qty,
    time
  from l3
"""

_BATCH = "seq_num * 3 // (select max(event_id) + 1 from events)"


def _lives(minutes: int, *keys: str) -> str:
    return _l3_query(
        f"""select {"".join(f"a.{k}, " for k in keys)}a.order_id, a.side, a.price, a.qty, a.time as opened, a.seq_num as opened_seq,
          e.action as ended_by, e.time as ended, e.seq_num as ended_seq, e.qty as ended_qty
        from l3 a left join l3 e on e.order_id = a.order_id and e.action in ('delete', 'trade')
          and e.time between a.time and a.time + interval {minutes} minutes and e.seq_num > a.seq_num
          {"".join(f"and e.{k} is not distinct from a.{k}" for k in keys)}
        where a.action = 'add'"""
    )


def _tied(mode: str) -> str:
    """Running values over peers; the first message at a price is that of the least order value,
    nulls before all, and of its peers the one of the larger size."""
    ctes = _quoted(mode).replace(
        "order by seq_num rows between unbounded preceding and current row",
        "order by seq_num nulls first range between unbounded preceding and current row",
    )
    for first in ("'s': -seq_num, 'q': ", "'s': seq_num, 'q': "):
        sign = "-" if "-" in first else ""
        more = "" if sign else "'m': -{q}, "
        for q in ("qty", "sz"):
            ctes = ctes.replace(
                f"{first}{q}", f"'s': {sign}coalesce(seq_num, -1), {more.format(q=q)}'q': {q}"
            )
    feed = _L3.replace("l3 as (", "l3_all as (") + (
        ", l3 as (select * replace (case when instrument <> 7 then seq_num // 4 end as seq_num) from l3_all)"
    )
    return f"with {feed}, {ctes} select * from l1 where bid_price > 0 and ask_price > 0"


def _skewed(ctes: str) -> str:
    feed = _L3.replace("l3 as (", "l3_all as (") + (
        ", l3 as (select * replace (greatest(instrument - 5, 0) as instrument) from l3_all)"
    )
    return f"with {feed}, {ctes} select * from l1 where bid_price > 0 and ask_price > 0"


def _quoted(mode: str, keys: str = "") -> str:
    """CTEs ending in ``l1``; ``keys`` restart the running values."""
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    if mode == "as_coded":
        return f"""
adds as (
  select *, coalesce(action = 'add' and side = 'BUY', false) as buy,
    case action when 'add' then price else 0 end as px,
    case action when 'add' then qty else 0 end as sz from l3),
stored as (
  select *,
    min(case when buy then {{'p': px, 's': seq_num, 'q': sz}} end) over w as low,
    max(case when not buy then {{'p': px, 's': -seq_num, 'q': sz}} end) over w as high
  from adds
  window w as ({part} order by seq_num rows between unbounded preceding and current row)),
l1 as (
  select {lead}time,
    case when buy then px when low.p < 0 then low.p else 0 end as bid_price,
    case when not buy then px when high.p > 0 then high.p else 0 end as ask_price,
    case when buy then sz when low.p < 0 then low.q else 0 end as bid_size,
    case when not buy then sz when high.p > 0 then high.q else 0 end as ask_size,
    seq_num
  from stored)
"""
    own = {c: f"best.{c}" for c in ("bid.p", "bid.q", "ask.p", "ask.q")}
    if mode == "event_quote":
        for side, s in (("bid", "BUY"), ("ask", "SELL")):
            for f in ("p", "q"):
                own[f"{side}.{f}"] = f"case when last.side = '{s}' then last.{f} else {side}.{f} end"
    else:
        own = {k: k for k in own}
    return f"""
quoting as (
  select *, action in ('add', 'update') and side is not null and price is not null as quotes from l3),
running as (
  select *,
    max(case when quotes and side = 'BUY' then {{'p': price, 's': -seq_num, 'q': qty}} end)
      over w as bid,
    min(case when quotes and side = 'SELL' then {{'p': price, 's': seq_num, 'q': qty}} end)
      over w as ask,
    last_value(case when quotes then {{'side': side, 'p': price, 'q': qty}} end ignore nulls)
      over w as last
  from quoting
  window w as ({part} order by seq_num rows between unbounded preceding and current row)),
l1 as (
  select {lead}time, {own["bid.p"]} as bid_price, {own["ask.p"]} as ask_price,
    {own["bid.q"]} as bid_size, {own["ask.q"]} as ask_size, seq_num
  from running)
"""


def _book(keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    same = f"and v.{keys} = m.{keys}" if keys else ""
    return f"""
traded as (
  select *, coalesce(sum(case action when 'trade' then qty end) over w, 0) as sold,
    max(case action when 'delete' then 1 end) over w as gone
  from l3 where action <> 'other'
  window w as (partition by {lead}order_id order by seq_num)),
opened as (
  select *, last_value(case when action in ('add', 'update')
      then {{'sold': sold, 'side': side, 'price': price, 'qty': qty}} end ignore nulls)
    over (partition by {lead}order_id order by seq_num
      rows between unbounded preceding and current row) as o
  from traded),
remaining as (
  select {lead}order_id, seq_num, o.side as side, o.price as price,
    case when gone is null and o is not null then greatest(0, o.qty - (sold - o.sold)) else 0 end as n
  from opened),
before as (
  select *, lag(side) over w as side0, lag(price) over w as price0, lag(n) over w as n0
  from remaining window w as (partition by {lead}order_id order by seq_num)),
moves as (
  select {lead}seq_num, side, price, sum(d) as d from (
    select {lead}seq_num, side, price, n as d from before where n > 0
    union all
    select {lead}seq_num, side0, price0, -n0 from before where n0 > 0)
  group by all),
levels as (
  select {lead}side, price, seq_num as s,
    sum(d) over w as size, lead(seq_num, 1, 9223372036854775807) over w as e
  from moves window w as (partition by {lead}side, price order by seq_num)),
l1 as (
  select {lead.replace(keys, f"m.{keys}") if keys else ""}m.time,
    max(case v.side when 'BUY' then v.price end) as bid_price,
    min(case v.side when 'SELL' then v.price end) as ask_price,
    cast(max(case v.side when 'BUY' then {{'p': v.price, 'n': size}} end).n as bigint) as bid_size,
    cast(min(case v.side when 'SELL' then {{'p': v.price, 'n': size}} end).n as bigint) as ask_size,
    m.seq_num
  from l3 m join levels v on v.size > 0 and v.s <= m.seq_num and m.seq_num < v.e {same}
  group by all)
"""


def _l3_query(select: str, *ctes: str) -> str:
    return "with " + ",".join([_L3, *ctes]) + select


def _two_sided(ctes: str, extra: str = "") -> str:
    return _l3_query(f"select *{extra} from l1 where bid_price > 0 and ask_price > 0", ctes)


def _windows(
    width: int, slide: int, keys: str = "", where: str = "true", having: str = "true"
) -> str:
    """Windows of ``width`` minutes every ``slide`` minutes."""
    lead = f"{keys}, " if keys else ""
    return _l3_query(
        f"""
select {lead}window_start, window_start + interval {width} minutes as window_end,
  max(case when quotes and side = 'BUY' then price end) as bid_price,
  min(case when quotes and side = 'SELL' then price end) as ask_price,
  max(case when quotes and side = 'BUY' then {{'p': price, 's': -seq_num, 'q': qty}} end).q
    as bid_size,
  min(case when quotes and side = 'SELL' then {{'p': price, 's': seq_num, 'q': qty}} end).q
    as ask_size,
  count(*) as n
from (
  select *, action in ('add', 'update') and side is not null as quotes,
    time_bucket(interval {slide} minutes, time) - back * interval {slide} minutes as window_start
  from l3, unnest(generate_series(0, {width // slide - 1})) as b(back))
where {where}
group by all having {having}
"""
    )


_CLOSED = "window_start + interval 60 minutes <= (select max(time) from l3) - interval 30 minutes"


# The feed whose trades are of one to three pieces.
_PARTIAL = _L3.replace("l3 as (", "l3_whole as (") + """,
l3 as (select * replace (case when action = 'trade' then 1 + seq_num % 3 else qty end as qty) from l3_whole)
"""


def _partial(ctes: str, extra: str = "") -> str:
    return f"with {_PARTIAL}, {ctes} select *{extra} from l1 where bid_price > 0 and ask_price > 0"


def _depth(levels: int) -> str:
    """The best levels of both sides after each message."""
    book = _book()
    book = book[: book.rindex("l1 as (")]
    columns = ", ".join(
        f"max(case when side = '{side}' and r = {i} then price end) as {name}_price_{i}, "
        f"cast(max(case when side = '{side}' and r = {i} then size end) as bigint) as {name}_size_{i}"
        for i in range(1, levels + 1)
        for name, side in (("bid", "BUY"), ("ask", "SELL"))
    )
    return f"""with {_PARTIAL}, {book} shown as (
  select m.seq_num, m.time, v.side, v.price, v.size,
    row_number() over (partition by m.seq_num, v.side order by case v.side when 'BUY' then -v.price else v.price end) as r
  from l3 m join levels v on v.size > 0 and v.s <= m.seq_num and m.seq_num < v.e)
select seq_num, time, {columns} from shown where r <= {levels} group by seq_num, time
having bid_price_1 > 0 and ask_price_1 > 0
"""


_SKEW = _L3.replace("l3 as (", "l3_all as (") + """,
l3 as (select * replace (greatest(instrument - 5, 0) as instrument) from l3_all)
"""


def _asof(feed: str, within: str = "true") -> str:
    """Trades with the last quote of their instrument up to their time."""
    found = {c: f"case when {within} then q.{c} end as quote_{c}" for c in ("time", "bid_price", "ask_price", "bid_size", "ask_size", "seq_num")}
    return f"""with {feed}, {_quoted("best_quote", "instrument")},
q as (
  select * from l1 where bid_price > 0 and ask_price > 0
  qualify row_number() over (partition by instrument, time order by seq_num desc) = 1)
select t.instrument, t.seq_num, t.time, t.price, t.qty, {", ".join(found.values())}
from (select * from l3 where action = 'trade') t
asof left join q on t.instrument = q.instrument and t.time >= q.time
"""


_ASOF_DELETES = _l3_query(
    """
select d.seq_num, d.price, d.qty,
  case when d.seq_num - t.seq_num <= 20 then t.seq_num end as trade_seq_num,
  case when d.seq_num - t.seq_num <= 20 then t.price end as trade_price,
  case when d.seq_num - t.seq_num <= 20 then t.qty end as trade_qty
from (select * from l3 where action = 'delete') d
asof left join (select * from l3 where action = 'trade') t on d.seq_num > t.seq_num
"""
)


def _sessions(minutes: int, keys: str = "", having: str = "true", feed: str = _L3) -> str:
    lead, part = (f"{keys}, ", f"partition by {keys}") if keys else ("", "")
    return f"""with {feed},
gapped as (
  select *, action in ('add', 'update') and side is not null and price is not null as quotes,
    case when time - lag(time) over (w) <= interval {minutes} minutes then 0 else 1 end as begins
  from l3 window w as ({part} order by time)),
numbered as (select *, sum(begins) over ({part} order by time range between unbounded preceding and current row) as s from gapped)
select {lead}min(time) as window_start, max(time) + interval {minutes} minutes as window_end,
  max(case when quotes and side = 'BUY' then price end) as bid_price,
  min(case when quotes and side = 'SELL' then price end) as ask_price,
  max(case when quotes and side = 'BUY' then {{'p': price, 's': -seq_num, 'q': qty}} end).q as bid_size,
  min(case when quotes and side = 'SELL' then {{'p': price, 's': seq_num, 'q': qty}} end).q as ask_size,
  count(*) as n
from numbered group by {lead}s having {having}
"""


def _weighted(minutes: int, keys: str = "") -> str:
    lead, part = (f"{keys}, ", f"partition by {keys}") if keys else ("", "")
    width = minutes * 60_000_000
    return _l3_query(
        f"""
select {lead}make_timestamp(k * {width}) as window_start, make_timestamp((k + 1) * {width}) as window_end,
  sum(bid_price * part) / sum(part) as bid_price, sum(ask_price * part) / sum(part) as ask_price,
  sum((ask_price - bid_price) * part) / sum(part) as spread, cast(sum(part) as bigint) as quoted_micros
from (
  select *, least(till, (k + 1) * {width}) - greatest(since, k * {width}) as part
  from (select *, unnest(generate_series(since // {width}, (till - 1) // {width})) as k from lives where till > since))
group by {lead}k
""",
        _quoted("event_quote", keys),
        f"""
timed as (
  select *, epoch_us(time) as since from l1 where bid_price > 0 and ask_price > 0
  qualify row_number() over (partition by {lead}time order by seq_num desc) = 1),
lives as (
  select *, coalesce(lead(since) over ({part} order by since), (select max(since) from timed)) as till from timed)
""",
    )


def _consolidated(skewed: bool = False) -> str:
    """The best of all instruments' latest quotes, instrument by instrument."""
    feed = _PARTIAL
    if skewed:
        feed = feed.replace("l3 as (select *", "l3_part as (select *") + (
            ", l3 as (select * replace (greatest(instrument - 5, 0) as instrument) from l3_part)"
        )
    def latest(k: int) -> str:
        return f"last_value(case instrument when {k} then {{'b': bid_price, 'bs': bid_size, 'a': ask_price, 'as': ask_size}} end ignore nulls) over w"

    quotes = "list_filter([" + ", ".join(latest(k) for k in range(8)) + "], lambda x: x is not null)"
    return f"""with {feed}, {_quoted("event_quote", "instrument")},
known as (
  select time, seq_num, {quotes} as q from l1 where bid_price > 0 and ask_price > 0
  window w as (order by seq_num rows between unbounded preceding and current row)),
best as (
  select *, list_max(list_transform(q, lambda x: x.b)) as bid_price, list_min(list_transform(q, lambda x: x.a)) as ask_price from known)
select time, bid_price, ask_price,
  cast(list_sum(list_transform(q, lambda x: case when x.b = bid_price then x.bs else 0 end)) as bigint) as bid_size,
  cast(list_sum(list_transform(q, lambda x: case when x.a = ask_price then x.as else 0 end)) as bigint) as ask_size, seq_num
from best
"""


# What is wrong with each row of the broken file, in the order in which it is looked for.
_REASON = """
case when seq_num % 89 = 6 then 'number of fields'
  when seq_num % 89 = 1 then 'seq_num: not bigint'
  when seq_num % 89 = 3 then 'time: not timestamp'
  when seq_num % 89 = 2 then 'seq_num: missing'
  when seq_num % 89 = 5 and action <> 'delete' and action <> 'other' then 'several kinds of message'
  when seq_num % 89 = 4 and action = 'add' then 'side: unknown'
end
"""


def _bytes(text: str) -> str:
    return f"cast(coalesce(sum(strlen({text})), 0) as bigint)"


def _blocks(size: str) -> str:
    return f"greatest(1, {size} // 1048576 // 1)"


_LINE = "concat_ws(',', cast(time as varchar) || ' UTC', bid_price, ask_price, bid_size, ask_size, seq_num)"
_MESSAGE_LINE = """
concat(seq_num, ',', time, ' UTC,', action, ',', order_id, ',', side, ',', price, ',', qty)
"""


def oracle_sql() -> dict[str, str]:
    messages = _l3_query("select * exclude (instrument) from l3")
    wide = _l3_query(_WIDE)
    best, event, coded = (_quoted(m) for m in ("best_quote", "event_quote", "as_coded"))
    key = "instrument"
    batched = _L3.replace("l3 as (", "l3_all as (") + f", l3 as (select *, {_BATCH} as batch_id from l3_all)"

    def per_batch(mode: str, keys: str) -> str:
        ctes = _quoted(mode, keys)
        return f"with {batched}, {ctes} select * from l1 where bid_price > 0 and ask_price > 0"

    def with_batch(mode: str, keys: str = "") -> str:
        return _two_sided(_quoted(mode, keys), f", {_BATCH} as batch_id")

    return {
        "l3_messages": messages,
        "l3_action_counts": _l3_query(
            """select action, side, count(*) as messages, count(price) as priced,
            cast(sum(qty) as bigint) as total_qty from l3 group by all"""
        ),
        "l3_line_bytes": _l3_query(
            f"select seq_num, cast(strlen({_MESSAGE_LINE}) as integer) as line_bytes from l3"
        ),
        "l1_best_quote": _two_sided(best),
        "l1_event_quote": _two_sided(event),
        "l1_as_coded": _two_sided(coded),
        "l1_full_book": _two_sided(_book()),
        "l1_best_quote_keyed": _two_sided(_quoted("best_quote", key)),
        "l1_event_quote_keyed": _two_sided(_quoted("event_quote", key)),
        "l1_as_coded_keyed": _two_sided(_quoted("as_coded", key)),
        "l1_full_book_keyed": _two_sided(_book(key)),
        "l1_best_quote_split": _two_sided(best),
        "l1_full_book_split": _two_sided(_book()),
        "l1_best_quote_keyed_split": _skewed(_quoted("best_quote", key)),
        "l1_full_book_keyed_split": _skewed(_book(key)),
        "l1_best_quote_tied": _tied("best_quote"),
        "l1_as_coded_tied": _tied("as_coded"),
        "l1_full_book_partial": _partial(_book()),
        "l1_full_book_partial_keyed": _partial(_book(key)),
        "l1_depth_5": _depth(5),
        "l1_depth_5_split": _depth(5),
        "l1_full_book_replayed": _partial(_book()),
        "l3_replay_conflicts": _l3_query(
            """select seq_num, cast(qty as integer) + extra as add_qty, cast(2 - extra as bigint) as copies, cast(2 as bigint) as versions
            from l3, unnest([0, 1]) as u(extra) where seq_num % 10 = 0 and action = 'add'"""
        ),
        "asof_trade_quote": _asof(_L3),
        "asof_trade_quote_split": _asof(_SKEW, "t.time - q.time <= interval 10 minutes"),
        "asof_delete_trade": _ASOF_DELETES,
        "order_life": _lives(60),
        "order_life_keyed": _lives(10, key),
        "stream_order_life": _lives(60),
        "stream_order_life_keyed": _lives(10, key),
        "l1_consolidated": _consolidated(),
        "l1_consolidated_split": _consolidated(skewed=True),
        "l1_window_session": _sessions(5),
        "l1_window_session_keyed": _sessions(20, key),
        "l1_window_session_split": _sessions(5),
        "l1_window_time_weighted": _weighted(15),
        "l1_window_time_weighted_keyed": _weighted(60, key),
        "csv_quarantine": _l3_query(f"select coalesce({_REASON}, 'good') as reason, count(*) as rows from l3 group by all"),
        "csv_quarantine_good": _l3_query(
            f"""select * exclude (delete_order_id), case when seq_num % 89 = 5 then coalesce(delete_order_id, 1) else delete_order_id end
            as delete_order_id from ({_WIDE}) where seq_num in (select seq_num from l3 where {_REASON} is null)"""
        ),
        "l1_window_tumbling": _windows(60, 60),
        "l1_window_sliding": _windows(60, 15),
        "l1_window_sliding_keyed": _windows(
            360, 60, key, having="bid_price > 0 and ask_price > 0"
        ),
        "csv_scan_header": wide,
        "csv_scan_typed": wide,
        "csv_write_ordered": _two_sided(best),
        "csv_write_partitioned": _two_sided(best, ", cast(time as date) as trade_date"),
        "payload_bytes": f"select {_bytes('text')} as payload_bytes from documents",
        "output_partitions": _l3_query(
            f"""select {_bytes(_LINE)} as payload_bytes, {_blocks(_bytes(_LINE))} as partitions
            from l1 where bid_price > 0 and ask_price > 0""",
            best,
        ),
        "document_partitions": f"""select source, {_bytes('text')} as payload_bytes,
            {_blocks(_bytes('text'))} as partitions from documents group by source""",
        "repartition_rows": "select doc_id, cast(strlen(text) as integer) as text_bytes from documents",
        "stream_csv_scan": wide,
        "stream_json_scan": wide,
        "stream_parquet_scan": wide,
        "stream_orc_scan": wide,
        "stream_l1_per_batch": per_batch("best_quote", "batch_id"),
        "stream_l1_per_batch_keyed": per_batch("event_quote", f"{key}, batch_id"),
        "stream_l1_continuous": with_batch("best_quote"),
        "stream_l1_continuous_keyed": with_batch("event_quote", key),
        "stream_l1_continuous_as_coded": with_batch("as_coded"),
        "stream_l1_full_book": _partial(_book(), f", {_BATCH} as batch_id"),
        "stream_l1_full_book_keyed": _partial(_book(key), f", {_BATCH} as batch_id"),
        "stream_window_corrected": _windows(60, 15),
        "stream_window_corrected_keyed": _windows(60, 60, key),
        "stream_l1_window_session": _sessions(
            5, having="max(time) + interval 5 minutes < (select max(time) from l3) - interval 30 minutes"
        ),
        "stream_archive_scan": wide,
        "stream_job_window": _windows(60, 15, where=_CLOSED),
        "stream_l1_window": _windows(60, 60, where=_CLOSED),
        "stream_l1_window_sliding": _windows(60, 15, where=_CLOSED),
        "stream_late_rows": _windows(
            60, 60, where=_CLOSED.replace("from l3", "from l3 where action <> 'delete'")
            + " and action <> 'delete'"
        ),
        "job_batch": _two_sided(best),
        "job_batch_as_coded": _two_sided(coded),
        "job_batch_keyed": _two_sided(_quoted("event_quote", key)),
    }

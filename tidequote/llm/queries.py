"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidequote.llm import toxicity
from tidequote.llm.alignment import aligned
from tidequote.llm.conversations import repaired
from tidequote.llm.gridorder import near_vectors
from tidequote.llm.maxent import score_texts
from tidequote.llm.minhash import near_duplicates
from tidequote.llm.mixing import mix
from tidequote.llm.packing import pack
from tidequote.llm.quality import score_quality, train
from tidequote.llm.secret_scan import scan_secrets
from tidequote.llm.tokens import count_tokens
from tidequote.llm.treesearch import nearest
from tidequote.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, _table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op3_gridorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = archive_pages(_table(spark, sf_dir, "pages"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).drop("copies")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op9_treesearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(_table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def _edit(path: str, cost: str, letters: str, line: str = "''") -> str:
    """``path`` (nine digits of cost, edits, chr(1), lines) with more edits, and lines that begin with a newline."""
    cut = f"strpos({path}, chr(1))"
    return (
        f"lpad(cast(cast({path}[1:9] as integer) + {cost} as varchar), 9, '0') || {path}[10:{cut} - 1] || "
        f"'{letters}' || {path}[{cut}:] || {line}"
    )


def _repair_sql() -> str:
    """The cheapest path to every last role (n none, s, u, a), row by row.

    Paths compare as text: by cost, then by edits, as chr(1) is before every letter. Inserts lead from
    one column to the next before each row, and behind the last one.
    """
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    both = f"{user} || {assistant}"
    to_user = ", ".join(["u", *(_edit(x, "2", "I", user) for x in "nsa")])
    to_assistant = ", ".join(["a", _edit("u", "2", "I", assistant), *(_edit(x, "4", "II", both) for x in "ns")])
    kept = "chr(10) || role || ':' || text"

    def row(role: str, sources: str) -> str:
        name = "user" if role == "u" else "assistant"
        ways = [
            f"case when kind = '{role}' then {_edit(x, 'cut', 'K', kept)} "
            f"else {_edit(x, '2 + cut', 'R', f"chr(10) || '{name}:' || text")} end"
            for x in sources
        ]
        return ", ".join(f"case when not must_go then {w} end" for w in ways)

    closing = ", ".join(["n", "a", _edit("u", "2", "I", assistant), _edit("s", "4", "II", both)])
    blank = r"not regexp_matches(text, '[^\x20\x09-\x0D]')"
    truncated = r"not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z')"
    longs = ", ".join(f"cast(coalesce({c}, 0) as bigint) as {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))
    bits = "case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    return f"""
        with recursive crc(i, step, x) as (
            select i, 0, i from range(256) r(i)
            union all
            select i, step + 1, {bits} from crc where step < 8
        ), tab as (
            select list(x order by i) as t from crc where step = 8
        ), keyed as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
            from conversations
        ), hit as (
            select conv_id, turn, role, text, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda j: cast(ascii(k[j]) as bigint))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as h
            from keyed, tab
        ), damaged as (
            select conv_id, turn, case h when 4 then 'user' else role end as role,
                case h when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, copy
            from hit, unnest([0, 1]) as c(copy) where h <> 0 and (copy = 0 or h = 3)
        ), faults as (
            select *, {blank} as blank, {truncated} as unfinished, role[1:1] as kind,
                row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as seen,
                row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
                lag(role[1:1]) over (partition by conv_id order by turn nulls first, role, text, copy) as former
            from damaged
        ), marked as (
            select *, blank or seen as must_go, cast(unfinished as integer) as cut from faults
        ), stats as (
            select conv_id, count(*) as rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                count_if(blank) as blank, count_if(seen and not blank) as duplicate,
                count_if(unfinished and not blank and not seen) as truncated,
                count_if(former is not null and former || kind not in ('su', 'ua', 'au')) as illegal
            from marked group by conv_id
        ), paths(conv_id, i, n, s, u, a) as (
            select distinct conv_id, cast(0 as bigint), '000000000' || chr(1), cast(null as varchar), cast(null as varchar),
                cast(null as varchar)
            from conversations
            union all
            select p.conv_id, p.i + 1, {_edit("n", "3", "D")},
                least({_edit("s", "3", "D")}, case when not must_go and kind = 's' then {_edit("n", "cut", "K", kept)} end),
                least({_edit("u", "3", "D")}, {row("u", "nsa")}),
                least({_edit("a", "3", "D")}, {row("a", "u")})
            from (select conv_id, i, n, s, least({to_user}) as u, least({to_assistant}) as a from paths) p
            join marked m on m.conv_id is not distinct from p.conv_id and m.i = p.i + 1
        ), ends as (
            select conv_id, least({closing}) as path from paths
            qualify row_number() over (partition by conv_id order by i desc) = 1
        )
        select e.conv_id, {longs}, cast(path[1:9] as bigint) as cost,
            path[10:strpos(path, chr(1)) - 1] as audit, sha256(path[strpos(path, chr(1)) + 2:]) as repaired_sha256
        from ends e left join stats s on s.conv_id is not distinct from e.conv_id
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_gridorder": op3_gridorder,
    "op4_warc": op4_warc,
    "op5_minhash": op5_minhash,
    "op6_secrets": op6_secrets,
    "op7_mixing": op7_mixing,
    "op8_tokens": op8_tokens,
    "op9_treesearch": op9_treesearch,
    "op10_maxent": op10_maxent,
    "op11_alignment": op11_alignment,
    "op12_conversations": op12_conversations,
    "op13_toxicity": op13_toxicity,
}

ORACLES: dict[str, str] = {
    "op12_conversations": _repair_sql(),
    "op3_gridorder": """
        with recursive v as (
            select vec_id, label, embedding::double[] as e from embeddings
            where label is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links as (
            select a.vec_id as a, b.vec_id as b from v a join v b
            on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
                and list_cosine_similarity(a.e, b.e) >= 0.93
        ), reached as (
            select a as id, a as root from links
            union
            select l.b, r.root from reached r join links l on l.a = r.id where r.root < l.b
        ), roots as (
            select id, min(root) as root from reached group by id
        ), counts as (
            select a as id, count(*) as n from links group by a
        )
        select e.vec_id, coalesce(n, 0) as n_links, least(e.vec_id, coalesce(root, e.vec_id)) as component_id,
            e.vec_id = least(e.vec_id, coalesce(root, e.vec_id)) as kept
        from embeddings e left join counts c on c.id = e.vec_id left join roots r on r.id = e.vec_id
    """,
    "op4_warc": """
        with p as (
            select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
        ), first as (
            select *, case when payload_bytes >= 100 then min(page_id) over (partition by html) else page_id end as r
            from p
        )
        select page_id, payload_bytes, sha256(html) as payload_digest,
            case when r < page_id then 'revisit' else 'response' end as record_type,
            case when r < page_id then r end as refers_to
        from first
    """,
    "op5_minhash": r"""
        with recursive w as (
            select doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
            from documents
        ), shingles as (
            select doc_id, unnest(list_distinct(case
                when len(words) >= 3 then list_transform(range(1, len(words) - 1),
                    lambda i: concat_ws(' ', words[i], words[i + 1], words[i + 2]))
                when len(words) > 0 then [array_to_string(words, ' ')] else [] end)) as s
            from w
        ), sizes as (
            select doc_id, count(*) as n from shingles group by doc_id
        ), common as (
            select a.doc_id as a, b.doc_id as b, count(*) as c
            from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
        ), links as (
            select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * c >= 85 * (x.n + y.n - c)
        ), both_ways as (
            select a, b from links union all select b, a from links
        ), reached as (
            select a as id, a as root from both_ways
            union
            select l.b, r.root from reached r join both_ways l on l.a = r.id where r.root < l.b
        ), roots as (
            select id, min(root) as root from reached group by id
        )
        select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(root, d.doc_id)) as component_id,
            d.doc_id = least(d.doc_id, coalesce(root, d.doc_id)) as kept
        from documents d left join sizes z on z.doc_id = d.doc_id left join roots r on r.id = d.doc_id
    """,
}

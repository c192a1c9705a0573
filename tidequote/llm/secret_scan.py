"""Secret spans: fixed patterns, and credential values by password guess cost (operator 6).

A value in a credential context is cut into words, dates, repeats, keyboard walks and
brute-force stretches so that the sum of the logarithms of their guesses is least (dynamic
programming over its positions). In a value of letters of one case, the first aside, stretches of common pairs of
letters cost less than brute force, which keeps words of prose out. Values too costly to guess are
reported as secrets, whatever signs they have.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: the patterns and the least lengths.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the matches of [0-9a-f]+ are whole runs; these are the long ones
KINDS = ("assign", "access", "hex", "guess")

# A value of fewer than 8 signs costs less than the bound by brute force alone, so none is left out.
_CONTEXT = re.compile(
    r"(?:(?:password|passwd|passphrase|passcode|\bpass|pwd|secret|token|apikey|[_-]key|credentials?|auth)[\"']?"
    r"\s*(?:=>|[:=]|\bis\b)|\bbearer\s)\s*[\"']?([^\s\"'<>,;]{8,})",
    re.IGNORECASE | re.ASCII,
)
MIN_LOG10_GUESSES = 9.0

# Common words of passwords, the most common first.
_WORDS = """password qwerty dragon monkey letmein football baseball master michael shadow superman
jordan harley ranger hunter buster soccer thomas robert hockey killer george charlie andrew
michelle love sunshine jessica pepper daniel access joshua maggie starwars silver william dallas
yankees ashley hello amanda orange summer computer freedom princess welcome admin login secret
token test user root guest default change winter spring autumn flower cheese ginger cookie
matrix mustang phoenix diamond forever internet service system server example sample your here
none null true false placeholder redacted""".split()
_RANK = {w: math.log10(i + 2) for i, w in enumerate(_WORDS)}
_LONGEST_WORD = max(map(len, _WORDS))
_LEET = str.maketrans("4@3€1!|05$7+", "aaeeiilosstt")
_WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "!@#$%^&*()")
_WALKS += tuple(w[::-1] for w in _WALKS)
_DATE = re.compile(
    r"(?=((?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d))"
)
_YEAR = re.compile(r"(?=((?:19|20)\d\d))")
_SEGMENT = 0.3
# The common pairs of letters of prose, and the guesses of a letter after another of its pair.
_PAIRS = frozenset(
    """th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le sa si ar ve
    ra ld ur me ne wa li ly ri io ic ll be ma co no om ch el ro ca la ta us ec hr em pe wh ct il ie ss ns so rs pr
    ce ac ho ni di ee un ot ge pl fo ol tr mo po ut wi lo id ir ts sh ai vi ad su ul ci op os ig ow gh bl pa rt
    ep iv ue na ht rw bo gr ck lt ls ds ys im mi nc nk rk rd ry ty am ay ke ey ff fi fe fr da do sp tt ab ap pp up ev ex cr qu tu mp mb bi br ag ga nf ia"""
    .split()
)
_SPOKEN = math.log10(2.3)
_ENDINGS = tuple("ations ation tional tion sion ments ment ness able ible ings ing ities ity ical istic ally ance ence ized".split())
_ENDING = math.log10(len(_ENDINGS))


def _segments(value: str) -> dict[int, list[tuple[int, float]]]:
    """By end position: (start, log10 guesses) of every word, date, repeat and walk."""
    found: dict[int, list[tuple[int, float]]] = {}
    low = value.lower()
    plain = low.translate(_LEET) if len(low) == len(value) else low
    n = len(value)

    def add(a: int, b: int, cost: float) -> None:
        found.setdefault(b, []).append((a, cost))

    for a in range(n):
        for b in range(a + 4, min(n, a + _LONGEST_WORD) + 1):
            if (cost := _RANK.get(plain[a:b])) is not None:
                varied = (low[a:b] != plain[a:b]) + (value[a:b] != low[a:b])
                add(a, b, cost + 0.5 * varied)
    for pattern, cost in ((_DATE, math.log10(365 * 119)), (_YEAR, math.log10(119))):
        for m in pattern.finditer(value):
            add(*m.span(1), cost)
    for unit in range(1, 5):  # repeats of a unit, at their full length
        a = 0
        while a + unit < n:
            b = a + unit
            while b < n and value[b] == value[b - unit]:
                b += 1
            times = (b - a) // unit
            if times >= 3 or (unit > 1 and times >= 2):
                add(a, a + times * unit, unit + math.log10(times))
                a += times * unit
            else:
                a += 1
    for walk in _WALKS:
        a = 0
        while a < n:
            b, at = a, walk.find(low[a])
            while at >= 0 and b < n and at < len(walk) and low[b] == walk[at]:
                b, at = b + 1, at + 1
            if b - a >= 3:
                add(a, b, math.log10(48 * (b - a)))
                a = b
            else:
                a += 1
    return found


def log10_guesses(value: str) -> float:
    """Least sum of log10 guesses over all segmentations; a tenfold for each brute-force sign."""
    if not value:
        return 0.0
    found = _segments(value)
    low = value.lower() if value.isalpha() and (value[1:].islower() or value.isupper()) else ""
    best, brute, spoken = [0.0], [math.inf], math.inf
    for b in range(1, len(value) + 1):
        brute.append(min(brute[b - 1], best[b - 1] + _SEGMENT) + 1)
        known = min((best[a] + cost + _SEGMENT for a, cost in found.get(b, ())), default=math.inf)
        if low:
            follows = spoken + _SPOKEN if low[b - 2 : b] in _PAIRS else math.inf
            spoken = min(follows, best[b - 1] + _SEGMENT + 1)
            ends = (best[b - len(e)] + _ENDING for e in _ENDINGS if low.endswith(e, 0, b))
            known = min(known, min(ends, default=math.inf))
        best.append(min(brute[b], known, spoken))
    return best[-1]


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    spans = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    base = [(a, b) for _, a, b in spans]
    for m in _CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?)]}")
        a, b = m.start(1), m.start(1) + len(value)
        if len(value) < 8 or any(x <= a and b <= y for x, y in base):
            continue
        if log10_guesses(value) >= MIN_LOG10_GUESSES:
            spans.append(("guess", a, b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, counts of the base kinds, a digest of the base spans, and all spans.

    A null or empty text has no spans (the digest is that of the empty string); repeated rows
    are scanned one by one; a null id is kept; an empty table gives an empty result; other columns are
    not read. A very long text is scanned as a whole. One pass, no shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in batch.column("t"):
                spans = find_spans(text.as_py() or "")
                base = [s for s in spans if s[0] != "guess"]
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(spans))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.record_batch([batch.column("i"), *arrays], names=[id_col, *out])

    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    schema = f"`{id_col}` long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return own.mapInArrow(scan, schema)


def masked(text: str, mask: str = "[SECRET]") -> str:
    """``text`` with every span, or union of overlapping spans, replaced by ``mask``."""
    out, at = [], 0
    for _, a, b in find_spans(text):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with the secrets in ``text`` masked; rows, other columns and nulls as they are.

    Where there is a column ``n_chars`` it follows the new text.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t if t is None else masked(t, mask) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(put, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

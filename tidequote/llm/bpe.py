"""Byte-level BPE on ragged numpy arrays, merged rank by rank.

Distinct pre-tokens of a chunk lie end to end in one array. In every round each sequence finds
its pair of lowest rank and merges all places of that pair at once; a merge only makes pairs of
higher rank, so this gives what merging one pair at a time gives. Sequences without a pair left
the round before are taken out, so later rounds work on the few long ones.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers.pre_tokenizers import ByteLevel

NONE = np.int32(2**31 - 1)
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """Letter, number, white space or other for every code point, as the library sees them.

    ``regex`` and ``unicodedata`` follow different versions of Unicode; where they disagree the
    library's own pre-tokenizer is asked.
    """
    classes = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            a, b = (i if i < 0xD800 else i + 0x800 for i in found.span())
            classes[a:b] = kind
    known = {"L": LETTER, "N": NUMBER}
    other = [c for c in every if known.get(unicodedata.category(c)[0], OTHER) != classes[ord(c)] != SPACE]
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for a in range(0, len(other), 1024):
        own = other[a : a + 1024]
        spans = {span for _, span in split("".join(f"a{c}a1{c}1!" for c in own))}
        for at, c in zip(range(0, 7 * len(own), 7), own, strict=True):
            kind = LETTER if (at, at + 3) in spans else NUMBER if (at + 3, at + 6) in spans else OTHER
            classes[ord(c)] = kind
    return classes


def pre_token_starts(data: np.ndarray, offsets: np.ndarray, special: bytes = b"") -> np.ndarray:
    """Byte positions at which pre-tokens begin; together they cover all texts.

    The rules: a contraction ('s 't 're 've 'm 'll 'd); else a run of letters, of numbers or of
    other signs, each with one blank before it if there is one; white space before a sign
    leaves its last character to what follows.
    """
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    byte = data[lead]
    classes = code_point_classes()
    kind = classes[byte]
    wide = np.flatnonzero(byte >= 0xC0)
    if len(wide):
        at, b0 = lead[wide], byte[wide].astype(np.int32)
        tail = np.concatenate([data, np.zeros(4, np.uint8)])
        b1, b2, b3 = ((tail[at + k] & 0x3F).astype(np.int32) for k in (1, 2, 3))
        two = (b0 & 0x1F) << 6 | b1
        three = (b0 & 0x0F) << 12 | b1 << 6 | b2
        four = (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3
        kind[wide] = classes[np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four))]
    n = len(lead)
    hard = np.zeros(n + 1, bool)
    hard[np.searchsorted(lead, offsets)] = True
    fixed = []
    if special:
        raw, at = data.tobytes(), 0
        while (at := raw.find(special, at)) >= 0:
            text_end = offsets[np.searchsorted(offsets, at, "right")]
            if at + len(special) <= text_end:
                a, b = np.searchsorted(lead, (at, at + len(special)))
                hard[[a, b]] = True
                fixed.append((a, b))
                at += len(special)
            else:
                at += 1
    change = hard[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(change)  # runs of one class within one text
    run_end = np.append(run[1:], n)
    run_kind = kind[run]
    start = np.zeros(n + 1, bool)
    start[run] = True
    # the last character of white space before a sign goes with it, if it is a blank
    followed = (run_kind == SPACE) & ~hard[run_end]
    last = run_end[followed] - 1
    start[last] = True
    blank = byte[last] == 0x20
    start[last[blank] + 1] = False
    # contractions: an apostrophe alone, not after a blank, before its letters
    mark = run[(run_kind == OTHER) & (run_end - run == 1) & (byte[run] == 0x27)]
    mark = mark[start[mark] & ~hard[mark + 1]]
    if len(mark):
        near = np.append(byte, np.zeros(3, np.uint8))
        one, two = near[mark + 1], near[mark + 2]
        two[hard[np.minimum(mark + 2, n)]] = 0
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = np.zeros(len(mark), bool)
        for a, b in (b"re", b"ve", b"ll"):
            long |= (one == a) & (two == b)
        size = np.where(short, 2, np.where(long, 3, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        end = mark + size
        inside = (end < n) & (kind[np.minimum(end, n - 1)] == LETTER) & ~hard[end]
        start[end[inside]] = True
    for a, b in fixed:
        start[a:b] = False
        start[a] = True
    return lead[start[:n]]


def distinct_pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the distinct piece of each piece, bytes of the distinct ones, their offsets)."""
    ends = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = pieces.dictionary_encode()
    kinds = coded.dictionary
    offsets = np.frombuffer(kinds.buffers()[1], np.int64)[: len(kinds) + 1]
    own = kinds.buffers()[2]
    own = np.frombuffer(own, np.uint8)[: offsets[-1]] if own is not None else np.empty(0, np.uint8)
    return coded.indices.to_numpy(), own, offsets


class ByteBpe:
    """The vocabulary and merges of a byte-level ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_ids = np.array([vocab[chars[b]] for b in range(256)], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        added = spec.get("added_tokens") or [{"content": "", "id": -1}]
        if len(added) > 1 or any(added[0].get(k) for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("more than one plain added token")
        self.special, self.special_id = added[0]["content"].encode(), added[0]["id"]
        self.bits = max(4, int(len(keys) * 5).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = keys[left[free]]  # of rivals for a slot the last stays
            self.ranks[slot[free]] = left[free]
            lost = self.slots[slot] != keys[left]
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 32 | b
        slot = self._slot(keys)
        seen = self.slots[slot]
        ranks = np.where(seen == keys, self.ranks[slot], NONE)
        left = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(left):
            slot_left = (slot[left] + 1) & ((1 << self.bits) - 1)
            slot[left] = slot_left
            seen = self.slots[slot_left]
            hit = seen == keys[left]
            ranks[left[hit]] = self.ranks[slot_left[hit]]
            left = left[~hit & (seen >= 0)]
        return ranks

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, offsets) of ragged byte sequences, none of them empty."""
        n = len(offsets) - 1
        lengths = np.zeros(n, np.int64)
        done_ids, done_of = [], []
        symbols = self.byte_ids[data]
        starts, alive = offsets[:-1].astype(np.int64), np.arange(n)
        if self.special and n:
            same = np.flatnonzero(np.diff(offsets) == len(self.special))
            for k in same:
                if data[offsets[k] : offsets[k + 1]].tobytes() == self.special:
                    symbols[offsets[k]] = self.special_id
                    keep = np.ones(len(symbols), bool)
                    keep[offsets[k] + 1 : offsets[k + 1]] = False
                    symbols = symbols[keep]
                    starts[k + 1 :] -= len(self.special) - 1
                    break  # sequences are distinct
        ranks = np.full(len(symbols), NONE, np.int32)
        if len(symbols) > 1:
            ranks[:-1] = self.pair_ranks(symbols[:-1], symbols[1:])
            ranks[starts[1:] - 1] = NONE
        while len(alive):
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(ranks, starts)
            over = least == NONE
            if over.any():
                lengths[alive[over]] = sizes[over]
                out = np.repeat(over, sizes)
                done_ids.append(symbols[out])
                done_of.append(alive[over])
                symbols, ranks = symbols[~out], ranks[~out]
                alive, sizes, least = alive[~over], sizes[~over], least[~over]
                if not len(alive):
                    break
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hit = ranks == np.repeat(least, sizes)
            at = np.flatnonzero(hit)
            close = np.flatnonzero(at[1:] == at[:-1] + 1)
            if len(close):  # a run of one symbol: every other place, from its first
                first = np.ones(len(at), bool)
                first[1:] = at[1:] != at[:-1] + 1
                head = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - head) % 2 == 0]
            symbols[at] = self.merged[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            lost = np.add.reduceat((~keep).astype(np.int64), starts)
            moved = np.cumsum(keep) - 1
            symbols, ranks = symbols[keep], ranks[keep]
            sizes = sizes - lost
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            at = moved[at]
            final = np.zeros(len(symbols), bool)
            final[starts + sizes - 1] = True
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            ranks[touched & final] = NONE
            fresh = np.flatnonzero(touched & ~final)
            ranks[fresh] = self.pair_ranks(symbols[fresh], symbols[fresh + 1])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(ends[-1], np.int32)
        for got, of in zip(done_ids, done_of, strict=True):
            ids[ragged(ends[of], lengths[of])] = got
        return ids, ends

    def token_counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        return self._coded(data, offsets)[0]

    def token_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, tokens of each text)."""
        counts, which, ids, ends = self._coded(data, offsets)
        if not len(which):
            return np.empty(0, np.int32), counts
        sizes = np.diff(ends)[which]
        return ids[ragged(ends[which], sizes)], counts

    def _coded(self, data, offsets):
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(n, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.zeros(1, np.int64)
        starts = pre_token_starts(data, offsets, self.special)
        which, kinds, kind_offsets = distinct_pieces(data, starts)
        ids, ends = self.encode(kinds, kind_offsets)
        sums = np.concatenate([[0], np.cumsum(np.diff(ends)[which])])
        counts = np.diff(sums[np.searchsorted(starts, offsets)])
        return counts, which, ids, ends


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, end to end."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


@lru_cache(2)
def load(path: str | None = None) -> ByteBpe:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return ByteBpe(path)

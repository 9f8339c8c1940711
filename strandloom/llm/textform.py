"""One form for texts that look the same (problem 6).

An Arrow string column is decoded once per batch into one numpy array of code
points. A lookup table gives every code point its expansion (compatibility
decomposition, kinds of space, characters that show nothing, look-alike
letters), a gather with expansion offsets rewrites the whole batch, and marks
are put in canonical order and composed by vector operations. No string
method is called per row.

Defined results: null stays null; an empty text stays empty; a text of blanks
or invisible characters becomes empty; runs of any kinds of space become one
blank, outer ones vanish; letter case and accents are kept. The form is
idempotent.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Letters that are drawn like a Latin letter.
LOOKALIKES = {
    # Cyrillic, small
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y",
    # Cyrillic, capital
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ӏ": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y",
    # Greek, capital and small
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z", "ν": "v", "ο": "o", "ϲ": "c", "ϳ": "j", "ι": "i",
    # Armenian, phonetic
    "օ": "o", "ɡ": "g", "ɩ": "i", "ɑ": "a",
    # hyphens and minus signs
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "˗": "-", "⁃": "-",
}

# Format characters that do show something, and other characters that show nothing.
VISIBLE_FORMAT = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD, *range(0xFFF9, 0xFFFC)}
HIDDEN = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE1000)}

TOP = 0x110000
BLANK = 0x20


def _expansion(cp: int) -> str:
    """What one code point becomes."""
    char = chr(cp)
    kind = unicodedata.category(char)
    if kind in ("Zs", "Zl", "Zp") or char in "\t\n\v\f\r\x85":
        return " "
    if cp in HIDDEN or kind == "Cc" or (kind == "Cf" and cp not in VISIBLE_FORMAT):
        return ""
    if 0xAC00 <= cp <= 0xD7A3:
        return char
    parts = unicodedata.normalize("NFKD", LOOKALIKES.get(char, char))
    if parts == char:
        return LOOKALIKES.get(char, char)
    out = "".join(LOOKALIKES.get(x, " " if unicodedata.category(x) == "Zs" else x) for x in parts)
    # a compatibility sign for an accent alone expands to blank and mark: the blank carries it
    return out


class Tables:
    """Lookup tables, filled for the code points that have been met; one instance per Python worker."""

    def __init__(self) -> None:
        self.known = np.zeros(TOP, np.bool_)
        self.count = np.ones(TOP, np.uint8)
        self.start = np.zeros(TOP, np.int32)
        self.single = np.arange(TOP, dtype=np.uint32)
        self.ccc = np.zeros(TOP, np.uint8)
        self.lower = np.arange(TOP, dtype=np.uint32)
        self.alnum = np.zeros(TOP, np.bool_)
        self.flat = np.zeros(0, np.uint32)
        self.pairs: dict[int, int] = {}

    def learn(self, cps: np.ndarray) -> None:
        fresh = cps[~self.known[cps]]
        if not fresh.size:
            return
        todo, flat = [int(x) for x in np.unique(fresh)], [self.flat]
        seen, size = set(todo), int(self.flat.size)
        while todo:
            cp = todo.pop()
            char = chr(cp)
            parts = [ord(x) for x in _expansion(cp)]
            self.known[cp] = True
            self.count[cp], self.start[cp] = len(parts), size
            self.single[cp] = parts[0] if parts else 0
            self.ccc[cp] = unicodedata.combining(char)
            self.alnum[cp] = char.isalnum()
            self.lower[cp] = ord(char.lower()[0])
            flat.append(np.array(parts, np.uint32))
            size += len(parts)
            for x in {*parts, int(self.lower[cp])} | {ord(y) for y in unicodedata.normalize("NFC", "".join(map(chr, parts)))}:
                if x not in seen and not self.known[x]:
                    seen.add(x)
                    todo.append(x)
        self.flat = np.concatenate(flat)

    def composite(self, first: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The composed code point of each pair, 0 where there is none."""
        keys, back = np.unique((first.astype(np.uint64) << np.uint64(21)) | mark.astype(np.uint64), return_inverse=True)
        out = np.zeros(keys.size, np.uint32)
        for k, key in enumerate(keys.tolist()):
            if key not in self.pairs:
                one = unicodedata.normalize("NFC", chr(key >> 21) + chr(key & 0x1FFFFF))
                self.pairs[key] = ord(one) if len(one) == 1 else 0
            out[k] = self.pairs[key]
        if out.any():
            self.learn(out[out > 0])
        return out[back]


_tables: Tables | None = None


def tables() -> Tables:
    global _tables
    if _tables is None:
        _tables = Tables()
    return _tables


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a string column (a null counts as empty) and the offset of every row, plus the end."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    if column.null_count:  # what lies behind a null is not defined
        column = column.fill_null("")
        buffers = column.buffers()
        ends = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    lo, hi = int(ends[0]), int(ends[-1])
    raw = memoryview(buffers[2])[lo:hi] if buffers[2] is not None else b""
    octets = np.frombuffer(raw, np.uint8)
    cps = np.frombuffer(bytes(raw).decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.zeros(octets.size + 1, np.int64)
    np.cumsum((octets & 0xC0) != 0x80, out=before[1:])
    return cps, before[ends - lo]


def _offsets(keep_or_count: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(keep_or_count.size + 1, np.int64)
    np.cumsum(keep_or_count, out=total[1:])
    return total[offsets]


def _rows(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(offsets.size - 1), np.diff(offsets))


def _firsts(offsets: np.ndarray, size: int) -> np.ndarray:
    """True at the first code point of each row."""
    out = np.zeros(size, np.bool_)
    out[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return out


def _compose(cps: np.ndarray, offsets: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    ccc = t.ccc[cps]
    if ccc.any():
        first = _firsts(offsets, cps.size)
        segment = np.cumsum((ccc == 0) | first)
        swapped = (ccc[1:] > 0) & (ccc[:-1] > ccc[1:]) & (segment[1:] == segment[:-1])
        if swapped.any():
            order = np.lexsort((np.where(first, 0, ccc), segment))
            cps, ccc = cps[order], ccc[order]
        cps = cps.copy()
        heads = np.flatnonzero((ccc == 0) | first)
        marks = np.flatnonzero((ccc > 0) & ~first)
        if marks.size:
            seg = segment[marks] - 1
            head = heads[seg]
            rank = marks - head
            last = np.zeros(heads.size, np.uint8)
            keep = np.ones(cps.size, np.bool_)
            for r in range(1, int(rank.max()) + 1):
                now = marks[rank == r]
                if not now.size:
                    continue
                s = segment[now] - 1
                free = (last[s] < ccc[now]) & (ccc[heads[s]] == 0)
                made = np.zeros(now.size, np.uint32)
                if free.any():
                    made[free] = t.composite(cps[heads[s[free]]], cps[now[free]])
                done = made > 0
                cps[heads[s[done]]] = made[done]
                keep[now[done]] = False
                last[s[~done]] = ccc[now[~done]]
            if not keep.all():
                offsets = _offsets(keep, offsets)
                cps = cps[keep]
    # Korean letters: leading consonant and vowel, then a final consonant
    for lo, hi, head_ok in ((0x1161, 0x1175, lambda h: (h >= 0x1100) & (h <= 0x1112)), (0x11A8, 0x11C2, lambda h: (h >= 0xAC00) & (h <= 0xD7A3) & ((h - 0xAC00) % 28 == 0))):
        at = np.flatnonzero((cps >= lo) & (cps <= hi))
        at = at[at > 0]
        if at.size:
            at = at[head_ok(cps[at - 1]) & ~_firsts(offsets, cps.size)[at]]
        if at.size:
            cps = cps.copy()
            cps[at - 1] = (0xAC00 + ((cps[at - 1] - 0x1100) * 21 + (cps[at] - 0x1161)) * 28) if lo == 0x1161 else cps[at - 1] + (cps[at] - 0x11A7)
            keep = np.ones(cps.size, np.bool_)
            keep[at] = False
            offsets, cps = _offsets(keep, offsets), cps[keep]
            t.learn(cps)
    return cps, offsets


def canonical(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points and row offsets of the one form of every text."""
    t = tables()
    cps, offsets = code_points(column)
    if not cps.size:
        return cps, offsets
    t.learn(cps)
    count = t.count[cps]
    if (count == 1).all():
        out = t.single[cps]
    else:
        offsets = _offsets(count, offsets)
        ends = np.cumsum(count, dtype=np.int64)
        out = t.flat[np.repeat(t.start[cps] - (ends - count), count) + np.arange(int(ends[-1]))]
    if out.size:
        out, offsets = _compose(out, offsets, t)
        blank = out == BLANK
        first = _firsts(offsets, out.size)
        keep = ~(blank & (first | np.concatenate(([False], blank[:-1]))))
        if not keep.all():
            offsets, out = _offsets(keep, offsets), out[keep]
        tail = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        tail = tail[out[tail] == BLANK] if tail.size else tail
        if tail.size:
            keep = np.ones(out.size, np.bool_)
            keep[tail] = False
            offsets, out = _offsets(keep, offsets), out[keep]
    return out, offsets


def to_arrow(cps: np.ndarray, offsets: np.ndarray, source: pa.Array | None = None) -> pa.Array:
    """A string column from code points; null where ``source`` is null."""
    data = cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
    ends = _offsets(width, offsets)
    out = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
    if source is not None and source.null_count:
        import pyarrow.compute as pc

        out = pc.if_else(pc.is_valid(source), out, pa.scalar(None, pa.large_string()))
    return out.cast(pa.string())


#: Bytes of text that are worked on at once; a longer text is worked on by itself.
SLICE_BYTES = 4 << 20


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, so that memory doesn't grow with a batch of long texts."""
    n = len(column)
    if not n:
        return
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    ends = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
        yield start, min(stop, n)
        start = stop


def one_form(column: pa.Array) -> pa.Array:
    parts = [to_arrow(*canonical(part), part) for a, b in slices(column) for part in [column.slice(a, b - a)]]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


# --- words ---------------------------------------------------------------------------------------

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.up.size < n:
            size = max(n, 2 * cls.up.size)
            cls.up = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, BASE))))
            cls.down = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, BASE_INVERSE))))
        return cls.up, cls.down


def words(cps: np.ndarray, offsets: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-case runs of letters and digits: 64-bit hash, first and past-last code point of each word, and each row's offset into them."""
    t = tables()
    if not cps.size:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(offsets.size, np.int64)
    inside = t.alnum[cps]
    first = _firsts(offsets, cps.size)
    before = np.concatenate(([False], inside[:-1]))
    begin = inside & (first | ~before)
    end = inside & np.concatenate((~inside[1:] | first[1:], [True]))
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _Powers.get(cps.size)
    total = np.zeros(cps.size + 1, np.uint64)
    np.cumsum(mix(t.lower[cps].astype(np.uint64) + np.uint64(1 + (seed << 32))) * up[: cps.size], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, _offsets(begin, offsets)

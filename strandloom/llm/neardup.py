"""Near-duplicate records (problem 7): an exact set-similarity join with bit-sliced comparison.

Similarity is the Jaccard similarity of the sets of words in the form of
problem 6. The join is exact for every pair of different word sets:

1. Words are hashed to 64 bits per record in one vectorised pass. The pass also
   gives every word once a task, and the table of these proves that no two
   words of the collection share a hash; if two did, another seed is taken. To
   compare hashes is then to compare words. Records with the same set form a
   class; one record stands for it.
2. Words are put in one global order, rarest first. If two sets reach the
   limit, their two rarest common words lie within a short prefix of both, so
   a record is sent once per prefix word, with the prefix words that follow
   it. A hot word is split by its following words into salted parts. Sets of
   ``LARGE`` words and more, whose following words would be too many, and sets
   that may share one word only are sent without them; a hot word is then split
   into blocks, and every two blocks make a part.
3. Within a part, records that share both words form a block (in parts of at
   most ``WHOLE`` records, all form one). A record's set is hashed to a parity
   signature; differing bits never exceed differing words. Signatures are
   stored as vertical bit planes, 64 records a machine word, and the distances
   of many records are updated at once by carry-save bitwise counters. Block
   words whose 64 distances all exceed the radius are abandoned while planes
   remain. Longer sets have more planes (``BANDS``); a set that is within the
   limit of a longer band is compared there too. Beyond the last band distances
   say little, and step 4 does the work.
4. Survivors are compared by their words.

The constants change how the work is laid out, never which pairs are found.

Defined results: null texts take no part; records with fewer than ``least``
words take no part; rows repeated with one key count once; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import textform
from strandloom.runtime import BROADCAST_ROWS, Scratch, spread

#: Bands of sizes: the least number of words, and the bit planes of a signature there.
BANDS = [(0, 128), (96, 512), (384, 2048)]
#: Bytes of a word's hash in the word table.
WIDTH = 8
#: The most words whose counts are broadcast for the global order (16 bytes each); rarer ones count as equally rare.
ORDERED_WORDS = 200_000
#: Rows of one word that one part is meant to hold; a hotter word is salted into more parts.
PART_ROWS = 20_000
#: A block that size is compared as a whole, without looking at second words.
WHOLE = 64
#: Rows of one identical text that are paired with one another; further copies are paired with the first.
COPIES = 32
#: Rows of a class of one word set that are paired at once.
CHUNK = 2_000
#: Words of a set from which it is searched by single prefix words: following words would be too many.
LARGE = 2_000
#: Words that a task remembers to have sent to the table of words.
REMEMBERED = 4_000_000
#: What is sent of a record before its signature: key, number of words, band, and whether the word is in the prefix for partners that are no smaller.
HEAD = np.dtype([("key", "<i8"), ("size", "<u4"), ("low", "u1"), ("band", "u1")])


def _unpack(blob: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(blob).view("<u8")


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _blob(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def _distinct(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and the rows' offsets."""
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    keep = np.ones(hashes.size, np.bool_)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[keep], rows[keep]
    return hashes, np.searchsorted(rows, np.arange(n + 1))


def _word_sets(least: int, seed: int):
    """``tab, key, text, sa, sb, words`` of every record that takes part; and, with a null ``tab``, every word once a task: its hash and letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(0, np.uint64)
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in textform.slices(b.column(3))):
            n = batch.num_rows
            cps, ends = textform.canonical(batch.column(3))
            hashes, begin, end, offsets = textform.words(cps, ends, seed)
            rows = np.repeat(np.arange(n), np.diff(offsets))
            some, first = np.unique(hashes, return_index=True)
            new = ~np.isin(some, met, assume_unique=True)
            some, first = some[new], first[new]
            met = np.union1d(met, some) if met.size < REMEMBERED else some
            if some.size:
                length = (end - begin)[first]
                stop = np.zeros(length.size + 1, np.int64)
                np.cumsum(length, out=stop[1:])
                letters = textform.tables().lower[cps[np.repeat(begin[first] - stop[:-1], length) + np.arange(int(stop[-1]))]]
                none = pa.nulls(some.size, pa.int64())
                yield pa.RecordBatch.from_arrays([none.cast(pa.int32()), none, none, pa.array(some.view(np.int64)), none, _binary(letters.astype("<u4").view(np.uint8), stop * 4)], ["tab", "key", "text", "sa", "sb", "words"])
            hashes, offsets = _distinct(hashes, rows, n)
            size = np.diff(offsets)
            wide = np.concatenate((textform.mix(hashes + np.uint64(1)), [np.uint64(0)]))
            starts = np.minimum(offsets[:-1], hashes.size)
            a = np.where(size > 0, np.add.reduceat(wide, starts), 0).view(np.int64)
            b = np.where(size > 0, np.bitwise_xor.reduceat(textform.mix(wide), starts), 0).view(np.int64)
            keep = pa.array(np.flatnonzero(size >= least))
            blobs = _binary(hashes.astype("<u8").view(np.uint8), offsets * WIDTH).take(keep)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(keep) for k in range(3)), pa.array(a).take(keep), pa.array(b).take(keep), blobs], ["tab", "key", "text", "sa", "sb", "words"])

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        word, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(count.astype(np.int64))], ["word", "n"])

    for batch in batches:
        if batch.num_rows:
            held.append(_unpack(_blob(batch.column(0))[0]))
            size += held[-1].size
        if size > 4_000_000:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _missing(size: np.ndarray, share: Fraction) -> np.ndarray:
    """How many words of a set may be missing from a partner."""
    return size - -(-size * share.numerator // share.denominator)


def _signature(hashes: np.ndarray, offsets: np.ndarray, planes: int) -> np.ndarray:
    """Parity signatures of sets that are not empty, [row, byte]."""
    bit = (textform.mix(hashes ^ np.uint64(0xA5A5A5A5)) % np.uint64(planes)).astype(np.int64)
    n = offsets.size - 1
    out = np.zeros((n, planes // 8), np.uint8)
    step = max(1, (1 << 23) // planes)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        at = slice(offsets[lo], offsets[hi])
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1]))
        odd = np.bincount(row * planes + bit[at], minlength=(hi - lo) * planes).reshape(hi - lo, planes) & 1
        out[lo:hi] = np.packbits(odd.astype(np.uint8), axis=1, bitorder="little")
    return out


def _records(head: np.ndarray, sig: np.ndarray, tail: np.ndarray, run_len: np.ndarray) -> pa.Array:
    """Records of one band: head, signature, and the codes of the following words."""
    n, fixed = head.size, HEAD.itemsize + sig.shape[1]
    stop = np.zeros(n + 1, np.int64)
    np.cumsum(fixed + 2 * run_len, out=stop[1:])
    out = np.empty(int(stop[-1]), np.uint8)
    out[(stop[:-1, None] + np.arange(fixed)).ravel()] = np.concatenate((head.view(np.uint8).reshape(n, -1), sig), axis=1).ravel()
    if tail.size:
        begin = np.cumsum(run_len) - run_len
        out[np.repeat(stop[:-1] + fixed - 2 * begin, 2 * run_len) + np.arange(tail.size)] = tail
    return _binary(out, stop)


def _in_band(size: np.ndarray, band: int, share: Fraction) -> np.ndarray:
    """Sets that are compared in a band: its own, and those that a set of it may match."""
    low = BANDS[band][0]
    high = BANDS[band + 1][0] if band + 1 < len(BANDS) else np.iinfo(np.int64).max
    return (size * share.denominator >= low * share.numerator) & (size < high)


def _send(common, share: Fraction):
    """A row per prefix word: where it goes, and the record with the prefix words that follow."""
    words_, counts_ = common.value
    no_smaller = 2 * share / (1 + share)

    def part_of(word: np.ndarray, tab: np.ndarray, band: int, more: np.ndarray) -> pa.Array:
        key = textform.mix(tab.astype(np.uint64) * np.uint64(8191) + np.uint64(977 * band + 1))
        return pa.array(textform.mix(word ^ textform.mix(key + more.astype(np.uint64))).view(np.int64))

    def head_of(key, size, low, band) -> np.ndarray:
        head = np.zeros(key.size, HEAD)
        head["key"], head["size"], head["low"], head["band"] = key, size, low, band
        return head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _blob(batch.column(2))
            length = np.diff(ends) // WIDTH
            for band, (_, planes) in enumerate(BANDS):
                members = np.flatnonzero(_in_band(length, band, share))
                # slices bound the memory that long sets take
                cost = np.cumsum(length[members])
                cuts = np.searchsorted(cost, np.arange(0, int(cost[-1]) if cost.size else 0, 1 << 20))
                for lo, hi in zip(cuts, [*cuts[1:], members.size]):
                    if hi > lo:
                        yield from send(batch, data, ends, members[lo:hi], band, planes)

    def send(batch, data, ends, rows, band, planes) -> Iterator[pa.RecordBatch]:
        tab = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
        key = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
        size = (np.diff(ends) // WIDTH)[rows]
        offsets = np.concatenate(([0], np.cumsum(size)))
        hashes = _unpack(data)[np.repeat(ends[:-1][rows] // WIDTH - offsets[:-1], size) + np.arange(int(offsets[-1]))]
        row = np.repeat(np.arange(rows.size), size)
        sig = _signature(hashes, offsets, planes)
        at = np.minimum(np.searchsorted(words_, hashes), max(words_.size - 1, 0))
        count = np.where(words_[at] == hashes, counts_[at], 0) if words_.size else np.zeros(hashes.size, np.int64)
        order = np.lexsort((hashes, count, row))
        hashes, count = hashes[order], count[order]
        place = np.arange(hashes.size) - offsets[:-1][row]  # 0 is the rarest
        # first words: up to place m; second words: up to place m + 1
        m, mi = _missing(size, share), _missing(size, no_smaller)
        # sets that may share one word only, and very large ones, are also sent without following words
        by_one = (size * share.numerator <= share.denominator) | (size >= LARGE * share)
        single = np.flatnonzero((place <= m[row]) & by_one[row])
        blocks = np.maximum(1, -(-count[single] // PART_ROWS))
        # a block of a hot word meets every block of it
        times = np.repeat(np.arange(single.size), blocks)
        other = np.arange(times.size) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        own = (textform.mix(key[row[single]].astype(np.uint64) + np.uint64(5)) % blocks.astype(np.uint64)).astype(np.int64)[times]
        pair = np.minimum(own, other) * (1 << 20) + np.maximum(own, other)
        for lo in range(0, times.size, 50_000):
            some = single[times[lo : lo + 50_000]]
            r = row[some]
            head = head_of(key[r], size[r], place[some] <= mi[r], band)
            part = part_of(hashes[some], tab[r], band, pair[lo : lo + 50_000] + (1 << 40))
            yield pa.RecordBatch.from_arrays([pa.array(tab[r].astype(np.int32)), part, _records(head, sig[r], np.zeros(0, np.uint8), np.zeros(r.size, np.int64))], ["tab", "part", "record"])
        first = np.flatnonzero((place <= m[row]) & (size[row] <= LARGE))
        r = row[first]
        follow = np.minimum(m[r] + 1, size[r] - 1) - place[first]
        parts = np.maximum(1, -(-count[first] // PART_ROWS))
        # entries: (first word, second word); in a salted word each part gets the second words of its salt
        owner = np.repeat(np.arange(first.size), follow)
        step = np.arange(owner.size) - np.repeat(np.cumsum(follow) - follow, follow)
        second_at = first[owner] + 1 + step
        second = hashes[second_at]
        low = (place[first[owner]] <= mi[r[owner]]) & (place[second_at] <= mi[r[owner]] + 1)
        salt = (textform.mix(second) % parts[owner].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((salt, owner))
        owner, second, low, salt = owner[order], second[order], low[order], salt[order]
        new = np.ones(owner.size, np.bool_)
        new[1:] = (owner[1:] != owner[:-1]) | (salt[1:] != salt[:-1])
        begin = np.flatnonzero(new)
        run_len = np.diff(np.append(begin, owner.size))
        for lo in range(0, begin.size, 50_000):
            some = begin[lo : lo + 50_000]
            length = run_len[lo : lo + 50_000]
            o = owner[some]
            rr = r[o]
            head = head_of(key[rr], size[rr], place[first[o]] <= mi[rr], band)
            here = slice(some[0], some[-1] + length[-1])
            tail = (((second[here] & np.uint64(0x7FFF)) << np.uint64(1)) | low[here].astype(np.uint64)).astype("<u2").view(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(tab[rr].astype(np.int32)), part_of(hashes[first[o]], tab[rr], band, salt[some]), _records(head, sig[rr], tail, length)], ["tab", "part", "record"])

    return run


def _planes(sig: np.ndarray) -> np.ndarray:
    """Vertical bit planes of signatures [row, byte], 64 records a word: [plane, word]."""
    n, planes = sig.shape[0], sig.shape[1] * 8
    lanes = np.zeros((-(-n // 64) * 64, planes), np.uint8)
    lanes[:n] = np.unpackbits(sig, axis=1, bitorder="little")
    return np.packbits(lanes.reshape(-1, 64, planes), axis=1, bitorder="little").transpose(2, 0, 1).copy().view(np.uint64)[:, :, 0]


def _add(total: list[np.ndarray], bits: np.ndarray, weight: int) -> None:
    """Add one bit of weight 2**weight to the bit-sliced counters."""
    for k in range(weight, len(total)):
        carry = total[k] & bits
        total[k] ^= bits
        bits = carry
        if k == len(total) - 1:
            return


def within_radius(planes: np.ndarray, masks: np.ndarray, word: np.ndarray, query: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (query, word of 64 lanes): the lanes whose distance is at most the radius.

    Eight planes at a time go through carry-save adders. Counters start at the
    number of planes - radius - 1, so that their top bit tells that a lane is
    beyond the radius; a word is abandoned once all its lanes are. Returns the positions
    of the words that are left, and their lanes as bits.
    """
    alive = np.arange(word.size)
    many = planes.shape[0]
    top = many.bit_length() - 1  # the number of planes is a power of two
    start = (many - 1 - radius).astype(np.int64)
    total = [np.where((start >> k) & 1 == 1, ~np.uint64(0), np.uint64(0)) for k in range(top + 1)]
    for g in range(0, many, 8):
        x = planes[g : g + 8][:, word] ^ masks[g : g + 8][:, query]
        # carry-save tree: 8 bits to ones, twos, fours
        a = x[0] ^ x[1]
        s1, c1 = a ^ x[2], (x[0] & x[1]) | (a & x[2])
        a = x[3] ^ x[4]
        s2, c2 = a ^ x[5], (x[3] & x[4]) | (a & x[5])
        a = s1 ^ s2
        s3, c3 = a ^ x[6], (s1 & s2) | (a & x[6])
        ones, c4 = s3 ^ x[7], s3 & x[7]
        a = c1 ^ c2
        t1, d1 = a ^ c3, (c1 & c2) | (a & c3)
        twos, d2 = t1 ^ c4, t1 & c4
        fours, eights = d1 ^ d2, d1 & d2
        # a counter beyond the radius keeps its top bit: it starts below the number of planes and gains at most that
        _add(total, ones, 0)
        _add(total, twos, 1)
        _add(total, fours, 2)
        _add(total, eights, 3)
        if g % 16 == 8 or g + 8 == many:
            left = total[top] != ~np.uint64(0)
            if not left.all():
                alive, word, query = alive[left], word[left], query[left]
                total = [t[left] for t in total]
            if not alive.size:
                break
    return alive, ~total[top]


def _compare(share: Fraction):
    """Candidate pairs of every part: sorted parts come in, batches may cut them."""
    ratio = float((1 - share) / (1 + share))
    share_ = float(share)

    def block_pairs(rec: np.ndarray, sig: np.ndarray, member: np.ndarray, block: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """member: entries as record numbers, block: their block; both sorted by block and then by size. low: may be the smaller one."""
        if member.size < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = rec["size"][member].astype(np.int64)
        planes = _planes(sig[member])
        most = planes.shape[0] - 1
        last = np.searchsorted(block, block, "right")
        # a query looks ahead of itself, as far as a partner can be in size
        scale = np.int64(1 << 33)
        order_key = block * scale + size
        reach = np.minimum(last, np.searchsorted(order_key, block * scale + np.floor(size / share_ + 1e-9).astype(np.int64), "right"))
        at = np.flatnonzero(low & (reach > np.arange(member.size) + 1))
        lo, hi = (at + 1) // 64, (reach[at] - 1) // 64 + 1
        span = hi - lo
        found_a, found_b = [], []
        stop = np.cumsum(span)
        cuts = np.searchsorted(stop, np.arange(0, int(stop[-1]) if stop.size else 0, (1 << 22) // (most + 1)))
        for c0, c1 in zip(cuts, [*cuts[1:], at.size]):
            if c1 <= c0:
                continue
            q, sp = at[c0:c1], span[c0:c1]
            query = np.repeat(np.arange(q.size), sp)
            word = np.arange(query.size) - np.repeat(np.cumsum(sp) - sp, sp) + np.repeat(lo[c0:c1], sp)
            largest = size[np.minimum((word + 1) * 64, reach[q[query]]) - 1]
            top = np.maximum(largest, size[q[query]])
            radius = np.minimum(np.floor(ratio * (size[q[query]] + top) + 1e-9).astype(np.int64), most)
            masks = np.where(np.unpackbits(sig[member[q]], axis=1, bitorder="little").T > 0, ~np.uint64(0), np.uint64(0))
            alive, lanes = within_radius(planes, masks, word, query, radius)
            if not alive.size:
                continue
            near = np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k, lane = np.nonzero(near)
            a, b = q[query[alive[k]]], word[alive[k]] * 64 + lane
            ok = (b > a) & (b < reach[a])
            a, b = member[a[ok]], member[b[ok]]
            # the radius of the pair itself
            apart = np.bitwise_count(sig[a] ^ sig[b]).sum(axis=1, dtype=np.int64)
            ok = apart <= ratio * (rec["size"][a].astype(np.int64) + rec["size"][b]) + 1e-9
            found_a.append(a[ok])
            found_b.append(b[ok])
        if not found_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_a), np.concatenate(found_b)

    def work(part: np.ndarray, tab: np.ndarray, data: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole parts, rows sorted by part; a part's rows are of one band."""
        head = np.frombuffer(data[(ends[:-1, None] + np.arange(HEAD.itemsize)).ravel()].tobytes(), HEAD)
        for band in np.unique(head["band"]):
            at = np.flatnonzero(head["band"] == band)
            fixed = HEAD.itemsize + BANDS[band][1] // 8
            sig = data[ends[:-1][at][:, None] + np.arange(HEAD.itemsize, fixed)]
            yield from compare(part[at], tab[at], data, ends[:-1][at] + fixed, (np.diff(ends)[at] - fixed) // 2, head[at], sig)

    def compare(part, tab, data, start, count, rec, sig) -> Iterator[pa.RecordBatch]:
        n = part.size
        _, group, members = np.unique(part, return_inverse=True, return_counts=True)
        sized = members[group]
        row = np.arange(n)
        # small parts, and parts without following words: one block each
        bare = np.bincount(group, count)[group] == 0
        small = np.flatnonzero((sized > 1) & ((sized <= WHOLE) | bare))
        # large parts: a block for each second word
        large = np.flatnonzero((sized > WHOLE) & ~bare)
        owner = np.repeat(large, count[large])
        step = np.arange(owner.size) - np.repeat(np.cumsum(count[large]) - count[large], count[large])
        where = start[owner] + 2 * step
        code = data[where].astype(np.int64) | (data[where + 1].astype(np.int64) << 8)
        block = np.concatenate((group[small].astype(np.int64) << 16, (group[owner].astype(np.int64) << 16) | 0x8000 | (code >> 1)))
        member = np.concatenate((row[small], owner))
        low = np.concatenate((rec["low"][small] > 0, (code & 1) > 0))
        if not member.size:
            return
        order = np.lexsort((rec["size"][member], block))
        block, member, low = block[order], member[order], low[order]
        _, block, members = np.unique(block, return_inverse=True, return_counts=True)
        keep = members[block] > 1
        a, b = block_pairs(rec, sig, member[keep], block[keep].astype(np.int64), low[keep])
        if a.size:
            x, y = rec["key"][a], rec["key"][b]
            pair = np.unique(np.stack((tab[a], np.minimum(x, y), np.maximum(x, y))), axis=1)
            pair = pair[:, pair[1] < pair[2]]
            if pair.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(pair[0].astype(np.int32)), pa.array(pair[1]), pa.array(pair[2])], ["tab", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def join(pieces):
            shift = np.cumsum([0, *(p[3][-1] for p in pieces)])
            ends = np.concatenate([p[3][:-1] + s for p, s in zip(pieces, shift)] + [shift[-1:]])
            return np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces]), np.concatenate([p[2] for p in pieces]), ends

        for batch in batches:
            if not batch.num_rows:
                continue
            data, ends = _blob(batch.column(2))
            held.append((batch.column(1).to_numpy(), batch.column(0).to_numpy().astype(np.int64), data, ends))
            rows += batch.num_rows
            if rows >= 2 * PART_ROWS and held[-1][0][0] != held[-1][0][-1]:
                part, tab, data, ends = join(held)
                cut = int(np.searchsorted(part, part[-1]))
                yield from work(part[:cut], tab[:cut], data[: ends[cut]], ends[: cut + 1])
                held = [(part[cut:], tab[cut:], data[ends[cut] :], ends[cut:] - ends[cut])]
                rows = part.size - cut
        if held:
            yield from work(*join(held))

    return run


def _verify(share: Fraction):
    """Keep the pairs whose word sets reach the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            (da, ea), (db, eb) = _blob(batch.column(3)), _blob(batch.column(4))
            na, nb = np.diff(ea) // WIDTH, np.diff(eb) // WIDTH
            words = np.concatenate((_unpack(da), _unpack(db)))
            pair = np.concatenate((np.repeat(np.arange(n), na), np.repeat(np.arange(n), nb)))
            order = np.lexsort((words, pair))
            words, pair = words[order], pair[order]
            same = (words[1:] == words[:-1]) & (pair[1:] == pair[:-1])
            both = np.bincount(pair[1:][same], minlength=n)
            ok = both * share.denominator >= share.numerator * (na + nb - both)
            out = batch.select([0, 1, 2]).filter(pa.array(ok))
            sim = both[ok] / np.maximum(na + nb - both, 1)[ok]
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sim)], ["tab", "a", "b", "similarity"])

    return run


class NearDuplicates:
    """The classes of equal word sets and the links between them.

    ``rows``: ``tab, key, text, sa, sb`` of every record that takes part (``sa, sb``
    name its class, ``text`` its string). ``classes``: ``tab, sa, sb, rep,
    copies``. ``links``: ``tab, a, b, similarity``, pairs of class
    representatives at or above the limit. Everything is written to scratch once.
    """

    def __init__(self, df: DataFrame, least: int = 14, share: Fraction = Fraction(7, 10), seeds: int = 5):
        """``df``: ``tab`` int, ``key`` long, ``text`` string. Records of different ``tab`` are never compared."""
        spark = df.sparkSession
        self.scratch = Scratch(spark, "neardup")
        share = Fraction(share)
        source = df.select(F.col("tab").cast("int"), F.col("key").cast("long"), F.xxhash64("text").alias("string"), "text").where("tab is not null and key is not null and text is not null")
        self.seed = 0
        while True:
            all_ = self.scratch.save(spread(source).mapInArrow(_word_sets(least, self.seed), "tab int, key long, text long, sa long, sb long, words binary"), "sets")
            words = all_.where("tab is null").groupBy("sa").agg(F.min("words").alias("lo"), F.max("words").alias("hi"))
            if words.where("lo <> hi").isEmpty():
                break
            self.scratch.drop(all_)
            self.seed += 1
            if self.seed == seeds:
                raise RuntimeError(f"{seeds} seeds in a row gave two words one hash of 64 bits")
        sets = all_.where("tab is not null")
        self.rows = sets.select("tab", "key", "text", "sa", "sb").distinct()
        name = ["tab", "sa", "sb"]
        self.classes, seen = self.scratch.counted(self.rows.groupBy(name).agg(F.min("key").alias("rep"), F.countDistinct("key").alias("copies")), "classes", total=F.sum("copies"))
        # records that another one stands for
        more = self.classes.where("copies > 1")
        spare, seen = self.scratch.counted(self.rows.join(more, name).where("key <> rep").select("tab", "key").distinct(), "spare")
        one = sets.select("tab", "key", "words")
        if seen["rows"]:
            one = one.join(F.broadcast(spare) if seen["rows"] <= BROADCAST_ROWS else spare, ["tab", "key"], "left_anti")
        # the commonest words, at most ORDERED_WORDS of them, by a bound on their number: total words / count
        counts = sets.select("words").mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        total = sets.select(F.sum(F.length("words"))).first()[0] or 0
        common = counts.where(F.col("n") > total // WIDTH // ORDERED_WORDS + 1).toArrow()
        word, n = common["word"].to_numpy().astype(np.int64).view(np.uint64), common["n"].to_numpy().astype(np.int64)
        order = np.argsort(word)
        held = spark.sparkContext.broadcast((word[order], n[order]))
        sent = one.mapInArrow(_send(held, share), "tab int, part long, record binary")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        pairs = sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_compare(share), "tab int, a long, b long")
        pairs = self.scratch.save(pairs.distinct(), "candidates")
        # exact check, with the words of candidates only
        ends = pairs.select("tab", F.col("a").alias("key")).union(pairs.select("tab", F.col("b").alias("key"))).distinct()
        ends, seen = self.scratch.counted(ends, "ends")
        wanted = sets.select("tab", "key", "words").join(F.broadcast(ends) if seen["rows"] <= BROADCAST_ROWS else ends, ["tab", "key"], "left_semi").dropDuplicates(["tab", "key"])
        left = wanted.select("tab", F.col("key").alias("a"), F.col("words").alias("wa"))
        right = wanted.select("tab", F.col("key").alias("b"), F.col("words").alias("wb"))
        checked = pairs.join(left, ["tab", "a"]).join(right, ["tab", "b"]).select("tab", "a", "b", "wa", "wb")
        self.links = self.scratch.save(checked.mapInArrow(_verify(share), "tab int, a long, b long, similarity double"), "links")

    def pairs(self) -> DataFrame:
        """``tab, key_a, key_b``: pairs of rows.

        All different texts are paired. Of one identical text, up to ``COPIES``
        rows stand for it in full; each further copy is paired with the first,
        by which it has the same links.
        """
        name = ["tab", "sa", "sb"]
        member = self.rows.join(self.classes.select(*name, "rep", "copies"), name)
        single = member.where("copies = 1").select("tab", "rep", "key")
        # the limit runs before the shuffle, so a hot text sends at most COPIES rows per task
        by_text = Window.partitionBy(*name, "text").orderBy("key")
        several = self.rows.withColumn("copy", F.row_number().over(by_text)).where(F.col("copy") <= COPIES).join(self.classes.where("copies > 1"), name)
        kept = self.scratch.save(several.select("tab", "rep", "text", "key", "copy"), "kept")
        ends = self.scratch.save(single.union(kept.select("tab", "rep", "key")), "ends")
        a, b = ends.select("tab", F.col("rep").alias("a"), F.col("key").alias("x")), ends.select("tab", F.col("rep").alias("b"), F.col("key").alias("y"))
        across = self.links.select("tab", "a", "b").join(a, ["tab", "a"]).join(b, ["tab", "b"]).select("tab", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))
        # inside a class: chunks of it against all of it
        cut = kept.join(kept.groupBy("tab", "rep").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), ["tab", "rep"])
        p = cut.select("tab", "rep", F.col("key").alias("key_a"), F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("chunk"))
        q = cut.select("tab", "rep", F.col("key").alias("key_b"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        inside = p.join(q, ["tab", "rep", "chunk"]).where("key_a < key_b").select("tab", "key_a", "key_b")
        far = self._beyond(kept)
        return across.union(inside).union(far)

    def _beyond(self, kept: DataFrame) -> DataFrame:
        """Copies beyond the limit with the first row of their text."""
        full = kept.where(F.col("copy") == COPIES).select("tab", "rep", "text")
        first = kept.where("copy = 1").join(full, ["tab", "rep", "text"], "left_semi").select("tab", "rep", "text", F.col("key").alias("first"))
        rows = self.rows.join(self.classes.where(F.col("copies") > COPIES), ["tab", "sa", "sb"]).select("tab", "rep", "text", "key")
        rest = rows.join(first, ["tab", "rep", "text"]).join(kept.select("tab", "rep", "text", "key"), ["tab", "rep", "text", "key"], "left_anti")
        return rest.select("tab", F.col("first").alias("key_a"), F.col("key").alias("key_b"))

    def members(self) -> DataFrame:
        """One row per record: ``tab, key, class_id`` (its representative), ``copies`` and ``links`` to other classes."""
        ends = self.links.select("tab", F.col("a").alias("rep")).union(self.links.select("tab", F.col("b").alias("rep")))
        degree = ends.groupBy("tab", "rep").agg(F.count("*").alias("links"))
        found = self.rows.select("tab", "key", "sa", "sb").distinct().join(self.classes, ["tab", "sa", "sb"]).join(degree, ["tab", "rep"], "left")
        return found.select("tab", "key", F.col("rep").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))

"""Suffix-array dedup: byte strings that an earlier document holds too.

Every byte covered by a string of ``SPAN`` bytes that also starts in a document
with a smaller id is removed. Strings are judged on the input.

Sorting all suffixes would move each byte fifty times, so only suffixes that
can matter are sorted:

1. *Anchors.* Of the ``SPAN - KMER + 1`` k-mers of a string, the one of least
   hash is its anchor: equal strings have equal anchors at equal places. The
   strings of a run with one anchor form a *segment*, about 18 strings on
   average. Every bucket of documents asks (``askshare``), once for each
   distinct anchor, whether it occurs in other documents.
2. *Sorted runs.* A suffix begins at its anchor; what stands before the anchor
   follows in reverse, so strings of one anchor sort next to each other and
   share long prefixes. A bucket sorts its distinct segments, front-codes them
   (length of the prefix shared with the one before, and the rest) and deals
   the run out by key ranges. (The segments of an anchor never part: range ends
   are shorter than an anchor.) Where all segments of an anchor in a range are
   equal, one suffix stands for the segment; otherwise the range tells each of
   its strings apart.
3. *Merge.* A range merges its runs into one order (a suffix array) and keeps
   for every segment the prefix length it shares with the one before. Segments
   share the first p bytes from their anchor on if no length between them is
   below p; another order, of the bytes before the anchors, tells the same of
   these. A string is a beginning of the one and of the other, so the strings
   of mixed anchors are told apart, place by place, by two numbers, and never
   written out. Equal suffixes learn the smallest document among them.
4. *Removal.* Buckets get those answers for their segments and strings back.

An anchor that seems shared, or mixed, by a clash of hashes only costs work.
Segments are told apart by 64 bits of hash; the merge compares bytes.

Defined cases: null text is empty; texts under ``SPAN`` bytes lose nothing;
rows that repeat an id don't remove each other's bytes; a null id counts as
smaller than all others. Texts of any length are handled piece by piece. Other
columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import askshare, wordhash as W
from .common import BUCKET_BYTES, cut, dealt, id_in, id_out, text_bytes, texts

SPAN = 50
KMER = 28
WINDOW = SPAN - KMER + 1
#: Longest key: a segment of one anchor, and a last byte, never zero, that
#: tells how much of the key stands before the anchor (more for WHOLE).
LONGEST = SPAN + WINDOW
#: Text whose suffixes one key range is meant to merge.
RANGE_BYTES = 16 << 20
RUN_ROWS = 1 << 18
#: Text whose segments are found at once: its arrays fit a processor's cache.
SLICE_BYTES = 1 << 19
WHOLE = 127               # the place of a suffix that stands for its segment

_U64 = np.uint64
_ODD = _U64(0xD6E8FEB86659FD93)
_HIGH, _LOW = _U64(0xFFFFFFFF00000000), _U64(0xFFFFFFFF)


def _piece(data: np.ndarray, first: int, last: int) -> tuple[np.ndarray, ...]:
    """For the strings that start in first..last-1: the k-mers' hashes, each
    string's anchor, and the prefix sums of the bytes."""
    part = data[first:last + SPAN - 1]
    n = len(part)
    sums = W.prefix_sums(part)
    _, down = W._powers_to(n)
    kmers = (sums[KMER:] - sums[:-KMER]) * down[:n - KMER + 1]
    # The high bits depend on all bytes; the low ones give way to the place.
    least = (kmers * _ODD & _HIGH) | np.arange(len(kmers), dtype=_U64)
    width = 1
    while width * 2 <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    count = last - first
    least = np.minimum(least[:count], least[WINDOW - width:WINDOW - width + count])
    return kmers, (least & _LOW).astype(np.int64), sums


def _segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document (index), begin, end, anchor's hash, own hash and anchor's place
    of all segments."""
    docs, begins, ends, anchors, hashes, places = [], [], [], [], [], []
    lengths = np.diff(offsets)
    lo, end = 0, len(data)
    while end - lo >= SPAN:
        hi = min(end - SPAN + 1, lo + 2 * SLICE_BYTES)   # string starts lo..hi-1
        kmers, anchor, sums = _piece(data, lo, hi)
        # Strings that cross a document's end don't count.
        i, j = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
        inside = np.zeros(hi - lo + 1, np.int32)
        a = np.clip(offsets[i:j] - lo, 0, hi - lo)
        b = np.clip(offsets[i:j] + np.maximum(lengths[i:j] - SPAN + 1, 0) - lo, 0, hi - lo)
        np.add.at(inside, a, 1)
        np.add.at(inside, np.maximum(a, b), -1)
        inside = np.cumsum(inside[:-1]) > 0
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        begin = np.flatnonzero(new)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
        stop = np.flatnonzero(last) + SPAN
        docs.append(np.searchsorted(offsets, begin + lo, "right") - 1)
        begins.append(begin + lo)
        ends.append(stop + lo)
        anchors.append(W.mix(kmers[anchor[begin]]))
        places.append(anchor[begin] - begin)
        hashes.append(W.mix(W.span_hash(sums, begin, stop) + (stop - begin).astype(_U64)))
        lo = hi
    if not docs:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, _U64), np.zeros(0, _U64), none
    return tuple(np.concatenate(x) for x in (docs, begins, ends, anchors, hashes, places))


def _bucket(docs: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a bucket: index of the first document, bytes, offsets, ids."""
    ids = docs["doc_id"].to_numpy(zero_copy_only=False)
    data, offsets = W.text_buffer(texts(docs["text"]))
    for i, j in W.slices(offsets, SLICE_BYTES):
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ids[i:j]


def _least_most(group: np.ndarray, n: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(group, kind="stable")
    first = np.searchsorted(group[order], np.arange(n))
    return np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)


# -- 1: anchors -----------------------------------------------------------------

def _ask(docs: pa.Table, n_parts: int) -> pa.Table:
    keys, ids = [], []
    for _, data, offsets, doc_ids in _bucket(docs):
        doc, _, _, anchor, _, _ = _segments(data, offsets)
        keys.append(_anchor_ids(anchor, n_parts))
        ids.append(doc_ids[doc])
    key, ids = np.concatenate(keys), np.concatenate(ids)
    if not len(key):
        return askshare.empty_ask()
    order = np.argsort(key)
    key, ids = key[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    many = (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)).astype(np.uint8)
    key = key[first]
    return askshare.pack((key >> _U64(32)).astype(np.int32), int(docs["bucket"][0].as_py()),
                         [key.astype(np.uint32), many])


def _anchor_ids(anchor: np.ndarray, n_parts: int) -> np.ndarray:
    part = askshare.part_of(anchor, n_parts).astype(_U64)
    return (part << _U64(32)) | (anchor & _LOW)


def _answer(asked: pa.Table) -> pa.Table:
    """Shared anchors, for each bucket (which asks for an anchor once)."""
    buckets, (low, many) = askshare.unpack(asked, [np.uint32, np.uint8])
    part = _U64(asked["part"][0].as_py()) << _U64(32)
    _, group, counts = np.unique(low, return_inverse=True, return_counts=True)
    shared = (counts > 1) | (np.bincount(group, many, len(counts)) > 0)
    reply = shared[group]
    return askshare.answer(buckets[reply], [part | low[reply].astype(_U64)])


# -- 2: sorted, front-coded runs --------------------------------------------------

def _keys(source: np.ndarray, right_at: np.ndarray, right: np.ndarray, left_at: np.ndarray, step: int,
          left: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Keys in rows of ``LONGEST`` bytes, filled up with zeros: ``right`` bytes
    from ``right_at`` on, ``left`` bytes from ``left_at`` on by ``step``, and
    the code."""
    out = np.zeros((len(right), LONGEST), np.uint8)
    column = np.arange(LONGEST)
    for lo in range(0, len(out), 1 << 15):
        rows = slice(lo, lo + (1 << 15))
        m, n = right[rows, None], (left + right)[rows, None]
        at = np.where(column < m, right_at[rows, None] + column, left_at[rows, None] + step * (column - m))
        out[rows] = np.where(column < n, source[np.clip(at, 0, len(source) - 1)], 0)
    out[np.arange(len(out)), left + right] = code
    return out


def _suffixes(docs: pa.Table, answers: pa.Table, n_parts: int):
    """Distinct shared segments of a bucket: key, hash, whether several
    documents have it, bytes before the anchor and smallest document."""
    (told,) = askshare.read_answers(answers, [_U64])
    told = np.sort(told)
    hashes, ids, keys, of, lefts = [], [], [], [], []
    seen = np.zeros(0, _U64)
    for _, data, offsets, doc_ids in (_bucket(docs) if len(told) else ()):
        doc, begin, end, anchor, seg, place = _segments(data, offsets)
        anchor = _anchor_ids(anchor, n_parts)
        at = np.searchsorted(told, anchor)
        at[at == len(told)] = 0
        held = np.flatnonzero(told[at] == anchor)
        hashes.append(seg[held])
        ids.append(doc_ids[doc[held]])
        _, once = np.unique(seg[held], return_index=True)
        once = held[once]
        once = once[~np.isin(seg[once], seen)]
        seen = np.concatenate((seen, seg[once]))
        left, middle = place[once], begin[once] + place[once]
        keys.append(_keys(data, middle, end[once] - middle, middle - 1, -1, left,
                          (left + 1 + WHOLE).astype(np.uint8)))
        of.append(seg[once])
        lefts.append(left.astype(np.uint8))
    if not keys or not sum(map(len, of)):
        return None
    distinct, group = np.unique(np.concatenate(hashes), return_inverse=True)
    low_id, high_id = _least_most(group, len(distinct), np.concatenate(ids))
    of = np.concatenate(of)
    at = np.searchsorted(distinct, of)
    many = (low_id[at] != high_id[at]).astype(np.uint8)
    return np.concatenate(keys), of, many, np.concatenate(lefts), low_id[at]


def front_code(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted keys (rows that end at their last byte that isn't zero): the
    prefix shared with the one before, the length, and the rests in a row."""
    width = keys.shape[1]
    lengths = (width - (keys[:, ::-1] != 0).argmax(axis=1)).astype(np.uint8)
    differ = keys[1:] != keys[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared = np.concatenate(([0], np.minimum(shared, np.minimum(lengths[1:], lengths[:-1])))).astype(np.uint8)
    column = np.arange(width)
    rest = keys[(column >= shared[:, None]) & (column < lengths[:, None])]
    return shared, lengths, rest.tobytes()


def _runs(docs: pa.Table, answers: pa.Table, n_parts: int, ends: list[bytes]) -> pa.Table:
    found = _suffixes(docs, answers, n_parts) if docs.num_rows else None
    if found is None:
        return askshare.empty_ask()
    keys, of, many, left, ids = found
    text = keys.view(f"S{LONGEST}")[:, 0]
    order = np.argsort(text)
    keys, text, of, many, left, ids = (x[order] for x in (keys, text, of, many, left, ids))
    cuts = [0, *np.searchsorted(text, np.array(ends, text.dtype)).tolist(), len(text)]
    packer = zstandard.ZstdCompressor(level=3)
    rows = []
    for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        for lo in range(a, b, RUN_ROWS):
            hi = min(b, lo + RUN_ROWS)
            shared, lengths, rest = front_code(keys[lo:hi])
            body = [of[lo:hi], ids[lo:hi], many[lo:hi], left[lo:hi], shared, lengths]
            rows.append((p, hi - lo, packer.compress(b"".join([*(x.tobytes() for x in body), rest]))))
    parts, n, body = zip(*rows)
    bucket = int(docs["bucket"][0].as_py())
    return pa.table({"part": pa.array(parts, pa.int32()), "bucket": pa.array([bucket] * len(n), pa.int32()),
                     "n": pa.array(n, pa.int32()), "body": pa.array(body, pa.binary())})


# -- 3: the merge -------------------------------------------------------------------

def _decode(shared: np.ndarray, lengths: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Keys of a front-coded run, in rows: a byte comes from the last key that
    doesn't share its column with the one before."""
    n = len(shared)
    out = np.zeros((n, LONGEST), np.uint8)
    row = np.arange(n)
    sent = lengths.astype(np.int64) - shared
    begin = np.cumsum(sent) - sent - shared
    for c in range(int(lengths.max(initial=0))):
        from_row = np.maximum.accumulate(np.where(shared <= c, row, 0))
        held = np.flatnonzero(lengths > c)
        out[held, c] = rest[begin[from_row[held]] + c]
    return out


def merged(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys (sorted runs, one after another), and the prefix each
    shares with the one before in it; equal keys share their whole width."""
    width = keys.shape[1]
    order = np.argsort(keys.view(f"S{width}")[:, 0], kind="stable")   # goes from run to run
    shared = np.zeros(len(order), np.uint8)
    for lo in range(1, len(order), 1 << 15):
        rows = keys[order[lo - 1:lo + (1 << 15)]]
        differ = rows[1:] != rows[:-1]
        at = differ.argmax(axis=1)
        shared[lo:lo + len(at)] = np.where(differ[np.arange(len(at)), at], at, width)
    return order, shared


class Run:
    """A front-coded run, decoded as it is consumed: ``head`` is the current
    string (None at the end), ``shared`` its prefix shared with the one
    before."""

    __slots__ = ("shared_all", "lengths", "rest", "at", "i", "head", "shared")

    def __init__(self, shared: list[int], lengths: list[int], rest: bytes):
        self.shared_all, self.lengths, self.rest = shared, lengths, rest
        self.at, self.i, self.head, self.shared = 0, -1, b"", 0
        self.step()

    def step(self) -> None:
        self.i = i = self.i + 1
        if i == len(self.lengths):
            self.head, self.shared = None, -1
            return
        self.shared = shared = self.shared_all[i]
        end = self.at + self.lengths[i] - shared
        self.head = self.head[:shared] + self.rest[self.at:end]
        self.at = end


def merge(runs: list[Run]) -> Iterator[tuple[int, int, bool]]:
    """(run, index in it, equal to the one before) of all strings in order:
    ``merged`` for front-coded runs."""
    if not runs:
        return
    rows = [_decode(np.array(run.shared_all, np.uint8), np.array(run.lengths, np.uint8), np.frombuffer(run.rest, np.uint8))
            for run in runs]
    order, shared = merged(np.concatenate(rows))
    begin = np.cumsum([0, *map(len, rows)])
    of = np.searchsorted(begin, order, "right") - 1
    yield from zip(of.tolist(), (order - begin[of]).tolist(), (shared == LONGEST).tolist())


class _Sent:
    """The columns of one row of a run: hashes, smallest documents, flags,
    bytes before the anchor, and the keys, decoded."""

    def __init__(self, n: int, body: bytes):
        self.n = n
        self.of, self.ids = np.frombuffer(body, _U64, n), np.frombuffer(body, np.int64, n, 8 * n)
        self.many, self.left, shared, self.lengths = (
            np.frombuffer(body, np.uint8, n, (16 + i) * n) for i in range(4))
        self.keys = _decode(shared, self.lengths, np.frombuffer(body, np.uint8, offset=20 * n))

    def anchors(self) -> np.ndarray:
        """Hashes of the anchors' bytes: every key starts with its anchor."""
        out = np.zeros(self.n, _U64)
        for word in np.ascontiguousarray(self.keys[:, :KMER]).view("<u4").T:
            out = W.mix(out * _ODD + word.astype(_U64))
        return out


def _mixed(sent: list[_Sent]) -> np.ndarray:
    """Of every segment, whether its anchor has other segments too. (Anchors of
    one hash count as one: their segments are split without need.)"""
    anchor, of = np.concatenate([x.anchors() for x in sent]), np.concatenate([x.of for x in sent])
    order = np.argsort(anchor)
    anchor, of = anchor[order], of[order]
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    first = np.flatnonzero(new)
    differ = np.minimum.reduceat(of, first) != np.maximum.reduceat(of, first)
    out = np.empty(len(order), bool)
    out[order] = differ[np.cumsum(new) - 1]
    return out


def _least_of(group: np.ndarray, ids: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row the smallest document of its group, and whether the group
    has several rows or is in several documents."""
    order = np.argsort(group)
    group = group[order]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.concatenate((first, [len(order)])))
    least, tell = np.empty(len(order), np.int64), np.empty(len(order), bool)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], first), size)
    tell[order] = np.repeat(size, size) > 1
    return least, tell | many


def _merge_range(rows: pa.Table) -> pa.Table:
    unpacker = zstandard.ZstdDecompressor()
    sent = [_Sent(n, unpacker.decompress(body)) for n, body in zip(rows["n"].to_pylist(), rows["body"].to_pylist())]
    split = _mixed(sent)
    keys = np.concatenate([x.keys for x in sent])
    order, shared = merged(keys)
    keys, split = keys[order], split[order]
    of, ids, many, before, lengths = (np.concatenate(x)[order] for x in zip(
        *((x.of, x.ids, x.many > 0, x.left.astype(np.int64), x.lengths.astype(np.int64)) for x in sent)))
    buckets = np.repeat(rows["bucket"].to_numpy(), [x.n for x in sent])[order]
    del sent
    right = lengths - 1 - before
    told: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []   # segment, smallest document, place

    def tell(held: np.ndarray, group: np.ndarray, place: np.ndarray) -> None:
        if len(held):
            least, some = _least_of(group, ids[held], many[held])
            told.append((held[some], least[some], place[some]))

    held = np.flatnonzero(~split)
    tell(held, np.cumsum(shared < LONGEST)[held], np.full(len(held), WHOLE))
    cut = np.flatnonzero(split)
    left_order, left_shared = merged(_lefts(keys, cut, right, before))
    del keys
    left_of = np.empty(len(cut), np.int64)
    for m in range(WINDOW if len(cut) else 0):
        # The strings with m bytes before the anchor, one of each segment at most.
        some = np.flatnonzero((before[cut] >= m) & (SPAN - right[cut] <= m))
        left_of[left_order] = np.cumsum(left_shared < m)
        held = cut[some]
        tell(held, np.cumsum(shared < SPAN - m)[held] << 32 | left_of[some], before[held] - m)
    seg, least, place = (np.concatenate(x) for x in zip(*told))
    # Neighbouring strings of a segment with one smallest document go together.
    rank = np.empty(len(of), np.int64)
    rank[np.lexsort((of, buckets))] = np.arange(len(of))
    order = np.argsort(rank[seg] << 8 | place)
    seg, least, place = seg[order], least[order], place[order]
    buckets, of = buckets[seg], of[seg]
    if not len(order):
        return askshare.answer(buckets, [of, least, place.astype(np.uint8), place.astype(np.uint8)])
    new = np.ones(len(order), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (least[1:] != least[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(order)])) - 1
    return askshare.answer(buckets[first], [of[first], least[first], place[first].astype(np.uint8),
                                            place[last].astype(np.uint8)])


def _lefts(keys: np.ndarray, which: np.ndarray, right: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The bytes before the anchors of some keys, as they stand there (in
    reverse), filled up with zeros."""
    out = np.zeros((len(which), WINDOW - 1), np.uint8)
    column = np.arange(WINDOW - 1)
    for lo in range(0, len(out), 1 << 15):
        row = which[lo:lo + (1 << 15)]
        inside = column < before[row, None]
        at = np.where(inside, right[row, None] + column, 0)
        out[lo:lo + (1 << 15)] = np.where(inside, keys[row[:, None], at], 0)
    return out


# -- 4: removal -----------------------------------------------------------------------

_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(docs: pa.Table, answers: pa.Table, texts_too: bool) -> pa.Table:
    out = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    of, least, first, last = askshare.read_answers(answers, [_U64, np.int64, np.uint8, np.uint8])
    order = np.argsort(of, kind="stable")
    of, least = of[order], least[order]
    first, last = first[order].astype(np.int64), last[order].astype(np.int64)
    for _, data, offsets, ids in (_bucket(docs) if docs.num_rows else ()):
        doc, begin, end, _, seg, _ = _segments(data, offsets)
        lo, hi = np.searchsorted(of, seg, "left"), np.searchsorted(of, seg, "right")
        n = hi - lo
        which = np.repeat(np.arange(len(seg)), n)
        told = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        later = ids[doc[which]] > least[told]
        which, told = which[later], told[later]
        whole = first[told] == WHOLE
        a = begin[which] + np.where(whole, 0, first[told])
        b = np.where(whole, end[which], begin[which] + last[told] + SPAN)
        cover = np.bincount(a, minlength=len(data) + 1) - np.bincount(b, minlength=len(data) + 1)
        gone = np.cumsum(cover[:-1]) > 0
        total = np.concatenate(([0], np.cumsum(gone)))
        new = gone.copy()
        new[1:] &= ~gone[:-1]
        starts = offsets[:-1][offsets[:-1] < len(data)]
        new[starts] = gone[starts]
        spans = np.concatenate(([0], np.cumsum(new)))
        raw = data.tobytes()
        for k, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            removed = int(total[y] - total[x])
            kept = data[x:y][~gone[x:y]].tobytes() if removed else raw[x:y]
            out["doc_id"].append(int(ids[k]))
            out["n_bytes"].append(y - x)
            out["n_removed"].append(removed)
            out["n_spans"].append(int(spans[y] - spans[x]))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept if texts_too else None)
    kinds = {"kept_sha256": pa.string(), "kept": pa.binary()}
    return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})


def _range_ends(rows: DataFrame, n_rows: int, n_ranges: int) -> list[bytes]:
    """Ends of key ranges, from a sample of places in the texts; at most a
    million of them reach the driver."""
    if n_ranges < 2 or not n_rows:
        return []
    wanted = min(64 * n_ranges, 1_000_000)
    place = F.expr("cast(1 + pmod(xxhash64(doc_id), greatest(1, length(text) - 60)) AS int)")
    sample = (rows.filter("octet_length(text) >= 60").sample(min(1.0, wanted / n_rows), seed=1)
              .select(F.substring("text", place, F.lit(24)).alias("s")))
    found = sorted(r["s"].encode()[:KMER - 4] for r in sample.collect())
    return sorted({found[len(found) * i // n_ranges] for i in range(1, n_ranges)}) if found else []


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` and ``kept`` (the bytes left) of every row. A kept
    text may end inside a character."""
    rows = docs.select(id_in(F.col(doc_id)).alias("doc_id"), F.col(text).alias("text"))
    size = text_bytes(rows)
    n_parts = max(1, math.ceil(size / 16 / askshare.RANGE_KEYS))
    n_ranges = max(1, math.ceil(size / RANGE_BYTES))
    ends = _range_ends(rows, rows.count(), n_ranges)
    sent = dealt(rows, max(1, math.ceil(size / BUCKET_BYTES)))
    by_bucket = sent.groupBy("bucket")
    asked = by_bucket.applyInArrow(lambda t: _ask(t, n_parts), askshare.ASK_SCHEMA)
    shared = asked.groupBy("part").applyInArrow(_answer, askshare.ANSWER_SCHEMA)
    runs = by_bucket.cogroup(shared.groupBy("bucket")).applyInArrow(
        lambda d, a: _runs(d, a, n_parts, ends), askshare.ASK_SCHEMA)
    found = runs.groupBy("part").applyInArrow(_merge_range, askshare.ANSWER_SCHEMA)
    out = by_bucket.cogroup(found.groupBy("bucket")).applyInArrow(
        lambda d, a: _remove(d, a, with_text), _SCHEMA)
    return out.withColumn("doc_id", id_out(F.col("doc_id")))


def digest(docs: DataFrame, **how) -> DataFrame:
    """The digest columns of every row."""
    return repeated_spans(docs, with_text=False, **how).drop("kept")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS id,
         encode(coalesce(text, '')) AS b FROM documents),
strings AS (
  SELECT r, id, i, array_slice(b, i, i + 49) AS s
  FROM (SELECT r, id, b, unnest(range(1, octet_length(b) - 48)) AS i FROM d)),
firsts AS (SELECT s, min(id) AS first FROM strings GROUP BY s HAVING count(*) > 1),
hits AS (SELECT r, i FROM strings JOIN firsts USING (s) WHERE id > first),
marked AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 AS goes_on FROM hits),
runs AS (SELECT r, i, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run FROM marked),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS z FROM runs GROUP BY r, run),
pieces AS (
  SELECT r, z AS a, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a), octet_length(b) + 1) AS z, b
  FROM (SELECT r, a, z FROM spans UNION ALL SELECT r, 0, 1 FROM d) JOIN d USING (r)),
kept AS (
  SELECT r, sum(z - a) AS n_kept, count(*) - 1 AS n_spans,
         string_agg(CASE WHEN z > a THEN hex(array_slice(b, a, z - 1)) ELSE '' END, '' ORDER BY a) AS h
  FROM pieces GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(octet_length(b) - n_kept AS BIGINT) AS n_removed,
       CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM d JOIN kept USING (r)
"""

"""SentencePiece encoding and decoding of a BPE model, by vectorised merge rounds.

The driver reads the model file once and sends its tables (pieces, the scores
of all pairs that merge; their size is the vocabulary's) to the tasks. A task
takes its texts in chunks of bounded size. A chunk's words (a word begins at a
run of blanks) are made distinct, and all distinct words are encoded together:

1. one flat array holds the symbols of all words, another the rank of the pair
   that begins at each symbol (by falling score, none: no such piece);
2. every word's least rank is found by a segmented minimum;
3. all pairs of that rank merge at once, from the left, without overlap;
4. merged symbols are closed up, ranks beside them are looked up again, and
   words without a pair leave; until no pair remains.

The library merges one pair at a time, the best one first and of equal ones the
leftmost. Merging all pairs of a word's least rank at once is the same, unless
a new pair is as good as or better than the one just merged (pieces of equal
score, or a piece that is older than its parts). Such a merge is the last of
its word in that round, so the next round sees the new pair.

Words are independent where no piece holds a blank after another character;
with other models a whole text is one word. Very long runs of blanks are cut
into the longest pieces of blanks beforehand, where merging from the left gives
just these (see ``_blanks``).

Models: BPE with byte fallback, identity normalisation and no user-defined or
unused pieces; others raise ``ValueError``.

Defined cases: a null or empty text has no ids and decodes to an empty text;
texts of any length are encoded whole; repeated rows and null ids give one row
each; empty tables give no rows. Only the id and the text column are read, so
other columns, whatever their names, don't matter. A null list of ids decodes
to null; ids out of range raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

BLANK = "▁"
NO_RANK = np.iinfo(np.int32).max
_CODES = 0x110000


@dataclass
class Model:
    """Tables of a model; symbols are piece ids, then characters that only
    occur inside pieces, then ``base`` + code point for all other characters."""
    pieces: list[bytes]          # text of a piece in a decoded text
    is_byte: np.ndarray          # value of a byte piece, else -1
    byte_id: np.ndarray          # id of the piece of each byte
    blank_first: np.ndarray      # pieces that begin with a blank
    leading: bool                # a blank is put in front, and taken off again
    n_pieces: int
    base: int
    chars: np.ndarray            # sorted code points that have a symbol
    char_symbol: np.ndarray
    pair: np.ndarray             # sorted left * (base + _CODES) + right
    pair_symbol: np.ndarray
    pair_rank: np.ndarray
    by_word: bool
    blanks: int                  # longest piece of a cut run of blanks, or 0


def read_model(path: str) -> Model:
    """The tables of the model file (driver side)."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, kinds = proto.normalizer_spec, pb.ModelProto.SentencePiece
    types = [p.type for p in proto.pieces]
    if (proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback
            or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
            or proto.trainer_spec.treat_whitespace_as_suffix
            or set(types) - {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}):
        raise ValueError("needs a BPE model with byte fallback, identity normalisation and plain pieces")
    normal = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
    symbol = {piece: i for piece, (i, _) in normal.items()}
    n = len(proto.pieces)
    for c in sorted({c for piece in normal for c in piece} - symbol.keys()):
        symbol[c] = n + len(symbol) - len(normal)
    base = n + len(symbol) - len(normal)
    scores = sorted({s for _, s in normal.values()}, reverse=True)
    order = {s: k for k, s in enumerate(scores)}
    pairs = sorted((symbol[p[:k]] * (base + _CODES) + symbol[p[k:]], i, order[s])
                   for p, (i, s) in normal.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol)
    key, made, rank = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 3
    chars = sorted((ord(c), i) for c, i in symbol.items() if len(c) == 1)
    by_word = not any(BLANK in p.lstrip(BLANK) for p in normal)
    is_byte, byte_id, texts = np.full(n, -1, np.int16), np.zeros(256, np.int64), []
    for i, (p, t) in enumerate(zip(proto.pieces, types)):
        texts.append(p.piece.replace(BLANK, " ").encode() if t == kinds.NORMAL else b"")
        if t == kinds.BYTE:
            is_byte[i] = int(p.piece[3:5], 16)
            byte_id[is_byte[i]] = i
            texts[i] = bytes([is_byte[i]])
        elif t == kinds.UNKNOWN:
            texts[i] = proto.trainer_spec.unk_surface.encode()
    blank_first = np.array([t == kinds.NORMAL and p.piece.startswith(BLANK) for p, t in zip(proto.pieces, types)])
    m = Model(texts, is_byte, byte_id, blank_first, norm.add_dummy_prefix, n, base,
              np.array([c for c, _ in chars]), np.array([i for _, i in chars]),
              key, made, rank.astype(np.int32), by_word, 0)
    m.blanks = _blanks(m, normal)
    return m


def _blanks(m: Model, normal: dict[str, tuple[int, float]]) -> int:
    """The length by which long runs of blanks may be cut from the left, or 0.

    It is that of the longest piece of blanks, where all such pieces share one
    score, all other pieces with a leading blank are better, and that many
    blanks end as the one piece. Then only the last blank of a run can go
    elsewhere, all others merge from the left, and as long as the first ones
    aren't that piece, the leftmost pair is among them."""
    runs = {p: s for p, (_, s) in normal.items() if set(p) == {BLANK} and len(p) > 1}
    others = [s for p, (_, s) in normal.items() if p.startswith(BLANK) and len(p) > 1 and p not in runs]
    longest = max(map(len, runs), default=0)
    if (not m.by_word or len(set(runs.values())) != 1 or min(others, default=1) <= min(runs.values())
            or any(p.startswith(BLANK * 2) for p in normal if p not in runs)):
        return 0
    whole, _ = merge_rounds(m, np.full(longest, normal[BLANK][0]), np.zeros(longest, np.int64))
    return longest if len(whole) == 1 else 0


def _ranks(m: Model, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and symbol of each pair; ``NO_RANK`` where the two don't merge."""
    key = left * (m.base + _CODES) + right
    at = np.minimum(np.searchsorted(m.pair, key), len(m.pair) - 1) if len(m.pair) else np.zeros(len(key), np.int64)
    found = m.pair[at] == key if len(m.pair) else np.zeros(len(key), bool)
    return (np.where(found, m.pair_rank[at], NO_RANK), m.pair_symbol[at]) if len(m.pair) else (
        np.full(len(key), NO_RANK, np.int32), at)


def merge_rounds(m: Model, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols left after all merges, and the word of each, in order. ``word``
    never falls."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank, made = _pairs(m, sym, word, np.arange(len(sym)))
    while len(sym):
        begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[begin, len(sym)])
        least = np.minimum.reduceat(rank, begin)
        if (least == NO_RANK).any():          # words without a pair leave
            live = np.repeat(least != NO_RANK, size)
            done.append((sym[~live], word[~live]))
            sym, word, rank, made = sym[live], word[live], rank[live], made[live]
            size, least = size[least != NO_RANK], least[least != NO_RANK]
            if not len(sym):
                break
        # Pairs of the least rank, every other one of each run of them. A
        # word's last symbol begins no pair, so runs end with their word.
        hit = rank == np.repeat(least, size)
        at = np.flatnonzero(hit)
        first = np.r_[True, np.diff(at) > 1]
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[nth % 2 == 0]
        new, of = made[at], rank[at]
        # The pairs that each merge makes when it is its turn.
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(sym) - 1)
        left = sym[before]
        touching = np.r_[False, at[1:] - at[:-1] == 2]
        left[touching] = new[np.flatnonzero(touching) - 1]
        better = np.zeros(len(at), bool)
        inner = (at > 0) & (word[before] == word[at])
        better[inner] = _ranks(m, left[inner], new[inner])[0] <= of[inner]
        inner = (at + 2 < len(sym)) & (word[after] == word[at])
        better[inner] |= _ranks(m, new[inner], sym[after][inner])[0] <= of[inner]
        if better.any():                      # no merge after such a one, in its word
            w = word[at]
            seen = np.cumsum(better) - better
            start = np.r_[True, w[1:] != w[:-1]]
            ahead = seen - np.maximum.accumulate(np.where(start, seen, 0))
            at, new = at[ahead == 0], new[ahead == 0]
        sym = sym.copy()
        sym[at] = new
        stale = np.zeros(len(sym), bool)
        stale[at] = True
        stale[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, word, rank, made, stale = sym[keep], word[keep], rank[keep], made[keep], stale[keep]
        where = np.flatnonzero(stale)
        rank[where], made[where] = _pairs(m, sym, word, where)
    if not done:
        return sym, word
    sym, word = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def _pairs(m: Model, sym: np.ndarray, word: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    after = np.minimum(where + 1, len(sym) - 1)
    rank, made = _ranks(m, sym[where], sym[after])
    rank = np.where((where + 1 < len(sym)) & (word[where] == word[after]), rank, NO_RANK)
    return rank.astype(np.int32), made


def _word_starts(m: Model, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Byte offsets at which the words of all texts begin. ``data``: the UTF-8
    bytes of all texts, blanks already written as the blank piece; ``begins``:
    where the texts that aren't empty begin."""
    starts = np.zeros(len(data) + 1, bool)
    starts[begins] = True
    if m.by_word and len(data) > 2:
        a, b, c = BLANK.encode()
        blank = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
        fresh = np.ones(len(blank), bool)
        fresh[1:] = (np.diff(blank) != 3) | starts[blank[1:]]
        starts[blank[fresh]] = True
        if m.blanks and len(blank):
            # The n-th blank of a run of r, where n is a multiple of the
            # longest piece and enough blanks follow.
            of = np.cumsum(fresh) - 1
            run = np.flatnonzero(fresh)
            length = np.diff(np.r_[run, len(blank)])
            nth = np.arange(len(blank)) - run[of]
            starts[blank[(nth % m.blanks == 0) & (length[of] - nth > m.blanks)]] = True
    return np.flatnonzero(starts[:-1])


def _utf8_bytes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of code points, flat, and the number of bytes of each."""
    flat = codes.astype("<u4").tobytes().decode("utf-32-le").encode()
    n = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    return np.frombuffer(flat, np.uint8), n


def encode_words(m: Model, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word, flat, and the offsets of the words in them."""
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
    at = np.minimum(np.searchsorted(m.chars, codes), len(m.chars) - 1)
    sym = np.where(m.chars[at] == codes, m.char_symbol[at], m.base + codes)
    sym, word = merge_rounds(m, sym, np.repeat(np.arange(len(words)), length))
    # Characters that are no piece become their bytes.
    bare = sym >= m.n_pieces
    if bare.any():
        known = sym[bare]
        inside = {int(s): int(c) for c, s in zip(m.chars, m.char_symbol) if s >= m.n_pieces}
        code = np.where(known >= m.base, known - m.base, [inside.get(int(s), 0) for s in known])
        flat, n = _utf8_bytes(code)
        times = np.ones(len(sym), np.int64)
        times[bare] = n
        spread = np.repeat(bare, times)
        sym, word = np.repeat(sym, times), np.repeat(word, times)
        sym[spread] = m.byte_id[flat]
    return sym, np.searchsorted(word, np.arange(len(words) + 1))


def encode_chunk(m: Model, texts: pa.Array) -> tuple[pa.Array, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The words of all texts as dictionary indices: ``(indices, offset of each
    text in them, (ids, offsets) of the distinct words)``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    some = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    texts = pc.replace_substring(texts, " ", BLANK)
    if m.leading:
        texts = pc.if_else(pa.array(some), pc.binary_join_element_wise(pa.scalar(BLANK, pa.large_string()), texts,
                                                                                pa.scalar("", pa.large_string())), texts)
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    starts = _word_starts(m, data, offsets[:-1][some])
    bounds = np.r_[starts, len(data)].astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data.tobytes()))
    coded = words.dictionary_encode()
    return (coded.indices, np.searchsorted(starts, offsets), encode_words(m, coded.dictionary))


def _decode_row(m: Model, ids: np.ndarray) -> str:
    """The library's decoding of any ids: runs of byte pieces are read as UTF-8,
    each byte that belongs to no character becoming the replacement character;
    the first blank of the text goes where the model puts one in front."""
    out, k, at_start = [], 0, m.leading
    while k < len(ids):
        i = int(ids[k])
        if m.is_byte[i] >= 0:
            end = k
            while end < len(ids) and m.is_byte[ids[end]] >= 0:
                end += 1
            run, p = bytes(int(m.is_byte[j]) for j in ids[k:end]), 0
            while p < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[p:p + n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                p += n
            k, at_start = end, False
            continue
        text = m.pieces[i].decode()
        k += 1
        if at_start and text:
            at_start = False
            if m.blank_first[i]:
                text = text[1:]
        out.append(text)
    return "".join(out)


def decode_chunk(m: Model, ids: pa.LargeListArray) -> pa.Array:
    """The text of each list of ids."""
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) and not 0 <= flat.min() <= flat.max() < m.n_pieces:
        raise ValueError(f"ids are from 0 to {m.n_pieces - 1}")
    offsets = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]
    # The first piece with a text: control pieces before it have none.
    first = flat[np.minimum(offsets[:-1], len(flat) - 1)] if len(flat) else np.zeros(len(ids), np.int64)
    plain = (np.diff(offsets) > 0) & (np.array([len(p) for p in m.pieces])[first] > 0)
    cut = plain & m.blank_first[first] & m.leading
    # A second table holds the pieces without their first blank.
    which = flat.copy()
    which[offsets[:-1][cut]] += m.n_pieces
    table = pa.array([*m.pieces, *(p[1:] if b else p for p, b in zip(m.pieces, m.blank_first))], pa.large_binary())
    out = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), table.take(pa.array(which))),
                         pa.scalar(b"", pa.large_binary()))
    slow = (np.diff(offsets) > 0) & ~plain
    try:
        out = out.cast(pa.large_string())
    except pa.ArrowInvalid:        # bytes that are no characters
        slow |= np.add.reduceat(np.r_[m.is_byte[flat] >= 0, False], offsets[:-1]) > 0
        slow &= np.diff(offsets) > 0
        out = pc.if_else(pa.array(slow), pa.scalar(b"", pa.large_binary()), out).cast(pa.large_string())
    if slow.any():
        rows = out.to_pylist()
        for k in np.flatnonzero(slow):
            rows[k] = _decode_row(m, flat[offsets[k]:offsets[k + 1]])
        out = pa.array(rows, pa.large_string())
    return pc.if_else(ids.is_valid(), out, pa.scalar(None, pa.large_string()))


def _sent(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(read_model(path))


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id`` and ``ids`` (array of int)
    of the whole text, without begin or end ids."""
    model = _sent(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in sliced(batches, "text"):
            indices, offsets, (ids, bounds) = encode_chunk(m, batch.column("text"))
            words = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(ids, pa.int32()))
            taken = words.take(indices)
            size = np.r_[0, np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False))]
            lists = pa.ListArray.from_arrays(pa.array(size[offsets], pa.int32()), taken.flatten())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row for each row of ``encoded``: ``doc_id``, ``ids`` and ``decoded``,
    the text of the ids. A null among the ids has no text."""
    model = _sent(encoded, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in sliced(batches, "ids"):
            lists = batch.column("ids")
            text = decode_chunk(m, lists.cast(pa.large_list(pa.int32()))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, text], ["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(doc_id).alias("doc_id"),
                          F.filter(F.col(ids).cast("array<int>"), lambda x: x.isNotNull()).alias("ids"))
    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digest(decoded: DataFrame) -> DataFrame:
    """The digest columns of ``decode``'s rows."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

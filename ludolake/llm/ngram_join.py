"""N-gram Jaccard join: documents linked by the sets of their word shingles.

Two documents link when ``100 * |A & B| >= percent * |A | B|``. The result is
every document's component: the smallest id reachable over links.

Method (token-group matrix, exact):

1. *Ask.* Every bucket of documents asks, for the smallest shingle hashes of
   each set, which of them other sets have too (``askshare``). By the l-prefix
   rule, two sets that link share at least l of those; sets with fewer shared
   ones link with nothing and go no further. Equal sets go on as one.
2. *Partition into groups.* Sets with an equal min-hash form a group, split
   into chunks of ``GROUP_SETS``. Inside a chunk links are found exactly, and
   a set that is connected already is not compared again. Components follow.
3. *Bound.* A second ask keeps only shingles that occur in different
   components. A set whose count of those is below the overlap that any link
   needs is done. What remains is partitioned into groups again (a component,
   or sets with an equal min-hash). The matrix of shingles and groups, on the
   rarest shingles that a link can't avoid, gives each query set the groups
   that may hold a partner in another component.
4. *Open.* A group is opened for a query set only when the overlap with the
   group's union of shingles reaches what a link needs; then its members are
   compared exactly. Components follow again.

No pair list of a group of copies is ever built: members of one component are
never compared. Nothing is capped: the work left for loosely connected large
groups is done in blocks of groups and queries.

Defined cases: null, empty or whitespace text has an empty set, links with
nothing, and is its own component. Fewer words than a shingle: the whole
sequence is one shingle. Rows that repeat a document id are kept, each with
the component of its own text: sets are told apart by their content, ids only
name the components at the end. A null id counts as smaller than all others.
Texts of any length are read whole. Other columns stay as they are, whatever
their names. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import askshare, wordhash as W
from .common import (BUCKET_BYTES, bucket_of, column, cut, dealt, free, id_in, id_out, text_bytes, texts,
                     with_key)
from .components import components

#: Sets compared with each other inside one chunk of a group.
GROUP_SETS = 512
#: Query sets that one copy of a chunk is opened for.
QUERY_SETS = 4096
LOT_BYTES = 4 << 20

_SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def overlap_needed(n, percent: int):
    """Least overlap of a set of n with any set it links with."""
    return -(-percent * n // 100)


def _prefix(n: int, percent: int) -> int:
    return n - overlap_needed(n, percent) + 1 + n // 5


def _prefix_hits(n: int, percent: int) -> int:
    """Shared hashes in the prefix that a link can't do without, whatever the
    partner's size (its smallest size is the overlap itself)."""
    return 1 + overlap_needed(n, percent) // 5


def _set_ids(tokens: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    spread = W.mix(tokens)
    return askshare.part_of(spread, n_parts), spread.astype(np.uint32)


def _joined_ids(tokens: np.ndarray, n_parts: int) -> np.ndarray:
    part, low = _set_ids(tokens, n_parts)
    return (part.astype(np.uint64) << np.uint64(32)) | low


class _Bucket:
    """Distinct sets of one bucket of documents."""

    def __init__(self, docs: pa.Table, shingle: int):
        self.ids = docs["doc_id"].to_numpy(zero_copy_only=False)
        data, offsets = W.text_buffer(texts(docs["text"]))
        self.sets: list[np.ndarray] = []
        self.owner: list[int] = []          # smallest document id of each set
        self.rows = np.full(len(self.ids), -1)   # set of each document
        seen: dict[bytes, int] = {}
        self.digests: list[bytes] = []
        at = 0
        for i, j in W.slices(offsets):
            hashes, first = W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            hashes, first = W.shingles(hashes, first, shingle)
            for x in W.unique_sets(hashes, first):
                if len(x):
                    digest = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                    k = seen.setdefault(digest, len(self.sets))
                    if k == len(self.sets):
                        self.sets.append(x)
                        self.digests.append(digest)
                        self.owner.append(int(self.ids[at]))
                    else:
                        self.owner[k] = min(self.owner[k], int(self.ids[at]))
                    self.rows[at] = k
                at += 1
        self.sizes = np.array([len(x) for x in self.sets], np.int64)


def _concat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)


def _ask(docs: pa.Table, shingle: int, percent: int, n_parts: int) -> pa.Table:
    b = _Bucket(docs, shingle)
    tokens = _concat([x[:_prefix(len(x), percent)] for x in b.sets])
    tokens, counts = np.unique(tokens, return_counts=True)
    part, low = _set_ids(tokens, n_parts)
    order = np.lexsort((low, part))
    many = (counts > 1).astype(np.uint8)
    return askshare.pack(part[order], int(docs["bucket"][0].as_py()), [low[order], many[order]])


def _answer(asked: pa.Table) -> pa.Table:
    buckets, (low, many) = askshare.unpack(asked, [np.uint32, np.uint8])
    part = np.uint64(asked["part"][0].as_py()) << np.uint64(32)
    _, inverse, counts = np.unique(low, return_inverse=True, return_counts=True)
    shared = (counts > 1) | (np.bincount(inverse, many, len(counts)) > 0)
    reply = shared[inverse] & (many == 0)
    return askshare.answer(buckets[reply], [part | low[reply].astype(np.uint64)])


_SETS_SCHEMA = ("doc_id long, n long, local long, owner long, digest binary, body binary, h0 long, h1 long, "
                "text_digest binary")


def _sets(docs: pa.Table, answers: pa.Table, shingle: int, percent: int, n_parts: int, keyed: bool) -> pa.Table:
    """Every row with its set: ``local`` names the set of a bucket, ``owner`` is
    the smallest id that has it there. ``keyed`` adds the text's digest."""
    b = _Bucket(docs, shingle) if docs.num_rows else None
    if b is None:
        return _sets_table([], [], [], [], [], [], [], [], [])
    prefixes = [x[:_prefix(len(x), percent)] for x in b.sets]
    tokens = _concat(prefixes)
    owners = np.repeat(np.arange(len(prefixes)), [len(x) for x in prefixes])
    ids = _joined_ids(tokens, n_parts)
    _, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    (told,) = askshare.read_answers(answers, [np.uint64])
    shared |= np.isin(ids, told)
    hits = np.bincount(owners[shared], minlength=len(b.sets)) if len(b.sets) else np.zeros(0, int)
    needed = np.array([_prefix_hits(int(n), percent) for n in b.sizes])
    goes_on = hits >= needed if len(b.sets) else np.zeros(0, bool)
    local, owner, n, digest, body, h0, h1 = [], [], [], [], [], [], []
    first = docs["bucket"][0].as_py() << 32
    done: set[int] = set()
    for i, (doc, k) in enumerate(zip(b.ids.tolist(), b.rows.tolist())):
        n.append(0 if k < 0 else int(b.sizes[k]))
        # A row without a set gets a number after those of the sets.
        local.append(first + (len(b.sets) + i if k < 0 else k))
        owner.append(doc if k < 0 else b.owner[k])
        if k >= 0 and goes_on[k] and k not in done:
            done.add(k)
            x = b.sets[k]
            digest.append(b.digests[k])
            body.append(x.tobytes())
            h0.append(int(W.mix(x ^ _SEEDS[0]).min().view(np.int64)))
            h1.append(int(W.mix(x ^ _SEEDS[1]).min().view(np.int64)))
        else:
            digest.append(None), body.append(None), h0.append(None), h1.append(None)
    named = ([hashlib.sha256(x).digest() for x in texts(docs["text"]).to_pylist()] if keyed
             else [None] * len(b.ids))
    return _sets_table(b.ids.tolist(), n, local, owner, digest, body, h0, h1, named)


def _sets_table(ids, n, local, owner, digest, body, h0, h1, named) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()),
                     "local": pa.array(local, pa.int64()), "owner": pa.array(owner, pa.int64()),
                     "digest": pa.array(digest, pa.binary()),
                     "body": pa.array(body, pa.binary()), "h0": pa.array(h0, pa.int64()),
                     "h1": pa.array(h1, pa.int64()), "text_digest": pa.array(named, pa.binary())})


# -- comparing sets inside a task ------------------------------------------

class _Members:
    """Sets laid end to end over a common numbering of their shingles."""

    def __init__(self, bodies: list[bytes]):
        sets = [np.frombuffer(x, np.uint64) for x in bodies]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.union, self.flat = np.unique(_concat(sets), return_inverse=True)
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)))

    def flags(self, tokens: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        found = at[self.union[at] == tokens] if len(self.union) else at[:0]
        flags = np.zeros(len(self.union), np.int64)
        flags[found] = 1
        return flags

    def overlaps(self, flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags[self.flat], self.begin[:-1])

    def keep(self, mask: np.ndarray) -> None:
        self.flat = self.flat[np.repeat(mask, self.sizes)]
        self.sizes = self.sizes[mask]
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)))


def _links(overlap, n, sizes, percent: int):
    return 100 * overlap >= percent * (n + sizes - overlap)


def _connect(ids: np.ndarray, bodies: list[bytes], percent: int) -> tuple[list[int], list[int]]:
    """Edges that connect what links connect: each linked set with the set it
    was reached from. A set is compared with those not reached yet."""
    rest = _Members(bodies)
    union, left = rest.union, np.arange(len(ids))
    a, b = [], []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            mask = np.ones(len(left), bool)
            mask[0] = False
            rest.keep(mask)
            left = left[1:]
            continue
        q = queue.pop()
        if not len(left):
            break
        tokens = np.frombuffer(bodies[q], np.uint64)
        flags = np.zeros(len(union), np.int64)
        flags[np.searchsorted(union, tokens)] = 1
        found = _links(rest.overlaps(flags), len(tokens), rest.sizes, percent)
        if found.any():
            for k in left[found].tolist():
                a.append(int(ids[k]))
                b.append(int(ids[q]))
                queue.append(k)
            rest.keep(~found)
            left = left[~found]
    return a, b


_EDGE_SCHEMA = "a long, b long"


def _edges(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _by_group(lot: pa.Table, key: str):
    """Slices of a lot, one for each group."""
    lot = lot.sort_by(key).combine_chunks()
    keys = lot[key].to_numpy()
    edges = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)])).tolist()
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi > lo:
            yield lot.slice(lo, hi - lo)


def _connect_lot(lot: pa.Table, percent: int) -> pa.Table:
    a, b = [], []
    for group in _by_group(lot, "gid"):
        if group.num_rows > 1:
            x, y = _connect(group["doc"].to_numpy(), group["body"].to_pylist(), percent)
            a += x
            b += y
    return _edges(a, b)


def _open_lot(lot: pa.Table, percent: int) -> pa.Table:
    out: set[tuple[int, int]] = set()
    for group in _by_group(lot, "gid"):
        member = group["role"].to_numpy() == 1
        members, queries = group.filter(pa.array(member)), group.filter(pa.array(~member))
        if not members.num_rows or not queries.num_rows:
            continue
        sets = _Members(members["body"].to_pylist())
        comps = members["comp"].to_numpy()
        for comp, body in zip(queries["comp"].to_pylist(), queries["body"].to_pylist()):
            tokens = np.frombuffer(body, np.uint64)
            flags = sets.flags(tokens)
            if int(flags.sum()) < overlap_needed(len(tokens), percent):
                continue
            found = _links(sets.overlaps(flags), len(tokens), sets.sizes, percent) & (comps != comp)
            out.update((comp, int(c)) for c in np.unique(comps[found]))
    return _edges([x for x, _ in out], [y for _, y in out])


# -- second ask: shingles that occur in different components ---------------

def _ask_components(sets: pa.Table, n_parts: int) -> pa.Table:
    bodies = [np.frombuffer(x, np.uint64) for x in sets["body"].to_pylist()]
    tokens = _concat(bodies)
    comps = np.repeat(sets["comp"].to_numpy(), [len(x) for x in bodies])
    tokens, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    low_c = np.full(len(tokens), np.iinfo(np.int64).max)
    high_c = np.full(len(tokens), np.iinfo(np.int64).min)
    np.minimum.at(low_c, inverse, comps)
    np.maximum.at(high_c, inverse, comps)
    part, low = _set_ids(tokens, n_parts)
    order = np.lexsort((low, part))
    return askshare.pack(part[order], int(sets["bucket"][0].as_py()),
                         [low[order], (low_c != high_c).astype(np.uint8)[order],
                          counts.astype(np.uint32)[order], low_c[order]])


def _answer_components(asked: pa.Table) -> pa.Table:
    buckets, (low, many, count, comp) = askshare.unpack(
        asked, [np.uint32, np.uint8, np.uint32, np.int64])
    part = np.uint64(asked["part"][0].as_py()) << np.uint64(32)
    order = np.lexsort((comp, low))
    low, many, count, comp, buckets = low[order], many[order], count[order], comp[order], buckets[order]
    new = np.concatenate(([True], low[1:] != low[:-1]))
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(low)])) - 1
    shared = (comp[first] != comp[last]) | (np.add.reduceat(many, first) > 0)
    total = np.add.reduceat(count.astype(np.uint64), first)
    reply = shared[group]
    return askshare.answer(buckets[reply], [part | low[reply].astype(np.uint64), total[group][reply]])


def _candidates(sets: pa.Table, answers: pa.Table, percent: int, n_parts: int) -> pa.Table:
    """Sets that may link with another component, each with the rarest of its
    shared shingles that a link can't avoid."""
    told, total = askshare.read_answers(answers, [np.uint64, np.uint64])
    order = np.argsort(told)
    told, total = told[order], total[order]
    docs, out = [], []
    if len(told):
        for doc, body in zip(sets["doc"].to_pylist(), sets["body"].to_pylist()):
            ids = _joined_ids(np.frombuffer(body, np.uint64), n_parts)
            at = np.searchsorted(told, ids)
            at[at == len(told)] = 0
            at = at[told[at] == ids]
            spare = len(at) - overlap_needed(len(ids), percent)
            if spare >= 0:
                rarest = np.lexsort((told[at], total[at]))[:spare + 1]
                docs.append(doc)
                out.append(told[at][rarest].view(np.int64))
    return pa.table({"doc": pa.array(docs, pa.int64()), "tokens": pa.array(out, pa.list_(pa.int64()))})


def _lots(df: DataFrame, total_bytes: int, *group) -> DataFrame:
    gid = F.xxhash64(*group)
    lots = max(1, math.ceil(total_bytes / LOT_BYTES))
    return df.withColumn("gid", gid).withColumn("lot", F.pmod("gid", F.lit(lots)).cast("int"))


def _body_bytes(df: DataFrame) -> int:
    return int(df.agg(F.sum(F.octet_length("body"))).first()[0] or 0)


def _link_inside_groups(sets: DataFrame, percent: int) -> DataFrame:
    keys = sets.select("doc", F.explode(F.array(
        F.struct(F.lit(0).alias("f"), F.col("h0").alias("h")),
        F.struct(F.lit(1).alias("f"), F.col("h1").alias("h")))).alias("k")).select("doc", "k.f", "k.h")
    sizes = keys.groupBy("f", "h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    chunk = F.pmod(F.xxhash64("doc"), F.ceil(F.col("c") / GROUP_SETS))
    members = cut(keys.join(sizes, ["f", "h"]).withColumn("chunk", chunk).select("doc", "f", "h", "chunk"))
    members = members.join(sets.select("doc", "body"), "doc")
    lots = _lots(members, _body_bytes(members), "f", "h", "chunk").select("lot", "gid", "doc", "body")
    return lots.groupBy("lot").applyInArrow(lambda t: _connect_lot(t, percent), _EDGE_SCHEMA)


def _link_across(sets: DataFrame, percent: int) -> DataFrame:
    """Edges between components of ``sets`` (doc, comp, h0, body)."""
    size = _body_bytes(sets)
    n_buckets = max(1, math.ceil(size / BUCKET_BYTES))
    n_parts = max(1, math.ceil(size / 8 / askshare.RANGE_KEYS))
    sent = sets.select("doc", "comp", "body").withColumn("bucket", bucket_of(F.col("doc"), n_buckets))
    asked = sent.groupBy("bucket").applyInArrow(
        lambda t: _ask_components(t, n_parts), askshare.ASK_SCHEMA)
    answers = asked.groupBy("part").applyInArrow(_answer_components, askshare.ANSWER_SCHEMA)
    open_sets = (sent.groupBy("bucket").cogroup(answers.groupBy("bucket"))
                 .applyInArrow(lambda s, a: _candidates(s, a, percent, n_parts),
                               "doc long, tokens array<long>"))
    open_sets = cut(open_sets)
    comp_size = sets.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    known = (open_sets.select("doc").join(sets.select("doc", "comp", "h0"), "doc")
             .join(comp_size, "comp"))
    # Groups: a component, or the single sets with one min-hash.
    known = (known.withColumn("single", F.col("size") == 1)
             .withColumn("key", F.when(F.col("single"), F.col("h0")).otherwise(F.col("comp"))))
    counts = known.groupBy("single", "key").agg(F.count(F.lit(1)).alias("c"))
    known = (known.join(counts, ["single", "key"])
             .withColumn("group", F.xxhash64("single", "key", F.pmod(
                 F.xxhash64("doc"), F.ceil(F.col("c") / GROUP_SETS))))
             .select("doc", "comp", "size", "single", "group"))
    known = cut(known)
    matrix = open_sets.join(known, "doc").select(
        "doc", "comp", "size", "single", "group", F.explode("tokens").alias("token"))
    index = matrix.select("token", "group", "single", F.col("size").alias("g_size"),
                          F.when(F.col("single"), F.lit(None).cast("long"))
                          .otherwise(F.col("comp")).alias("g_comp")).distinct()
    # The set of the smaller component asks the group of the larger one.
    asks = (F.col("q.size") < F.col("x.g_size")) | (F.col("q.single") & F.col("x.single")) | (
        (F.col("q.size") == F.col("x.g_size")) & (F.col("q.comp") < F.col("x.g_comp")))
    openings = cut(matrix.alias("q").join(index.alias("x"), (F.col("q.token") == F.col("x.token")) & asks)
                   .select(F.col("q.doc").alias("doc"), F.col("q.comp").alias("comp"),
                           F.col("x.group").alias("group")).distinct())
    blocks = (openings.groupBy("group").agg(F.count(F.lit(1)).alias("c"))
              .select("group", F.ceil(F.col("c") / QUERY_SETS).alias("blocks")))
    queries = (openings.join(blocks, "group")
               .select("doc", "comp", "group", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block"),
                       F.lit(0).alias("role")))
    members = (known.join(blocks, "group")
               .select("doc", "comp", "group", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
                       F.lit(1).alias("role")))
    rows = cut(queries.union(members)).join(sets.select("doc", "body"), "doc")
    lots = _lots(rows, _body_bytes(rows), "group", "block").select(
        "lot", "gid", "role", "comp", "body")
    return lots.groupBy("lot").applyInArrow(lambda t: _open_lot(t, percent), _EDGE_SCHEMA)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       shingle: int = 5, percent: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``."""
    return _judged(docs, doc_id, text, shingle, percent, False).drop("text_digest", "component")


def _judged(docs: DataFrame, doc_id: str, text: str, shingle: int = 5, percent: int = 75,
            keyed: bool = True) -> DataFrame:
    size = text_bytes(docs, text)
    n_buckets = max(1, math.ceil(size / BUCKET_BYTES))
    # About one prefix hash for every 14 bytes of text.
    n_parts = max(1, math.ceil(size / 14 / askshare.RANGE_KEYS))
    sent = dealt(docs.select(id_in(column(doc_id)).alias("doc_id"), column(text).alias("text")), n_buckets)
    asked = sent.groupBy("bucket").applyInArrow(
        lambda t: _ask(t, shingle, percent, n_parts), askshare.ASK_SCHEMA)
    answers = asked.groupBy("part").applyInArrow(_answer, askshare.ANSWER_SCHEMA)
    rows = cut(sent.groupBy("bucket").cogroup(answers.groupBy("bucket"))
               .applyInArrow(lambda d, a: _sets(d, a, shingle, percent, n_parts, keyed), _SETS_SCHEMA))
    held = rows.filter("body is not null")
    # Equal sets go on as one, by the smallest of their names; ``low`` is the
    # smallest document id that has them.
    classes = held.groupBy("digest").agg(F.min("local").alias("doc"), F.min("owner").alias("low"))
    member = cut(held.select("local", "digest").join(classes, "digest").select("local", "doc", "low"))
    sets = held.join(member.filter("local = doc").select("doc", "low"), held.local == F.col("doc")).select(
        "doc", "low", "h0", "h1", "body")

    inside = components(_link_inside_groups(sets, percent))
    comp = F.coalesce("root", "doc").alias("comp")
    sets = cut(sets.join(inside.withColumnRenamed("node", "doc"), "doc", "left")
               .select("doc", "low", comp, "h0", "body"))
    across = components(_link_across(sets, percent))
    # A component is named by the smallest document id, found on one row for
    # each component of the first step.
    of_comp = (sets.groupBy("comp").agg(F.min("low").alias("low"))
               .join(across.withColumnRenamed("node", "comp"), "comp", "left")
               .select("comp", "low", F.coalesce("root", "comp").alias("component")))
    least = of_comp.groupBy("component").agg(F.min("low").alias("least"))
    of_comp = of_comp.join(least, "component").select("comp", "component", "least")
    final = sets.select("doc", "comp").join(of_comp, "comp").select("doc", "component", "least")
    of_local = member.join(final, "doc").select("local", "component", "least")
    return (rows.select("doc_id", "n", "local", "owner", "text_digest").join(of_local, "local", "left")
            .select(id_out(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                    id_out(F.coalesce("least", "owner")).alias("component_id"), "text_digest",
                    # Equal sets of one bucket go on under one name, even if no other has them.
                    F.when(F.col("n") > 0, F.coalesce("component", "local")).alias("component")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component: of the smallest id (a null one
    comes first), of its texts the one of the smallest digest, and of rows that
    are equal in both the first by their columns in order. Rows without words are linked with nothing and
    all stay. Texts that share an id are judged each by its own component."""
    found = cut(_judged(docs, doc_id, text, **how).filter("component IS NOT NULL").groupBy(
        "component", F.struct(F.col("doc_id").alias("id"), F.col("text_digest").alias("digest")).alias("row"))
        .agg(F.count(F.lit(1)).alias("rows")))
    first = found.groupBy("component").agg(F.min("row").alias("first"))
    # What needs a decision: rows that go, and the repeated ones of those that stay.
    judged = (found.join(first, "component").withColumn("goes", F.col("row") != F.col("first"))
              .filter("goes OR rows > 1").select("row", "goes"))
    keyed, key = with_key(docs, doc_id, text)
    other, goes = free(keyed, "judged_row"), free(keyed, "judged_goes")
    kept = (keyed.join(cut(judged).toDF(other, goes), F.col(key).eqNullSafe(F.col(other)), "left")
            .filter(~F.coalesce(goes, F.lit(False))))
    # Equal rows meet in the map tasks first, so many of them are no hot group.
    names = list(map(column, docs.columns))
    # Maps and variants have no order.
    ordered = [column(f.name) for f in docs.schema
               if not any(t in f.dataType.simpleString() for t in ("map<", "variant", "interval"))]
    once = (kept.filter(F.col(goes).isNotNull()).groupBy(key)
            .agg(F.min_by(F.struct(*names), F.struct(*ordered)).alias(key + "s")).select(f"{key}s.*"))
    return kept.filter(F.col(goes).isNull()).select(*names).unionAll(once)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
d AS (
  SELECT r, doc_id, id, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM w WHERE len(w) > 0),
sets AS (SELECT s, min(r) AS q, min(id) AS id FROM d GROUP BY s),
shingles AS (SELECT q, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.q AS x, b.q AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.q <> b.q
  GROUP BY a.q, b.q HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (SELECT q, q AS other FROM sets UNION SELECT reached.q, y FROM reached JOIN links ON other = x),
named AS (SELECT reached.q, min(id) AS least FROM reached JOIN sets ON other = sets.q GROUP BY reached.q),
found AS (SELECT r, len(d.s) AS n, least FROM d JOIN sets USING (s) JOIN named USING (q))
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       nullif(coalesce(least, w.id), -9223372036854775808) AS component_id
FROM w LEFT JOIN found USING (r)
"""

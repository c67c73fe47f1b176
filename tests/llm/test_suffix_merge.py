"""op8's merge: strings of mixed anchors, and work that doesn't grow by the string in Python."""

import random
import sys

import numpy as np
import pyarrow as pa

from ludolake.llm import suffix_dedup as S

from .test_exact import exchanged, removed


def segment_rows(texts, n_buckets):
    """What one range of all keys is sent."""
    docs = [S.pa.table({"doc_id": pa.array(list(range(b, len(texts), n_buckets)), pa.int64()),
                        "text": pa.array([S.zstandard.ZstdCompressor().compress(t) for t in texts[b::n_buckets]],
                                         pa.binary()),
                        "bucket": pa.array([b] * len(texts[b::n_buckets]), pa.int32())}) for b in range(n_buckets)]
    answers = S._answer(pa.concat_tables([S._ask(d, 1) for d in docs]))
    return pa.concat_tables([S._runs(d, answers.filter(pa.compute.equal(answers["bucket"], b)), 1, [])
                             for b, d in enumerate(docs)])


def mixed_texts(n):
    """One passage in contexts of its own everywhere: every anchor is mixed."""
    rng = random.Random(5)
    prose = lambda k: bytes(rng.randrange(97, 123) for _ in range(k))
    passage = prose(400)
    return [prose(rng.randint(0, 9)) + b"".join(passage[a:a + rng.randint(40, 90)] + prose(rng.randint(1, 3))
                                                for a in (rng.randrange(300) for _ in range(6))) for _ in range(n)]


def test_merge_is_no_loop_over_strings():
    rows = segment_rows(mixed_texts(300), 3)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        S._merge_range(rows)
    finally:
        sys.setprofile(None)
    assert sum(rows["n"].to_pylist()) > 4000
    assert calls < 5000   # a loop over the strings makes several for each


def test_strings_of_mixed_anchors():
    for n_buckets, ends in ((1, []), (3, [b"m"]), (4, [b"g", b"t"])):
        texts = mixed_texts(40) + [b"\0" * 120, b"\0" * 90 + b"x", b"a" * 200, b"a" * 60 + b"\0" * 60]
        assert exchanged(texts, n_buckets, ends) == removed(texts)


def test_merged_order():
    rng = np.random.default_rng(2)
    runs = [np.sort(rng.integers(97, 99, (n, 6), np.uint8).view("S6")[:, 0]) for n in (1, 40, 200)]
    keys = np.concatenate(runs).view(np.uint8).reshape(-1, 6)
    order, shared = S.merged(keys)
    rows = keys[order]
    assert [bytes(r) for r in rows] == sorted(bytes(r) for r in keys)
    for k in range(1, len(rows)):
        same = rows[k] == rows[k - 1]
        assert shared[k] == (6 if same.all() else same.argmin())

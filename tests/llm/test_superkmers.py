import hashlib
import random

import numpy as np
import pytest
import zstandard
from helpers import as_docs, no_docs, odd_docs, some_docs
from pyspark.sql import functions as F

from ledgerline.llm import queries, superkmers


def slow(rows, window=13):
    """(doc_id, text) rows -> (doc_id, n_words, n_removed, kept): every window looked up in a table of all windows."""
    order = lambda d: (d is None, d or 0)
    least = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, ws in split:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            least[key] = min(least.get(key, order(d)), order(d))
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - window + 1):
            if least[tuple(ws[i:i + window])] < order(d):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone).decode()
        out.append((d, len(ws), len(gone), kept))
    return sorted(out, key=repr)


def fast(docs, **how):
    return sorted(map(tuple, superkmers.without_repeats(docs, ["doc_id"], **how).collect()), key=repr)


def test_query_against_brute_force(spark, sf_small):
    rows = list(some_docs(spark, sf_small)[["doc_id", "text"]].itertuples(index=False, name=None))
    want = sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in slow(rows))
    assert sorted(map(tuple, queries.op11_super_kmers(spark, sf_small).collect())) == want and any(w[2] for w in want)


def random_texts(rng, n):
    """Texts of few words, so that windows often meet, with copies, shared passages and long runs of one word."""
    out = []
    for _ in range(n):
        words = [rng.choice("ab c de fgh".split()) for _ in range(rng.randrange(30))]
        if out and rng.random() < 0.4:
            other = (rng.choice(out) or "").split()
            a = rng.randrange(len(other) + 1)
            words[rng.randrange(len(words) + 1):0] = other[a:a + rng.randrange(1, 20)]
        if rng.random() < 0.1:
            words += ["z"] * rng.randrange(200)
        out.append(rng.choice([" ", "\n", "  \t"]).join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_small_windows_hot_keys_and_many_buckets(spark, seed):
    texts = random_texts(random.Random(seed), 60)
    rows = list(enumerate(texts))
    docs = as_docs(spark, texts).repartition(4)
    assert fast(docs, window=4, m=2) == slow(rows, 4)
    # All minimisers split; buckets of a few bytes.
    assert fast(docs, window=4, m=2, hot_windows=1) == slow(rows, 4)
    assert fast(docs, window=5, m=1, bucket_bytes=64) == slow(rows, 5)
    assert fast(docs, window=1, m=1, bucket_bytes=256) == slow(rows, 1)


def test_odd_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert fast(docs) == slow(rows)
        assert fast(docs.repartition(3), window=2, m=1) == slow(rows, 2)
    clash = odd_docs(spark).withColumns({c: F.lit(1) for c in ("row", "marks", "bucket", "blob", "key", "start", "mask", "m_doc", "k0", "n_row")})
    assert superkmers.without_repeats(clash, ["doc_id", "row", "k0"]).columns == ["doc_id", "row", "k0", "n_words", "n_removed", "kept"]
    assert superkmers.without_repeats(clash, ["row", "k0"]).collect()[0][:2] == (1, 1)
    with pytest.raises(ValueError):
        superkmers.without_repeats(clash.withColumn("kept", F.lit(1)), ["kept"])


def test_packed_strings_hold_each_window_once():
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(50)) for _ in range(n)) for n in (0, 3, 13, 14, 500, 40)] + [None, "a " * 300]
    p = superkmers.Packed(texts, 13, 3, None)
    got = sorted((int(t), int(s) + i) for t, s, n in zip(p.text, p.start, p.windows) for i in range(n))
    assert got == sorted((t, i) for t, x in enumerate(texts) for i in range(len((x or "").split()) - 12))
    packed = p.strings()
    for t, s, n, x in zip(p.text, p.start, p.windows, packed):
        assert x.decode().split(" ") == texts[t].split()[s:s + n + 12] and n <= superkmers.MASK
    assert len(packed) < sum(p.windows) / 3


def test_blob_round_trip_and_window_ids():
    a = np.arange(3)
    blob = superkmers.encoded(a, a > 1, a + 5, a * 2, a.astype(np.uint64), [b"x y", b"z", b"w"], zstandard.ZstdCompressor())
    *arrays, packed = superkmers.decoded(blob)
    assert [x.tolist() for x in arrays] == [[0, 1, 2], [0, 0, 1], [5, 6, 7], [0, 2, 4], [0, 1, 2]] and packed == b"x y\nz\nw"
    codes = np.random.default_rng(1).integers(0, 2, 400)
    for w in (1, 2, 5, 7, 13):
        ids = superkmers.window_ids(codes, w)
        runs = [tuple(codes[i:i + w]) for i in range(len(codes) - w + 1)]
        assert len(ids) == len(runs) and len(set(zip(ids.tolist(), runs))) == len(set(ids.tolist())) == len(set(runs))

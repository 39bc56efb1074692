import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import as_docs, no_docs, odd_docs, some_docs
from pyspark.sql import functions as F

from ledgerline.llm import ppm, queries


class SlowPpm:
    """PPM with method C and exclusion, symbol by symbol."""

    def __init__(self, texts, order=ppm.ORDER):
        self.order, self.counts = order, defaultdict(Counter)
        for t in texts:
            for context, symbol in self.steps(t):
                for j in range(order + 1):
                    self.counts[context[order - j:]][symbol] += 1

    def steps(self, text):
        s = [ppm.START] * self.order + [b + 1 for b in (text or "").encode()] + [ppm.END]
        for i in range(self.order, len(s)):
            yield tuple(s[i - self.order:i]), s[i]

    def logp(self, context, symbol):
        total, gone = 0.0, set()
        for j in range(self.order, -1, -1):
            seen = {x: n for x, n in self.counts[context[self.order - j:]].items() if x not in gone}
            if not seen:
                continue
            parts = sum(seen.values()) + len(seen)
            if symbol in seen:
                return total + math.log(seen[symbol] / parts)
            total += math.log(len(seen) / parts)
            gone |= set(seen)
        return total - math.log(ppm.ALPHABET - len(gone))

    def score(self, text):
        return sum(self.logp(*x) for x in self.steps(text)) / math.log(10)


def base(rows):
    """(text, held_out) -> n_tokens, n_known, train_tokens, base_score of each."""
    tokens = [[*(t or "").encode().lower().split(), None] for t, _ in rows]
    c = Counter(x for ts, (_, h) in zip(tokens, rows) if not h for x in ts)
    n, v = sum(c.values()), len(c)
    return [(len(ts), sum(c[x] > 0 for x in ts), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in ts)) for ts in tokens]


def check(spark, docs, held_out):
    rows = [(r["doc_id"], r["text"], r["h"]) for r in docs.withColumn("h", held_out).collect()]
    model = SlowPpm([t for _, t, h in rows if not h])
    want = sorted(((d, h, *b[:3], b[3], model.score(t)) for (d, t, h), b in zip(rows, base([r[1:] for r in rows]))), key=repr)
    got = sorted(map(tuple, ppm.scores(docs, held_out).collect()), key=repr)
    key = lambda r: (repr(r[:5]), r[6])
    want, got = sorted(want, key=key), sorted(got, key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose(np.array([x[5:] for x in got], float).reshape(-1, 2), np.array([x[5:] for x in want], float).reshape(-1, 2), rtol=1e-9)
    return got


def test_against_symbol_by_symbol(spark, sf_small, monkeypatch):
    docs = some_docs(spark, sf_small, 24)
    docs["text"] = [t[:700] for t in docs["text"]]
    docs = spark.createDataFrame(docs)
    held_out = F.col("doc_id") % 3 == 1
    a = check(spark, docs, held_out)
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 2000)  # many chunks give the same
    assert [x[:5] for x in check(spark, docs, held_out)] == [x[:5] for x in a]


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("text", F.substring("text", 1, 3000))
    check(spark, docs, F.col("doc_id").isNull() | (F.col("doc_id") % 2 == 0))
    check(spark, docs, F.lit(True))
    check(spark, docs, F.lit(False))
    assert ppm.scores(odd_docs(spark), F.lit(False)).count() == 13
    assert ppm.scores(no_docs(spark), F.lit(False)).count() == 0


def test_probabilities_sum_to_one(spark):
    texts = ["abracadabra", "abra", "banana"]
    docs = as_docs(spark, texts)
    slow = SlowPpm(texts)
    for context in (tuple([0] * ppm.ORDER), tuple(b + 1 for b in b"abra"), tuple(b + 1 for b in b"zzzz"), tuple(b + 1 for b in b"zana")):
        assert sum(math.exp(slow.logp(context, s)) for s in range(1, 258)) == pytest.approx(1)
    check(spark, docs, F.lit(False))


def test_query_folds(spark, sf_small):
    got = queries.op7_ppm_scoring(spark, sf_small).toPandas()
    assert len(got) == len(some_docs(spark, sf_small))
    assert all(h == (zlib.crc32(str(d).encode()) % 7 == 2) for d, h in zip(got["doc_id"], got["held_out"]))
    assert (got["score"] < 0).all() and got["train_tokens"].nunique() == 1


def test_longer_contexts_help_on_held_out_texts(spark):
    got = queries.op7_ppm_scoring(spark, "/root/testdata/sf0.01").toPandas()
    bits = -got["score"].sum() / np.log10(2) / sum(len(t.encode()) + 1 for t in some_docs(spark, "/root/testdata/sf0.01")["text"])
    assert bits < 2.5

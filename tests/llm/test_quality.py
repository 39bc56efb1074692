import zlib

import numpy as np
from helpers import LONG, no_docs, odd_docs
from pyspark.sql import functions as F

from ledgerline.llm import quality, queries
from ledgerline.llm.common import table


def slow_score(net, text):
    data = quality.padded((text or "").encode())
    z = np.array([sum(net.filters[k, data[i + k]] for k in range(quality.WIDTH)) for i in range(len(data) - quality.WIDTH + 1)])
    starts = range(0, len(z), quality.HALF)
    chunks = [z[a:a + 2 * quality.HALF].max(0) for a in list(starts)[:max(1, len(starts) - 1)]]
    act = np.maximum(np.array(chunks) + net.bias, 0)
    x = np.concatenate([act.mean(0), act.max(0)]) @ net.weights + net.offset
    return 1 / (1 + np.exp(-x))


def test_scores_cover_the_whole_text():
    net = quality.Network.start(1)
    r = np.random.default_rng(2)
    for n in (0, 1, 4, 5, 127, 128, 131, 132, 133, 300, 1000, 5000):
        text = "".join(map(chr, r.integers(32, 900, n)))
        assert abs(quality.score(net, text) - slow_score(net, text)) < 1e-5
    assert quality.score(net, None) == quality.score(net, "")
    long = quality.halves(net, quality.padded(LONG.encode()))
    whole = quality.responses(net, quality.padded(LONG.encode()))
    assert np.array_equal(long, np.maximum.reduceat(whole, np.arange(0, len(whole), quality.HALF)))


def test_gradient_against_differences():
    net = quality.Network.start(4)
    net.filters, net.bias, net.weights = (a.astype(np.float64) for a in net.arrays())
    data = quality.padded(("some text with !!! and ### marks " * 20).encode())
    grads = [np.zeros(a.shape) for a in net.arrays()]
    quality._gradient(net, data, 1, grads)

    def loss():
        return -np.log(slow_score(net, bytes(data).decode()))

    r = np.random.default_rng(0)
    for a, g in zip(net.arrays(), grads):
        for at in [np.unravel_index(i, a.shape) for i in {*np.argsort(-np.abs(g).ravel())[:4].tolist(), *r.integers(0, a.size, 3).tolist()}]:
            was = a[at]
            a[at] = was + 1e-6
            up = loss()
            a[at] = was - 1e-6
            down = loss()
            a[at] = was
            assert abs((up - down) / 2e-6 - g[at]) < 1e-3


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_quality_cnn(spark, sf).toPandas().set_index("doc_id")
    labels = table(spark, sf, "labels").toPandas().set_index("doc_id")["quality"]
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in got["held_out"].items())
    held = got[got["held_out"]].join(labels, how="inner")
    assert len(held) > 50 and (held["predicted"] == held["quality"]).mean() > 0.95
    assert (got["predicted"] == (got["score"] >= 0.3)).all() and got["score"].between(0, 1).all()


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0, "a"), (4, 0, 0, "b"), (4, 1, 0, "c"), (None, 1, 0, "d"), (5, None, 0, "e"), (99, 1, 0, "f")], "doc_id long, quality int, toxic int, text string")
    texts, marks = quality.training_rows(docs, labels, 10)
    assert marks == [1, 0] and texts[1] in (None, "")
    net = quality.fit(texts, marks, steps=3)
    got = quality.scored(docs, net, ["doc_id", "part"]).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.fit(*quality.training_rows(docs, labels.limit(0), 10)) is None
    assert {r["score"] for r in quality.scored(docs, None, ["doc_id"]).collect()} == {0.5}
    assert quality.scored(no_docs(spark), net, ["doc_id"]).count() == 0
    assert len(quality.training_rows(docs, labels, 1)[0]) <= 1
    assert quality.scored(docs, net, ["doc_id"]).where(F.col("score").isNull()).count() == 0

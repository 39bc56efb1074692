"""Quality scores from a byte-level convolutional network, written in numpy.

Each filter is a weight for every byte value at each of WIDTH neighbouring
places. Its largest response is taken in overlapping chunks of the text (each
half overlaps the next), which together cover the whole document; a document's
features are, for each filter, the mean over the chunks and the largest of them,
and a logistic unit combines those into one probability.

The network is fitted on the driver on at most ``train_rows`` labelled rows, a
documented bound; they are those with the least hashed ids, so that the choice
does not depend on the order of the rows. Scoring runs in Spark's tasks, one
text at a time, long ones in pieces, so memory is bounded.

Nulls and odd rows: a null text scores as an empty one, which still gets a
probability. Labels without a quality or with a null doc_id are not learned
from; of several labels of an id, the lowest quality counts. If there is nothing
to learn from, every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, FILTERS, HALF = 5, 16, 128
#: Halves of a chunk that are worked on at once.
RUN = 512


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,)
    offset: float

    @classmethod
    def start(cls, seed: int) -> "Network":
        r = np.random.default_rng(seed)
        return cls(r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), r.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0)

    def arrays(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.weights]


def responses(net: Network, data: np.ndarray) -> np.ndarray:
    """(place, filter) of all whole windows of the bytes."""
    n = len(data) - WIDTH + 1
    out = np.take(net.filters[0], data[:n], axis=0)
    for k in range(1, WIDTH):
        out += np.take(net.filters[k], data[k:k + n], axis=0)
    return out


def padded(text: bytes) -> np.ndarray:
    """The bytes with zeros to one window at least."""
    return np.frombuffer(text if len(text) >= WIDTH else text.ljust(WIDTH, b"\0"), np.uint8)


def halves(net: Network, data: np.ndarray) -> np.ndarray:
    """Each filter's largest response in each half chunk; pieces overlap by a window, so that none is lost."""
    n, out = len(data) - WIDTH + 1, []
    for a in range(0, n, HALF * RUN):
        z = responses(net, data[a:a + HALF * RUN + WIDTH - 1])
        out.append(np.maximum.reduceat(z, np.arange(0, len(z), HALF), axis=0))
    return np.concatenate(out)


def pooled(h: np.ndarray, bias: np.ndarray) -> np.ndarray:
    chunks = np.maximum(h[:-1], h[1:]) if len(h) > 1 else h
    return np.maximum(chunks + bias, 0)


def score(net: Network, text: str | None) -> float:
    act = pooled(halves(net, padded((text or "").encode())), net.bias)
    f = np.concatenate([act.mean(0), act.max(0)])
    return float(1 / (1 + np.exp(-(float(f @ net.weights) + net.offset))))


def _gradient(net: Network, data: np.ndarray, label: int, grads: list[np.ndarray]) -> float:
    """Adds one text's gradient to grads; returns the gradient of the offset."""
    z = responses(net, data)
    n_half = -(-len(z) // HALF)
    starts = np.arange(0, len(z), HALF)
    full = np.full((n_half * HALF, FILTERS), -np.inf, np.float32)
    full[:len(z)] = z
    cube = full.reshape(n_half, HALF, FILTERS)
    place = cube.argmax(1) + starts[:, None]
    h = cube.max(1)
    if n_half > 1:
        second = h[1:] > h[:-1]
        chunk, at = np.maximum(h[:-1], h[1:]), np.where(second, place[1:], place[:-1])
    else:
        chunk, at = h, place
    act = np.maximum(chunk + net.bias, 0)
    top = act.argmax(0)
    f = np.concatenate([act.mean(0), act[top, np.arange(FILTERS)]])
    d = 1 / (1 + np.exp(-(float(f @ net.weights) + net.offset))) - label
    grads[2] += d * f
    g = np.repeat((d * net.weights[:FILTERS] / len(act))[None], len(act), 0)
    g[top, np.arange(FILTERS)] += d * net.weights[FILTERS:]
    g *= act > 0
    grads[1] += g.sum(0)
    which = np.broadcast_to(np.arange(FILTERS), at.shape)
    for k in range(WIDTH):
        np.add.at(grads[0][k], (data[at + k], which), g)
    return float(d)


def fit(texts: list[str | None], labels: list[int], seed: int = 7, steps: int = 600, batch: int = 16, rate: float = 0.02) -> Network | None:
    """A network fitted by Adam to the labelled texts, over whole texts; None if there are none."""
    if not texts:
        return None
    net, r = Network.start(seed), np.random.default_rng(seed)
    data = [padded((t or "").encode()) for t in texts]
    share = min(max(float(np.mean(labels)), 0.01), 0.99)
    net.offset = float(np.log(share / (1 - share)))
    first = [np.zeros_like(a) for a in net.arrays()] + [np.zeros(1)]
    second = [np.zeros_like(a) for a in net.arrays()] + [np.zeros(1)]
    offset = np.array([net.offset])
    order: list[int] = []
    for step in range(1, steps + 1):
        grads = [np.zeros_like(a) for a in net.arrays()] + [np.zeros(1)]
        for _ in range(batch):
            order = order or r.permutation(len(data)).tolist()
            i = order.pop()
            grads[3] += _gradient(net, data[i], labels[i], grads)
        net.offset = float(offset[0])
        for a, g, m, v in zip([*net.arrays(), offset], grads, first, second):
            g = g / batch
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= (rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(a.dtype)
        net.offset = float(offset[0])
    return net


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int) -> tuple[list[str | None], list[int]]:
    """Texts and labels of at most ``train_rows`` labelled rows: those of the least hashed doc_id."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    )
    # Bounded by train_rows, so it may be broadcast.
    got = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality").dropDuplicates(["doc_id"]).toPandas()
    got = got.sort_values("doc_id")
    return [None if t is None else str(t) for t in got["text"]], [int(q) for q in got["quality"]]


def _scoring(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [0.5 if net is None else score(net, t.as_py()) for t in b.column("text")]
            names = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(found, pa.float64())], names=[*names, "score"])
    return run


def scored(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` (not text) of every row, with score."""
    texts = docs.select(*keep, "text")
    kinds = ", ".join(f"`{n}` {t}" for n, t in texts.dtypes if n != "text")
    return texts.mapInArrow(_scoring(net), f"{kinds}, score double")

"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases by a rule that looks at a few neighbours
only, each phrase gets a name (a hash of its symbols), and the names are cut
again, level by level, until one is left. The rule is deterministic coin tossing:
runs of an equal symbol become one symbol; then each symbol is replaced by
the place and value of the lowest bit in which it differs from the one before it,
until labels are below 8; a phrase starts at each label that is greater than
both its neighbours. So equal substrings get equal names but for a few at their
ends, wherever they are in a text.

A fingerprint is the K least names of levels MIN_LEVEL and above, in hexadecimal;
likeness is the share of the K least names of two fingerprints' union that both
have, an estimate of the names' Jaccard index.

Nulls and odd rows: a null text counts as empty, whose fingerprint is the empty
string; two empty ones have likeness 1. Equal texts have equal fingerprints.
Rows of the same doc_id follow each other in the order of their text's hash; a
null doc_id comes first. Extra columns are ignored. The rows of an empty table
are none; a single row is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_hash, shuffle_width

K, MIN_LEVEL = 48, 2
RUN_CHARS = 1 << 20
ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tossed(now: np.ndarray, before: np.ndarray) -> np.ndarray:
    """2 i + bit i of now, i being the lowest bit in which now and before differ."""
    differ = now ^ before
    place = np.bitwise_count((differ & (~differ + ONE)) - ONE).astype(np.uint64)
    return (place << ONE) | ((now >> place) & ONE)


def _table(labels: int) -> np.ndarray:
    a = np.arange(labels, dtype=np.uint64)
    now, before = np.meshgrid(a, a)  # at [before, now]
    return np.where(now == before, 0, _tossed(now, before)).astype(np.uint8).ravel()


SECOND, THIRD = _table(128), _table(16)


def phrases(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the next level and where each starts. names: all texts' symbols in a row; first: true where a text starts."""
    # Runs of a symbol become one.
    new = np.empty(len(names), bool)
    new[0] = True
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new |= first
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(names)).astype(np.uint64)
    x = mix(names[at] + length * np.uint64(0x9E3779B97F4A7C15))
    begins = first[at]
    # Labels: 64 bits, then below 128, below 16, below 8.
    before = np.roll(x, 1)
    before[begins] = x[begins] ^ ONE
    label = _tossed(x, before).astype(np.uint8)
    for table, size in ((SECOND, 128), (THIRD, 16)):
        old = np.roll(label, 1)
        old[begins] = label[begins] ^ 1
        label = table[old.astype(np.uint16) * size + label]
    # A phrase starts where a text does and at local maxima.
    ends = np.roll(begins, -1)
    left, right = np.roll(label, 1), np.roll(label, -1)
    peak = (label > left) & (label > right) & ~ends
    cut = np.flatnonzero(peak | begins)
    place = np.arange(len(x)) - np.repeat(cut, np.diff(cut, append=len(x)))
    return mix(np.add.reduceat(mix(x + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), cut)), at[cut]


def fingerprints(texts: list[bytes], k: int = K, min_level: int = MIN_LEVEL) -> list[str]:
    """One fingerprint a text; the texts are parsed side by side, and never across their ends."""
    out = [""] * len(texts)
    filled = [i for i, t in enumerate(texts) if t]
    if not filled:
        return out
    size = np.array([len(texts[i]) for i in filled])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    names = np.frombuffer(b"".join(texts[i] for i in filled), np.uint8).astype(np.uint64) + ONE
    text = np.repeat(np.arange(len(filled)), size)
    first = np.zeros(len(names), bool)
    first[starts] = True
    got, level = [], 0
    while True:
        names, at = phrases(names, first)
        text, first, level = text[at], first[at], level + 1
        alone = np.bincount(text, minlength=len(filled))[text] == 1
        use = alone if level < min_level else np.ones(len(names), bool)
        got.append((text[use], mix(names[use] ^ np.uint64(level if level >= min_level else min_level)) >> np.uint64(32)))
        go = ~alone
        names, text, first = names[go], text[go], first[go]
        if not len(names):
            break
    text, value = np.concatenate([t for t, _ in got]).astype(np.uint64), np.concatenate([v for _, v in got])
    both = np.unique(text << np.uint64(32) | value)
    bounds = np.searchsorted(both, np.arange(len(filled) + 1, dtype=np.uint64) << np.uint64(32))
    for n, i in enumerate(filled):
        out[i] = "".join("%08x" % (v & 0xFFFFFFFF) for v in both[bounds[n]:min(bounds[n] + k, bounds[n + 1])].tolist())
    return out


def likeness(a: str, b: str, k: int = K) -> float:
    if a == b:
        return 1.0
    x, y = ({f[i:i + 8] for i in range(0, len(f), 8)} for f in (a, b))
    least = sorted(x | y)[:k]
    return sum(v in x and v in y for v in least) / len(least)


def edited(text: str, following: str) -> str:
    """text with its last floor(n / 2) characters replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


ROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _rows(ids: list, texts: list[str], last: str) -> pa.RecordBatch:
    """Rows of texts in order, last being the text that follows them."""
    following = [*texts[1:], last]
    changed = [edited(t, f) for t, f in zip(texts, following)]
    found = fingerprints([t.encode() for t in [*texts, last, *changed]])
    own, after, new = found[:len(texts)], found[1:len(texts) + 1], found[len(texts) + 1:]
    columns = [
        ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in changed], own, new,
        [likeness(a, b) for a, b in zip(own, new)], [likeness(a, b) for a, b in zip(own, after)]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROW)], schema=ROW)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part; the last row of a part is a guest, the row that follows the part's own."""
    ids, texts, size, part = [], [], 0, None
    for b in batches:
        for p, doc_id, text, guest in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest"))):
            text = text or ""
            if guest:
                if texts and part == p:  # a second guest is an equal row
                    yield _rows(ids, texts, text)
                    ids, texts, size = [], [], 0
                continue
            if texts and size > RUN_CHARS:
                yield _rows(ids, texts, text)
                ids, texts, size = [], [], 0
            part = p
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        raise RuntimeError("a part has no row that follows it")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprints of each text and of its edited text (half replaced by the next document's), and their likeness.

    Documents are dealt into ranges of doc_id whose bounds are quantiles of the
    ids; the first row of each range also goes to the range before it as its
    guest (and that of the first to the last), so that each text crosses the
    network once and every next one is at hand.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", row_hash(F.col("text")))
    width = shuffle_width(docs.sparkSession)
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / width for i in range(1, width)], 0.2 / width))) if width > 1 else []
    part = F.lit(0)
    if bounds:
        limits = F.array(*[F.lit(int(x)) for x in bounds])
        part = F.size(F.filter(limits, lambda x: x <= F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))))
    rows = rows.withColumn("part", part.cast("int"))
    # One row a range: its first document.
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "tie")
    firsts = sorted((r["part"], r["first"]) for r in rows.groupBy("part").agg(F.min(order).alias("first")).collect())
    if not firsts:
        return docs.sparkSession.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    width = firsts[-1][0] + 1
    key, before = [None] * width, [None] * width
    for i, (p, f) in enumerate(firsts):
        key[p], before[p] = f"{f['known']}:{f['doc_id']}:{f['tie']}".lower(), firsts[i - 1][0]
    own = F.concat_ws(":", F.col("doc_id").isNotNull().cast("string"), F.coalesce("doc_id", F.lit(0)).cast("string"), F.col("tie").cast("string"))
    of_part = lambda values, kind: F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("part") + 1)
    target = F.when(own == of_part(key, "string"), of_part(before, "int"))
    copies = F.filter(F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")),
        F.struct(target.alias("part"), F.lit(True).alias("guest"))), lambda c: c["part"].isNotNull())
    dealt = rows.select("doc_id", "text", "tie", F.inline(copies))
    dealt = dealt.repartitionById(width, "part").sortWithinPartitions("part", "guest", "doc_id", "tie")
    return dealt.mapInArrow(_in_order, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

"""Repeated passages: word windows that an earlier document has too, found by super-k-mers.

A window is ``window`` consecutive words of one document. Its minimiser is the
least hash among the runs of ``m`` words in it, so equal windows have equal
minimisers wherever they stand. Consecutive windows with the same minimiser travel
as one packed string, their words joined by a blank, to the bucket of that
minimiser, where all places of a window meet; windows are sorted there
and the least document of each is read off.

* A packed string that occurs more than once in a block of documents travels for
  the least of these documents only: the others hold nothing but windows of a smaller
  document and are marked where they are. So a passage in a third of all
  documents sends one string a block.
* A minimiser with too many windows (counted over all documents) would fill a
  bucket with different strings. Its windows travel singly, dealt by the hash
  of the whole window. At most 2 ** 22 minimisers can hold 2 ** -22 of all windows
  each, so the list of them has 32 MB at most.
* The number of buckets grows with the text, about 16 MB of packed strings each;
  a shuffle partition takes many of them, one after the other. A block's strings for
  one bucket are one compressed value.

What comes back are (start, mask) pairs: bit i of mask is set if the window
at word start + i is to be removed. Only they meet the texts again.

Nulls and odd rows: a null or empty text has no words, a text with fewer than
``window`` words no windows. Windows are judged on the input, not on what is left. A
null doc_id counts as larger than all others; rows of one doc_id (repeated rows,
different texts) never remove windows of each other. Very long texts are packed
whole, one at a time. Extra columns are ignored unless asked for. An empty table
gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_hash, shuffle_width, stored

WINDOW, MINIMISER = 13, 3
#: Bytes of text packed at once, bytes of packed strings in a bucket, windows in a packed string (one bit of a mask each).
BLOCK_BYTES, BUCKET_BYTES, MASK = 3 << 20, 16 << 20, 63
#: A minimiser is split if it has more windows than this, and more than 2 ** -HOT_SHARE of all.
HOT_WINDOWS, HOT_SHARE = 200_000, 22


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no order of the words behind."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of every run of n words, from the words' own."""
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = _mixed(out + h[i:len(h) - n + 1 + i])
    return out


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (width - size)], v[width - size:])


class Packed:
    """The super-k-mers of a block of texts: text index, first word, number of windows, key; ``strings`` packs their words."""

    def __init__(self, texts: list[str | None], window: int, m: int, hot: np.ndarray | None):
        words = [(t or "").encode().split() for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        every = [w for ws in words for w in ws]
        n = len(every)
        self.text = self.start = self.windows = np.zeros(0, np.int64)
        self.key, self.words, self.first, self.length = np.zeros(0, np.uint64), every, self.start, self.start
        if n < window:
            return
        h = np.fromiter(map(zlib.crc32, every), np.uint64, n)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        least = sliding_least(run_hashes(h, m), window - m + 1)
        at = np.flatnonzero(owner[:n - window + 1] == owner[window - 1:])
        if not len(at):
            return
        key = least[at]
        cut = np.ones(len(at), bool)
        cut[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
        if hot is not None and len(hot):
            single = np.isin(key, hot)
            if single.any():
                cut[1:] |= single[1:] | single[:-1]
                key = np.where(single, run_hashes(h, window)[at], key)
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(cut, np.arange(len(at)), 0))
        cut |= nth % MASK == 0
        heads = np.flatnonzero(cut)
        self.windows = np.diff(np.append(heads, len(at)))
        first = at[heads]
        self.key, self.text = key[heads], owner[first]
        self.start = first - (ends - sizes)[self.text]
        self.first, self.length = first, self.windows + window - 1

    def strings(self) -> list[bytes]:
        if not len(self.first):
            return []
        joined = b" ".join(self.words)
        stop = np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1) - 1
        begin = np.concatenate([[0], stop + 1])[self.first]
        return [joined[a:z] for a, z in zip(begin.tolist(), stop[self.first + self.length - 1].tolist())]


def text_blocks(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about BLOCK_BYTES at most, with the place of the first; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    a = held = 0
    for i, n in enumerate([*sizes, BLOCK_BYTES + 1]):
        if i > a and held + n > BLOCK_BYTES:
            yield a, column.slice(a, i - a).to_pylist()
            a = i
            held = 0
        held += n


def _counts(window: int, m: int):
    """(key, n) of each minimiser and its windows, added up in every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in text_blocks(b.column("text")):
                p = Packed(texts, window, m, None)
                keys, which = np.unique(p.key, return_inverse=True)
                n = np.bincount(which, p.windows, minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])
    return run


def hot_minimisers(texts: DataFrame, window: int, m: int, least: int = HOT_WINDOWS) -> np.ndarray:
    """The minimisers whose windows travel singly, from counts over all texts."""
    counts = stored(texts.select("text").mapInArrow(_counts(window, m), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "minimisers")
    total = counts.agg(F.sum("n")).first()[0]
    if total is None:
        return np.zeros(0, np.uint64)
    # All windows are at least those of the counted keys, so no more than 2 ** HOT_SHARE keys can pass.
    found = counts.where(F.col("n") >= max(least, total >> HOT_SHARE)).select("key").toArrow()
    return np.sort(found.column("key").to_numpy().astype(np.int64).view(np.uint64))


def encoded(doc: np.ndarray, unknown: np.ndarray, row: np.ndarray, start: np.ndarray, key: np.ndarray, packed: list[bytes], press: zstandard.ZstdCompressor) -> bytes:
    """Super-k-mers of one bucket as one compressed value."""
    parts = [len(packed).to_bytes(8, "little"), doc.astype(np.int64).tobytes(), unknown.astype(np.uint8).tobytes(), row.astype(np.int64).tobytes(),
             start.astype(np.int64).tobytes(), key.astype(np.uint64).tobytes(), b"\n".join(packed)]
    return press.compress(b"".join(parts))


def decoded(blob: bytes) -> tuple:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int.from_bytes(data[:8], "little"), 8
    out = []
    for kind, size in ((np.int64, 8), (np.uint8, 1), (np.int64, 8), (np.int64, 8), (np.uint64, 8)):
        out.append(np.frombuffer(data, kind, n, at))
        at += size * n
    return (*out, data[at:])


MARKS = "doc_id long, row long, start array<long>, mask array<long>"
SENT = f"bucket long, blob binary, {MARKS}"


def marks_of(doc: np.ndarray, unknown: np.ndarray, row: np.ndarray, start: np.ndarray, mask: np.ndarray) -> list[pa.Array]:
    """One row a document with the starts and masks of its marked strings."""
    order = np.lexsort((start, row, doc, unknown))
    doc, unknown, row, start, mask = (x[order] for x in (doc, unknown, row, start, mask))
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(row) != 0) | (unknown[1:] != unknown[:-1])])[:len(doc)])
    offsets = pa.array(np.append(heads, len(doc)), pa.int32())
    return [pa.array(doc[heads], pa.int64(), mask=unknown[heads].astype(bool)), pa.array(row[heads], pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(start, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(mask, pa.int64()))]


def _sent(window: int, m: int, n_buckets: int, hot: np.ndarray):
    """One row a bucket and block with its packed strings; one row a packed string that is marked where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            order = pc.sort_indices(pa.table({"doc_id": b.column("doc_id"), "row": b.column("row")}), sort_keys=[("doc_id", "ascending"), ("row", "ascending")], null_placement="at_end")
            b = b.take(order)
            doc, row = b.column("doc_id"), b.column("row").to_numpy()
            unknown = doc.is_null().to_numpy(zero_copy_only=False)
            doc = doc.fill_null(0).to_numpy()
            # Equal rows are one document.
            again = np.zeros(len(row), bool)
            again[1:] = (doc[1:] == doc[:-1]) & (unknown[1:] == unknown[:-1]) & (row[1:] == row[:-1])
            fresh = np.flatnonzero(~again)
            doc, row, unknown = doc[fresh], row[fresh], unknown[fresh]
            for a, texts in text_blocks(b.column("text").take(pa.array(fresh))):
                z = a + len(texts)
                yield _block(Packed(texts, window, m, hot), doc[a:z], unknown[a:z], row[a:z], n_buckets, press)
    return run


def _block(p: Packed, doc: np.ndarray, unknown: np.ndarray, row: np.ndarray, n_buckets: int, press: zstandard.ZstdCompressor) -> pa.RecordBatch:
    packed = p.strings()
    seen: dict[bytes, int] = {}
    first = np.fromiter(map(seen.setdefault, packed, range(len(packed))), np.int64, len(packed))
    del seen
    rank = np.zeros(len(doc), np.int64)
    if len(doc):
        rank[1:] = np.cumsum((doc[1:] != doc[:-1]) | (unknown[1:] != unknown[:-1]))
    here = rank[p.text[first]] < rank[p.text]
    bucket = (p.key % np.uint64(n_buckets)).astype(np.int64)
    away = np.flatnonzero(~here)
    away = away[np.lexsort((p.key[away], bucket[away]))]
    cuts = np.flatnonzero(np.diff(bucket[away], prepend=-1))
    blobs, to = [], []
    for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(away)]):
        i = away[a:z]
        t = p.text[i]
        blobs.append(encoded(doc[t], unknown[t], row[t], p.start[i], p.key[i], [packed[j] for j in i.tolist()], press))
        to.append(bucket[i[0]])
    done = np.flatnonzero(here)
    t, k = p.text[done], len(blobs)
    mask = ((np.uint64(1) << p.windows[done].astype(np.uint64)) - np.uint64(1)).view(np.int64)
    marks = marks_of(doc[t], unknown[t], row[t], p.start[done], mask)
    n = len(marks[0])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([np.array(to, np.int64), np.arange(n) % n_buckets])), pa.array([*blobs, *[None] * n], pa.binary()),
         *[pa.concat_arrays([pa.nulls(k, x.type), x]) for x in marks]],
        names=["bucket", "blob", "doc_id", "row", "start", "mask"])


def window_ids(codes: np.ndarray, window: int) -> np.ndarray:
    """A number for each run of ``window`` codes, equal for equal runs only: ranks of pairs, doubled in length."""
    size, ids = 1, codes.astype(np.int64)
    while 2 * size <= window:
        ids, size = _pair_ids(ids[:-size], ids[size:]), 2 * size
    rest = window - size
    return _pair_ids(ids[:len(ids) - rest], ids[rest:]) if rest else ids


def _pair_ids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeats(blobs: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(doc, unknown, row, start, mask) of the super-k-mers of a bucket that hold windows of smaller documents."""
    parts = [decoded(x) for x in blobs]
    doc, unknown, row, start, key = (np.concatenate([p[i] for p in parts]) for i in range(5))
    packed = pa.array([x for p in parts for x in p[5].split(b"\n")], pa.binary())
    del parts
    order = np.lexsort((doc, unknown))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], (np.diff(doc[order]) != 0) | (np.diff(unknown[order].astype(np.int8)) != 0)])) if len(order) else 0
    # Strings of a minimiser that only one document has need no look.
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    shared = np.minimum.reduceat(rank[order], heads) < np.maximum.reduceat(rank[order], heads)
    look = np.sort(order[np.repeat(shared, np.diff(np.append(heads, len(order))))])
    if not len(look):
        return tuple(x[:0] for x in (doc, unknown, row, start, start))
    words = pc.split_pattern(packed.take(pa.array(look)), " ")
    offsets = words.offsets.to_numpy().astype(np.int64)
    codes = words.flatten().dictionary_encode().indices.to_numpy()
    n = np.diff(offsets) - window + 1
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    ids = window_ids(codes, window)[np.repeat(offsets[:-1] - offsets[0], n) + nth]
    ranks = np.repeat(rank[look], n)
    order = np.lexsort((ranks, ids))
    heads = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0]))
    late = np.empty(len(ids), bool)
    late[order] = ranks[order] > np.repeat(ranks[order][heads], np.diff(np.append(heads, len(order))))
    mask = np.bitwise_or.reduceat(late.astype(np.int64) << nth, np.cumsum(n) - n)
    hit = mask != 0
    look = look[hit]
    return doc[look], unknown[look], row[look], start[look], mask[hit]


def _marks(window: int):
    """The marks of each bucket, whose rows come one after the other."""

    def found(blobs: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(marks_of(*repeats(blobs, window)), names=["doc_id", "row", "start", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for b in batches:
            done = b.filter(b.column("blob").is_null())
            if done.num_rows:
                yield done.select(["doc_id", "row", "start", "mask"])
            for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("blob")):
                if bucket != now and blobs:
                    yield found(blobs)
                    blobs = []
                now = bucket
                if blob.is_valid:
                    blobs.append(blob.as_py())
        if blobs:
            yield found(blobs)
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document, from rows that come document by document: no more than a document's own marks are held."""
    def out(rows: list) -> pa.RecordBatch:
        columns = [[d for (d, _), _ in rows], [r for (_, r), _ in rows], [list(m) for _, m in rows], [list(m.values()) for _, m in rows]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "row", "start", "mask"])

    now, held, done = None, {}, []
    for b in batches:
        for d, r, start, mask in zip(*[b.column(c).to_pylist() for c in ("doc_id", "row", "start", "mask")]):
            if (d, r) != now:
                if now is not None:
                    done.append((now, held))
                now, held = (d, r), {}
            for s, m in zip(start, mask):
                held[s] = held.get(s, 0) | m
        if done:
            yield out(done)
            done = []
    if now is not None:
        yield out([(now, held)])


def marked_windows(docs: DataFrame, window: int = WINDOW, m: int = MINIMISER, hot_windows: int = HOT_WINDOWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, row, start, mask) of the documents with windows that start in a document of smaller doc_id too.

    start and mask are arrays, one entry a marked string; row is the hash of a row's doc_id and text.
    """
    if not 1 <= m <= window:
        raise ValueError("a minimiser has between one word and a window's words")
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row().alias("row"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size * window // (bucket_bytes * 4)) + 1
    hot = hot_minimisers(rows, window, m, hot_windows)
    sent = rows.mapInArrow(_sent(window, m, n, hot), SENT)
    width = min(n, shuffle_width(spark))
    met = sent.repartitionById(width, F.expr(f"cast(pmod(bucket, {width}) as int)")).sortWithinPartitions("bucket")
    marks = stored(met.mapInArrow(_marks(window), MARKS), "marks")
    return marks.repartition("doc_id", "row").sortWithinPartitions("doc_id", "row").mapInArrow(_merged, MARKS)


def _row() -> Column:
    return row_hash(F.col("doc_id").cast("long"), F.col("text"))


def covered(n_words: int, start: np.ndarray, mask: np.ndarray, window: int) -> np.ndarray:
    """Which of a text's words lie in a marked window."""
    edges = np.zeros(n_words + 1, np.int64)
    which, bit = np.nonzero((mask[:, None] >> np.arange(MASK)) & 1)
    at = start[which] + bit
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:n_words] > 0


def _kept(window: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for t, start, mask in zip(b.column("text"), b.column("m_start"), b.column("m_mask")):
                words = (t.as_py() or "").encode().split()
                gone = covered(len(words), start.values.to_numpy(), mask.values.to_numpy(), window) if start.is_valid else None
                n_words.append(len(words))
                n_removed.append(0 if gone is None else int(gone.sum()))
                kept.append((b" ".join(words) if gone is None else b" ".join([w for w, g in zip(words, gone.tolist()) if not g])).decode())
            yield pa.RecordBatch.from_arrays([*[b.column(f"k{i}") for i in range(len(columns))], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=[*[f"k{i}" for i in range(len(columns))], "n_words", "n_removed", "kept"])
    return run


def without_repeats(docs: DataFrame, columns: list[str], window: int = WINDOW, m: int = MINIMISER, **how) -> DataFrame:
    """``columns`` of every row of docs with n_words, n_removed and kept, the words left, joined by one blank."""
    if {"n_words", "n_removed", "kept"} & set(columns):
        raise ValueError("n_words, n_removed and kept are results, not columns to pass on")
    marks = marked_windows(docs, window, m, **how).withColumnsRenamed({"doc_id": "m_doc", "row": "m_row", "start": "m_start", "mask": "m_mask"})
    named = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)], "text", F.col("doc_id").cast("long").alias("n_doc"), _row().alias("n_row"))
    met = named.join(marks, (F.col("n_row") == F.col("m_row")) & F.col("n_doc").eqNullSafe(F.col("m_doc")), "left").drop("n_doc", "n_row", "m_doc", "m_row")
    types = [docs.schema[c].dataType.simpleString() for c in columns]
    schema = ", ".join([*[f"k{i} {t}" for i, t in enumerate(types)], "n_words long", "n_removed long", "kept string"])
    return met.mapInArrow(_kept(window, columns), schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(columns)})

"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts of up to ORDER bytes, held as tables: for
each context and next symbol, how often training texts have it. A symbol's
probability is its share in the longest context; where a context has not seen
it, an escape is paid (by method C: as many parts as the context has different
symbols) and the next shorter context is asked, with the symbols of the longer
one excluded. Below order 0 all symbols left are equally likely. A text is its
bytes and one end symbol; its start is marked by a symbol of its own.

Both directions go through Spark, and neither the trie nor the word counts are
ever in one place: texts are dealt into chunks of bounded size by a hash of the
row; each chunk reports its different windows (context and symbol) and words
once, with their counts in training texts; Spark sums these over all chunks,
works out each window's code length level by level with joins and windows over
contexts (a context has at most 258 symbols), and sends every chunk the answers
for what it reported.

Nulls and odd rows: a null text counts as empty and has just the end symbol; a
null doc_id counts as the empty text where ids are hashed. Repeated rows are
counted and scored as often as they occur. Without training texts every symbol is
equally likely. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, row_hash, shuffle_width, shuffles_dropped, stored

ORDER = 4
#: Symbols: 0 marks the start, bytes are 1 to 256, 257 is the end; SYMBOL bits hold one.
START, END, ALPHABET, SYMBOL = 0, 257, 257, 9
#: Bytes of text that a chunk has on average.
CHUNK_BYTES = 12 << 20
#: Bytes of text whose windows are held as arrays at once; a longer text is a run of its own.
RUN_BYTES = 1 << 20
LN10 = float(np.log(10))


def windows(text: bytes) -> np.ndarray:
    """For each symbol of the text and its end: the ORDER symbols before it and itself, packed."""
    s = np.empty(len(text) + ORDER + 1, np.int64)
    s[:ORDER], s[-1] = START, END
    s[ORDER:-1] = np.frombuffer(text, np.uint8)
    s[ORDER:-1] += 1
    n = len(text) + 1
    out = s[:n].copy()
    for i in range(1, ORDER + 1):
        out <<= SYMBOL
        out |= s[i:i + n]
    return out


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _joined(texts: list[bytes]) -> np.ndarray:
    return np.concatenate([windows(t) for t in texts]) if texts else np.zeros(0, np.int64)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one chunk, in order."""
    for b in batches:
        chunk = b.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for a, z in zip(cuts, cuts[1:]):
            if z > a:
                yield int(chunk[a]), b.slice(a, z - a)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, word or code, n) of the different words and windows of each chunk, n being their number in training texts."""
    now, seen, parts = None, Counter(), []
    for chunk, rows in _grouped(batches):
        if chunk != now and now is not None:
            yield from _flush(now, seen, parts)
            seen, parts = Counter(), []
        now = chunk
        texts = [(t.as_py() or "").encode() for t in rows.column("text")]
        held = rows.column("held_out").to_pylist()
        for t, out in zip(texts, held):
            if out:
                for w in set(words(t)):
                    seen[w] += 0
            else:
                seen.update(words(t))
        for out in (True, False):
            mine = [t for t, h in zip(texts, held) if h == out]
            for a, z in blocks(mine, RUN_BYTES):
                ids, codes = pd.factorize(_joined(mine[a:z]))
                parts.append((codes, np.zeros(len(codes), np.int64) if out else np.bincount(ids, minlength=len(codes))))
        if len(parts) > 16:
            parts = [_merged(parts)]
    if now is not None:
        yield from _flush(now, seen, parts)


def _flush(chunk: int, seen: Counter, parts: list) -> Iterator[pa.RecordBatch]:
    codes, n = _merged(parts)
    for word, code, times in ((pa.array(seen.keys(), pa.binary()), pa.nulls(len(seen), pa.int64()), pa.array(seen.values(), pa.int64())),
                              (pa.nulls(len(codes), pa.binary()), pa.array(codes, pa.int64()), pa.array(n, pa.int64()))):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(times), chunk, np.int32)), word, code, times], names=["chunk", "word", "code", "n"])


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    ids, codes = pd.factorize(np.concatenate([c for c, _ in parts]))
    n = np.bincount(ids, np.concatenate([x for _, x in parts]), minlength=len(codes))
    return codes, n.astype(np.int64)


def code_lengths(counts: DataFrame) -> DataFrame:
    """(key, logp) of each window of counts (key, n), of whose symbols all contexts are taken from rows with n > 0.

    logp is the natural logarithm of the symbol's probability after its context.
    Level by level: below(w) is what coding w's symbol costs once all longer
    contexts than w's own, less its first symbol, have been escaped from.
    """
    def level(j: int) -> DataFrame:
        mask = (1 << (SYMBOL * (j + 1))) - 1
        t = counts if j == ORDER else counts.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
        context = Window.partitionBy(F.shiftright("key", SYMBOL))
        return t.select("key", "n", F.sum("n").over(context).alias("all"), F.sum((F.col("n") > 0).cast("long")).over(context).alias("kinds"))

    # A window over contexts of order 0 is one group of at most 258 rows.
    lower = level(0)
    lower = lower.withColumn("below", -F.log(F.greatest(F.lit(ALPHABET) - F.col("kinds"), F.lit(1)).cast("double")))
    for j in range(1, ORDER + 1):
        mask = (1 << (SYMBOL * j)) - 1
        low = lower.select(F.col("key").alias("suffix"), F.col("n").alias("low_n"), F.col("all").alias("low_all"), F.col("kinds").alias("low_kinds"), F.col("below").alias("low_below"))
        t = level(j).withColumn("suffix", F.col("key").bitwiseAND(F.lit(mask))).join(low, "suffix")
        context = Window.partitionBy(F.shiftright("key", SYMBOL))
        t = t.withColumn("excluded", F.sum(F.when(F.col("n") > 0, F.col("low_n")).otherwise(0)).over(context))
        rest = (F.col("low_all") - F.col("excluded")).cast("double")
        kinds = (F.col("low_kinds") - F.col("kinds")).cast("double")
        below = (
            F.when(kinds <= 0, F.col("low_below"))
            .when(F.col("low_n") > 0, F.log(F.col("low_n") / (rest + kinds)))
            .otherwise(F.log(kinds / (rest + kinds)) + F.col("low_below"))
        )
        lower = t.select("key", "n", "all", "kinds", below.alias("below"))
    total = (F.col("all") + F.col("kinds")).cast("double")
    logp = (
        F.when(F.col("all") == 0, F.col("below"))
        .when(F.col("n") > 0, F.log(F.col("n") / total))
        .otherwise(F.log(F.col("kinds") / total) + F.col("below"))
    )
    return lower.select("key", logp.alias("logp"))


def _answer(ends: int, total: int, base: float):
    """Scores the texts of each chunk, whose rows come after the answers to what it reported."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, codes, logs, index, counts = None, {}, [], [], None, None
        for chunk, rows in _grouped(batches):
            if chunk != now:
                now, known, codes, logs, index = chunk, {}, [], [], None
            kind = rows.column("kind").to_numpy()
            for k in (0, 1):
                part = rows.filter(pa.array(kind == k))
                if part.num_rows and k == 0:
                    known.update(zip(part.column("word").to_pylist(), part.column("n").to_pylist()))
                elif part.num_rows:
                    codes.append(part.column("code").to_numpy())
                    logs.append(part.column("logp").to_numpy())
            docs = rows.filter(pa.array(kind == 2))
            if not docs.num_rows:
                continue
            if index is None:
                index, counts = pd.Index(np.concatenate(codes)), np.concatenate(logs)
                codes, logs = [], []
            out = {x: [] for x in ("n_tokens", "n_known", "base_score", "score")}
            for t in docs.column("text"):
                text = (t.as_py() or "").encode()
                c = np.fromiter(map(known.__getitem__, words(text)), np.int64)
                out["n_tokens"].append(len(c) + 1)
                out["n_known"].append(int((c > 0).sum()) + (ends > 0))
                out["base_score"].append(float(np.log10(c + 1.0).sum() + np.log10(ends + 1.0) - (len(c) + 1) * base))
                out["score"].append(float(counts[index.get_indexer(windows(text))].sum() / LN10))
            yield pa.RecordBatch.from_arrays(
                [docs.column("doc_id"), docs.column("held_out"), pa.array(out["n_tokens"], pa.int64()), pa.array(out["n_known"], pa.int64()),
                 pa.array(np.full(docs.num_rows, total, np.int64)), pa.array(out["base_score"], pa.float64()), pa.array(out["score"], pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text).

    Rows for which ``held_out`` is true are scored but not learned from. score is
    the PPM model's log10 probability of the text; base_score is that of a word
    unigram model with one added to each count.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    size, ends = rows.agg(F.sum(F.octet_length("text")), F.count(F.when(~F.col("held_out"), 1))).first()
    n = int((size or 0) // CHUNK_BYTES) + 1
    rows = rows.withColumn("chunk", F.pmod(row_hash(F.col("doc_id"), F.col("text")), F.lit(n)).cast("int"))
    # A partition takes many chunks in order, so the shuffle is as wide as the session says, however many chunks there are.
    spark = docs.sparkSession
    width = min(n, shuffle_width(spark))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartitionById(width, F.expr(f"chunk % {width}"))

    with shuffles_dropped(spark):
        heard = stored(dealt(rows).sortWithinPartitions("chunk").mapInArrow(_report, "chunk int, word binary, code long, n long"), "reports")
        words = heard.where("word is not null").select("chunk", "word", "n")
        totals = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
        seen = heard.where("code is not null").select("chunk", F.col("code").alias("key"), "n")
        counts = stored(seen.groupBy("key").agg(F.sum("n").alias("n")), "windows")
        lengths = stored(code_lengths(counts), "code_lengths")
    facts = totals.where("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, kinds = (facts["n"] or 0) + ends, facts["v"] + (ends > 0)
    # A common word has a row a chunk: the join can be split where an aggregate or window could not.
    known = words.select("chunk", "word").join(totals, "word")
    empty = {"word": "binary", "n": "long", "code": "long", "logp": "double", "doc_id": "long", "text": "string", "held_out": "boolean"}

    def as_row(df: DataFrame, kind: int) -> DataFrame:
        return df.select("chunk", F.lit(kind).alias("kind"), *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in empty.items()])

    windows_back = seen.join(lengths, "key").select("chunk", F.col("key").alias("code"), "logp")
    everything = as_row(known.select("chunk", "word", "n"), 0).unionByName(as_row(windows_back, 1)).unionByName(as_row(rows, 2))
    everything = dealt(everything).sortWithinPartitions("chunk", "kind")
    base = float(np.log10(total + kinds + 1.0))
    return everything.mapInArrow(
        _answer(ends, total, base),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

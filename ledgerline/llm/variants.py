"""Spelling variants: words one edit apart, by composing vocabulary acceptors with a one-edit transducer.

The pairs wanted are the accepted pairs of A o E o A, where A is the minimised acceptor
of the vocabulary and E copies its input but for one replaced or inserted symbol.
Where the edit falls decides who enumerates a pair. Let l be the length of the shorter
word and a that of the common prefix, 0 <= a <= l. A partition (l, from, to) takes
the pairs with from <= a < to: both words then have their first ``from`` and, up
to the edit, their last l - to symbols in common, so the composed machine starts
from the state that this prefix leads to and the partition's key is (l, from, to,
prefix, suffix). Each word is in the lower and the upper half of the range for its own
length and for the length before (as the longer one). A partition of over ``most``
words is cut at the middle of its range again; ranges of one place
hold words that agree but for one symbol, so every partition gets small.

In a partition the middles of the words of length l and l + 1 are built into two
minimised acceptors, whose states are numbered from the end. Products of states are
enumerated once each: for a replacement two different symbols into states whose
right languages meet, for an insertion one symbol of the longer word alone, next to
another one of the shorter, which makes the edit the first difference and each
pair unique. A word leaves a partition as one row with its number of near words and
the best of them, so rows never grow with pairs.

Forms are followed to their roots by joining the table of forms with itself; the
steps a root is away double each round, and counts double each step, so a few
rounds do.

Nulls and odd rows: a null text has no words; a null doc_id counts as the empty
text; repeated rows count again. Very long texts are read in pieces cut between runs.
Words are in code-point order. Extra columns are ignored. An empty table gives an
empty table.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored

RUN, GAP = re.compile("[A-Za-zÀ-ÿ]+"), re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = str.maketrans(UPPER, LOWER)
MIN_LENGTH, MIN_COUNT, FACTOR = 5, 3, 2
#: Words in a partition, characters of text read at once, different words a task holds before it passes them on.
MOST_WORDS, PIECE, HELD_WORDS = 10_000, 1 << 20, 300_000
NOISE = 97


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that end between runs."""
    a = 0
    while len(text) - a > PIECE:
        gap = GAP.search(text, a + PIECE)
        z = gap.start() if gap else len(text)
        yield text[a:z]
        a = z
    yield text[a:]


def document_words(doc_id: int | None, text: str, min_length: int, noise: int) -> Iterator[tuple[str, int]]:
    """(word, times) of a document: lower-cased runs, some of which lose the code point that their hash names."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs: Counter[str] = Counter()
    for piece in pieces(text):
        runs.update(RUN.findall(piece))
    for run, n in runs.items():
        if len(run) < min_length:
            continue
        run = run.translate(_LOWER)
        h = zlib.crc32(run.encode(), seed)
        if noise and h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= min_length:
            yield run, n


def _counted(min_length: int, noise: int):
    def out(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                if text.is_valid:
                    for word, n in document_words(doc_id, text.as_py(), min_length, noise):
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield out(total)
                    total.clear()
        yield out(total)
    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n) of the words of all texts that occur ``min_count`` times or more."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_counted(min_length, noise), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Acceptor:
    """The minimal acyclic automaton of sorted words of one length. State 0 is the end; arcs lead to lower numbers."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        known: dict[tuple, int] = {}
        length = len(words[0]) if words else 0
        open_: list[dict[str, int]] = [{} for _ in range(length + 1)]
        last = ""
        for word in [*words, None]:
            same = 0
            if word is not None:
                top = min(len(last), len(word))
                while same < top and last[same] == word[same]:
                    same += 1
            for d in range(len(last) - 1, same - 1, -1):
                open_[d][last[d]] = self._state(open_[d + 1], known) if d + 1 < length else 0
                open_[d + 1] = {}
            last = word or ""
        self.start = self._state(open_[0], known) if length else 0

    def _state(self, arcs: dict[str, int], known: dict[tuple, int]) -> int:
        key = tuple(arcs.items())
        state = known.get(key)
        if state is None:
            state = known[key] = len(self.arcs)
            self.arcs.append(arcs)
        return state


class Composed:
    """Pairs of a's and b's words with one edit between them."""

    def __init__(self, a: Acceptor, b: Acceptor):
        self.a, self.b = a, b
        self.shared: dict[tuple[int, int], list[str]] = {(0, 0): [""]}
        self.one: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def common(self, p: int, q: int) -> list[str]:
        """What both states accept."""
        found = self.shared.get((p, q))
        if found is None:
            down, across = self.a.arcs[p], self.b.arcs[q]
            found = self.shared[p, q] = [c + rest for c in down.keys() & across.keys() for rest in self.common(down[c], across[c])]
        return found

    def replaced(self) -> list[tuple[str, str]]:
        """Pairs of one replacement, for a acceptor composed with itself; the lesser word first."""
        made: list[list[tuple[str, str]]] = [[]]
        for arcs in self.a.arcs[1:]:
            pairs = [(c + x, c + y) for c, to in arcs.items() for x, y in made[to]]
            if len(arcs) > 1:
                order = sorted(arcs.items())
                for i, (c, p) in enumerate(order):
                    for d, q in order[i + 1:]:
                        pairs += [(c + rest, d + rest) for rest in self.common(p, q)]
            made.append(pairs)
        return made[self.a.start]

    def inserted(self, p: int, q: int) -> list[tuple[str, str]]:
        """Pairs from states p of a and q of b whose second word has one symbol more; the first difference is the edit."""
        found = self.one.get((p, q))
        if found is not None:
            return found
        found = self.one[p, q] = []
        down = self.a.arcs[p]
        for c, r in self.b.arcs[q].items():
            after = self.b.arcs[r]
            if p == 0:
                if r == 0:
                    found.append(("", c))
                continue
            for e in down.keys() & after.keys():
                if e != c:
                    found += [(e + rest, c + e + rest) for rest in self.common(down[e], after[e])]
            if c in down:
                found += [(c + x, c + y) for x, y in self.inserted(down[c], r)]
        return found


def near_in_partition(state: str, words: list[tuple[str, int]]) -> list[tuple[str, int, int, str]]:
    """(word, n_near, best_n, best) of the words of a partition (word, n) that have near words whose edit is the partition's."""
    length, low, high = map(int, state.split(":", 3)[:3])
    tail = max(length - high, 0)
    cut = {w: w[low:len(w) - tail] for w, _ in words}
    n = dict(words)
    short = {cut[w]: w for w in n if len(w) == length}
    if not short:
        return []
    long = {cut[w]: w for w in n if len(w) == length + 1}
    a = Acceptor(sorted(short))
    pairs = [(short[x], short[y]) for x, y in Composed(a, a).replaced()] if len(short) > 1 else []
    if long:
        b = Acceptor(sorted(long))
        # A difference behind the range is another partition's.
        pairs += [(short[x], long[y]) for x, y in Composed(a, b).inserted(a.start, b.start) if len(x) < high - low or not y.startswith(x)]
    near: dict[str, tuple[int, int, str]] = {}
    for x, y in pairs:
        for word, other in ((x, y), (y, x)):
            k, best_n, best = near.get(word, (0, 0, ""))
            m = n[other]
            near[word] = (k + 1, m, other) if m > best_n or m == best_n and other < best else (k + 1, best_n, best)
    return [(w, *v) for w, v in near.items()]


NEAR = "word string, n_near long, best_n long, best string"


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The near words of each partition, whose rows come one after the other."""
    sys.setrecursionlimit(1 << 30)

    def out(rows: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["word", "n_near", "best_n", "best"])

    now, words, done = None, [], []
    for b in batches:
        for state, word, n in zip(*[b.column(c).to_pylist() for c in ("state", "word", "n")]):
            if state != now:
                if len(words) > 1:
                    done += near_in_partition(now, words)
                now, words = state, []
            words.append((word, n))
        if done:
            yield out(done)
            done = []
    if len(words) > 1:
        yield out(near_in_partition(now, words))


def _state(length: Column, low: Column, high: Column) -> Column:
    """The key of a word's partition: length, range, and the symbols that the range leaves to both sides."""
    word = F.col("word")
    tail = F.greatest(length - high, F.lit(0))
    return F.concat_ws(":", length, low, high, F.substr(word, F.lit(1), low), F.when(tail > 0, F.substr(word, F.length(word) - tail + 1, tail)).otherwise(""))


def _halves(rows: DataFrame) -> DataFrame:
    """(word, n, length, low, high) rows, each in both halves of its range."""
    middle = F.expr("cast((low + high) div 2 as int)")
    ranges = F.explode(F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high"))))
    rows = rows.select("word", "n", "length", ranges.alias("range")).select("word", "n", "length", "range.low", "range.high")
    return rows.withColumn("state", _state(F.col("length"), F.col("low"), F.col("high")))


def partitions(words: DataFrame, min_length: int = MIN_LENGTH, most: int = MOST_WORDS) -> DataFrame:
    """(state, word, n): each word in the partitions whose pairs it may be part of, none over ``most`` words that can be cut."""
    own = F.length("word")
    lengths = F.explode(F.when(own > min_length, F.array(own, own - 1)).otherwise(F.array(own)))
    rows = words.select("word", "n", lengths.alias("length")).withColumns({"low": F.lit(0), "high": F.col("length") + 1})
    rows = stored(_halves(rows), "states")
    while True:
        large = rows.where("high - low > 1").groupBy("state").agg(F.count("*").alias("size")).where(F.col("size") > most).select("state")
        large = stored(large, "large_states")
        if large.isEmpty():
            return rows.select("state", "word", "n")
        cut = _halves(rows.join(large, "state", "left_semi"))
        rows = stored(rows.join(large, "state", "left_anti").unionByName(cut), "states")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, most: int = MOST_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones; best is the near word of largest n, then least."""
    dealt = partitions(words, min_length, most).repartition("state").sortWithinPartitions("state")
    found = dealt.mapInArrow(_near, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each word's chain of forms."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = stored(now.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE, factor: int = FACTOR, most: int = MOST_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    form is the near word of largest n if that is ``factor`` times the word's n or more.
    ``noise``: one in so many runs of a document loses a code point (0: none).
    """
    words = stored(vocabulary(docs, min_length, min_count, noise), "vocabulary")
    near = near_words(words, min_length, most).withColumnRenamed("word", "near_word")
    met = words.join(near, F.col("word") == F.col("near_word"), "left")
    formed = F.col("best_n") >= F.col("n") * factor
    met = stored(met.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(met.where("form is not null").select("word", "form")).withColumnsRenamed({"word": "end_word", "root": "end_root"})
    return met.join(ends, F.col("word") == F.col("end_word"), "left").select("word", "form", F.coalesce("end_root", "word").alias("root"), "n", "n_near", "form_n")

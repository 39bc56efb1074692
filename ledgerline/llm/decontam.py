"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

A passage of m characters that occurs with at most k edits shares at least
m - q + 1 - k q of its q-grams with the place where it occurs, and these lie on
diagonals (place in the document less place in the passage) that are no more
than k apart. So hits of the passage's q-grams are counted in overlapping bands
of diagonals, the bands that reach the bound are kept, and there the passage is
aligned within the band to settle the number of edits.

q-grams that a block's passages have many times (over ``HEAVY``: stock phrases, runs of one
letter) aren't counted in bands, where they would hit everywhere; a passage's bound is
lowered by as many as it has of them, which keeps the lemma. A passage of which nothing would be left to count is
held against a text if their common q-grams, wherever they lie, reach the bound. Before any
alignment a bit-parallel pass over the place (or the text) counts the least edits, and
most places end there.

The benchmark is the query set: it goes through the driver in blocks of about 2 MB of text, and
each block is held against all documents, whole texts, in one pass. That is meant
for benchmarks of some blocks (tens of MB): each further block is one more scan. Texts are worked
on in runs of bounded length, long ones in overlapping pieces.

Case and runs of blanks are evened out first; places are characters of that
text. Nulls and odd rows: null and empty texts have no regions; an empty passage
is found nowhere; one whose error share is under one edit (under 10 characters)
must occur exactly. Only whole passages count: a document that lacks more than
the error share of an item does not hold it. Repeated documents each get their rows; of equal passages each item is
reported. A benchmark row with a null ``item_id`` is searched for like any other, and reported
as null. Extra columns are ignored; a column to keep may not be named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

Q, ERROR = 8, 0.1
RUN_CHARS, BLOCK_CHARS = 1 << 17, 2 << 20
HEAVY = 16
BASE = 0x9E3779B97F4A7C15
FILTER_BITS = 22
SCHEMA = "item_id long, start long, end long, edits int, item_chars int"


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all q-grams; q is a power of two."""
    h, size = chars.astype(np.uint64), 1
    while size < q:
        h = h[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + h[size:]
        size *= 2
    return h


def gram_size(m: int, q: int = Q, error: float = ERROR) -> int:
    """The q of a passage of m characters: the largest power of two up to ``q`` under which the lemma allows the whole error share."""
    edits = int(error * m)
    while edits and q > 1 and q * (edits + 1) > m:
        q //= 2
    return q


def edit_budget(m: int, q: int = Q, error: float = ERROR) -> int:
    """Edits allowed in a passage of m characters: the error share, but at least one shared q-gram must be sure."""
    return max(0, min(int(error * m), (m - q) // q))


class Grams:
    """The q-grams of those passages of an index that have the same q: the light ones with their places, the others only counted."""

    def __init__(self, texts: list[str], items: list[int], q: int):
        self.q = q
        grams = [(gram_hashes(codes(texts[i]), q), i) for i in items]
        h = np.concatenate([g for g, _ in grams])
        item = np.concatenate([np.full(len(g), i) for g, i in grams])
        at = np.concatenate([np.arange(len(g)) for g, _ in grams])
        keys, which, times = np.unique(h, return_inverse=True, return_counts=True)
        light = times[which] <= HEAVY
        self.heavy_of = np.bincount(item[~light], minlength=len(texts))
        self.every = h, item
        self.light = h[light], item[light], at[light]

    def settle(self, counted: np.ndarray) -> None:
        """Keep the places of the light grams of the passages marked as counted, and the other passages' grams as numbers."""
        h, item, at = (x[counted[self.light[1]]] for x in self.light)
        order = np.argsort(h, kind="stable")
        self.item, self.at = item[order], at[order]
        self.keys, self.first, self.times = np.unique(h[order], return_index=True, return_counts=True)
        h, item = (x[~counted[self.every[1]]] for x in self.every)
        self.whole_keys, key = np.unique(h, return_inverse=True)
        pairs, self.whole_times = np.unique(np.stack([key, item]), axis=1, return_counts=True)
        self.whole_item, self.whole_first = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.whole_keys) + 1))
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        for keys in (self.keys, self.whole_keys):
            self.maybe[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        del self.light, self.every

    def places(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose q-gram may be some passage's, and all hashes."""
        if len(chars) < self.q:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = gram_hashes(chars, self.q)
        return np.flatnonzero(self.maybe[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]), h


def found_in(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of h are among the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.searchsorted(keys, h)
    at[at == len(keys)] = 0
    return keys[at] == h, at


@dataclass
class Index:
    """The q-grams of a block of passages; ``q`` is that of long ones."""

    ids: list[int | None]
    texts: list[str]
    q: int
    error: float
    short: list[int] = field(default_factory=list)

    def __post_init__(self):
        m = np.array([len(t) for t in self.texts], np.int64)
        size = np.array([gram_size(int(x), self.q, self.error) for x in m], np.int64)
        self.m, self.k = m, np.array([edit_budget(int(x), int(q), self.error) for x, q in zip(m, size)], np.int64)
        self.bound = m - size + 1 - self.k * size
        self.short = np.flatnonzero(m < size).tolist()
        self.grams = [Grams(self.texts, np.flatnonzero((size == q) & (m >= q)).tolist(), int(q)) for q in np.unique(size[m >= size])]
        heavy = sum((g.heavy_of for g in self.grams), np.zeros(len(m), np.int64))
        self.left = self.bound - heavy
        for g in self.grams:
            g.settle(self.left > 0)
        self.longest = int(max(m, default=0))

    def whole(self, chars: np.ndarray, spans: list) -> list[tuple[int, int]]:
        """(span, item): the uncounted passages whose q-grams the span has enough of, in any order."""
        out = []
        for g in self.grams:
            if not len(g.whole_keys):
                continue
            place, h = g.places(chars)
            true, key = found_in(g.whole_keys, h[place])
            place, key = place[true], key[true]
            for s, (start, end, _) in enumerate(spans):
                a, z = np.searchsorted(place, (start, end))
                if a == z:
                    continue
                n = np.zeros(len(self.texts), np.int64)
                for k in np.unique(key[a:z]).tolist():
                    one = slice(g.whole_first[k], g.whole_first[k + 1])
                    n[g.whole_item[one]] += g.whole_times[one]
                out += [(s, int(i)) for i in np.flatnonzero((n > 0) & (n >= self.bound))]
        return out

    def bands(self, chars: np.ndarray) -> list[tuple[int, int]]:
        """(item, least diagonal) of the bands that reach the bound; a band is 2 (k + 1) diagonals."""
        return sorted(set().union(*(self._bands(g, chars) for g in self.grams)))

    def _bands(self, grams: Grams, chars: np.ndarray) -> set[tuple[int, int]]:
        place, h = grams.places(chars)
        true, key = found_in(grams.keys, h[place])
        place, key = place[true], key[true]
        times = grams.times[key]
        total = int(times.sum())
        if not total:
            return set()
        nth = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(grams.first[key], times) + nth
        item, at = grams.item[entry], grams.at[entry]
        diagonal = np.repeat(place, times) - at + self.longest
        step = self.k[item] + 1
        # Of an item's hits, those at one place of the passage in one band count once.
        wide = (len(chars) + self.longest) * 2
        half = np.unique((item * wide + diagonal // step) * (self.longest + 1) + at)
        which, n = np.unique(half // (self.longest + 1), return_counts=True)
        follows = np.zeros(len(n), np.int64)
        if len(n) > 1:
            follows[:-1] = np.where(which[1:] == which[:-1] + 1, n[1:], 0)
        found = which // wide
        low = which % wide
        out = set()
        for i in np.flatnonzero(n + follows >= self.left[found]).tolist():
            out.add((int(found[i]), int(low[i] * (self.k[found[i]] + 1) - self.longest)))
        # A band that only its second half fills starts one step earlier; its hits are then in the band above, which counts them too.
        return out


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Least edits of the whole passage against a part of text, on diagonals low to high; (edits, start, end), None if over ``most``.

    Row by row over the passage; a cell is the diagonal. Insertions along a row are a running minimum.
    """
    width = high - low + 1
    d = np.arange(low, high + 1)
    far = len(passage) + len(text) + 1
    inside = (d >= 0) & (d <= len(text))
    cost = np.where(inside, 0, far)
    begin = d.copy()
    steps = np.arange(width)
    for i in range(1, len(passage) + 1):
        j = d + i
        ok = (j >= 1) & (j <= len(text))
        same = np.zeros(width, bool)
        same[ok] = text[j[ok] - 1] == passage[i - 1]
        across = np.where(ok, cost + ~same, far)
        down = np.append(cost[1:] + 1, far)
        best = np.where((j >= 0) & (j <= len(text)), np.minimum(across, down), far)
        source = np.where(across <= down, begin, np.append(begin[1:], 0))
        lowest = np.minimum.accumulate(best - steps)
        from_at = np.maximum.accumulate(np.where(best - steps == lowest, steps, 0))
        cost = np.where((j >= 0) & (j <= len(text)), lowest + steps, far)
        begin = source[from_at]
        if cost.min() > most:
            return None
    at = int(cost.argmin())
    return int(cost[at]), int(begin[at]), int(d[at] + len(passage))


def regions(index: Index, text: str) -> dict[int, tuple[int, int, int]]:
    """For each item found in a normalised text: (edits, start, end) of its best place."""
    best: dict[int, tuple[int, int, int]] = {}

    def put(item: int, found: tuple[int, int, int]) -> None:
        best[item] = min(best.get(item, found), found)

    for item in index.short:
        if index.texts[item] and (at := text.find(index.texts[item])) >= 0:
            put(item, (0, at, at + int(index.m[item])))
    overlap = 2 * index.longest + Q
    for a in range(0, max(1, len(text) - overlap), RUN_CHARS):
        chars = codes(text[a:a + RUN_CHARS + overlap])
        settle(index, chars, [(0, len(chars), lambda i, f, a=a: put(i, (f[0], f[1] + a, f[2] + a)))])
    return best


def least_edits(passage: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edits, end): the least edits of the passage against any part of the text, and where the first such part ends. Bit-parallel: a row is a number."""
    m = len(passage)
    masks: dict[int, int] = {}
    for i, c in enumerate(passage.tolist()):
        masks[c] = masks.get(c, 0) | 1 << i
    top, ones = 1 << (m - 1), (1 << m) - 1
    up, down, score, best, end = ones, 0, m, m, 0
    for j, c in enumerate(text.tolist(), 1):
        same = masks.get(c, 0)
        v = same | down
        h = (((same & up) + up) ^ up) | same
        plus, minus = (down | ~(h | up)) & ones, up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, j
        plus, minus = plus << 1 & ones, minus << 1 & ones
        up, down = (minus | ~(v | plus)) & ones, plus & v
    return best, end


def least_edits_of_many(passages: list[np.ndarray], text: np.ndarray, at_once: int = 1024) -> list[tuple[int, int]]:
    """``least_edits`` of each passage: the same steps for many side by side, a row being some 64-bit numbers."""
    if len(passages) < 24:
        return [least_edits(p, text) for p in passages]
    if len(passages) > at_once:
        return [x for a in range(0, len(passages), at_once) for x in least_edits_of_many(passages[a:a + at_once], text)]
    m = np.array([len(p) for p in passages])
    n, words, one = len(m), int((m.max() + 63) // 64), np.uint64(1)
    letters, coded = np.unique(text, return_inverse=True)
    masks = np.zeros((len(letters), words, n), np.uint64)
    for i, p in enumerate(passages):
        true, letter = found_in(letters, p)
        at = np.flatnonzero(true)
        np.bitwise_or.at(masks, (letter[at], at // 64, np.full(len(at), i)), one << (at % 64).astype(np.uint64))
    lane, top_word, top_bit = np.arange(n), (m - 1) // 64, ((m - 1) % 64).astype(np.uint64)
    up, down = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    score, best, end = m.copy(), m.copy(), np.zeros(n, np.int64)
    plus, minus = np.empty_like(up), np.empty_like(up)
    for j, c in enumerate(coded.tolist(), 1):
        carry = plus_in = minus_in = np.zeros(n, np.uint64)
        for w in range(words):
            same, u, d = masks[c, w], up[w], down[w]
            both = same & u
            half = both + u
            total = half + carry
            carry = ((half < both) | (total < half)).astype(np.uint64)
            h = (total ^ u) | same
            plus[w], minus[w] = d | ~(h | u), u & h
            v = same | d
            p_now, m_now = plus[w] << one | plus_in, minus[w] << one | minus_in
            plus_in, minus_in = plus[w] >> np.uint64(63), minus[w] >> np.uint64(63)
            up[w], down[w] = m_now | ~(v | p_now), p_now & v
        score += (plus[top_word, lane] >> top_bit & one).astype(np.int64) - (minus[top_word, lane] >> top_bit & one).astype(np.int64)
        less = score < best
        best[less], end[less] = score[less], j
    return list(zip(best.tolist(), end.tolist()))


def settle(index: Index, chars: np.ndarray, spans: list) -> None:
    """Verifies the bands of a run of characters; spans (start, end, put) are its texts in order."""
    starts = np.array([s[0] for s in spans])
    exact: set[tuple[int, int]] = set()
    for item, low in index.bands(chars):
        k, m = int(index.k[item]), int(index.m[item])
        high = low + 2 * (k + 1) - 1
        for s in range(max(0, int(np.searchsorted(starts, low, "right")) - 1), len(spans)):
            start, end, put = spans[s]
            if start > high:
                break
            if (s, item) in exact:  # bands come in order: no later one starts before the exact place
                continue
            part, off = chars[max(start, low - k):min(end, high + m + k)], max(start, low - k)
            passage = codes(index.texts[item])
            if (at := _exact(passage, part)) is not None:
                put(item, (0, at + off - start, at + off - start + m))
                exact.add((s, item))
            elif least_edits(passage, part)[0] <= k and (found := align(passage, part, low - k - off, high + k - off, k)) is not None:
                put(item, (found[0], found[1] + off - start, found[2] + off - start))
    held: dict[int, list[int]] = {}
    for s, item in index.whole(chars, spans):
        held.setdefault(s, []).append(item)
    for s, items in held.items():
        start, end, put = spans[s]
        part, rest = chars[start:end], []
        for item in items:
            if (at := _exact(codes(index.texts[item]), part)) is not None:
                put(item, (0, at, at + int(index.m[item])))
            else:
                rest.append(item)
        passages = [codes(index.texts[i]) for i in rest]
        for item, passage, (edits, stop) in zip(rest, passages, least_edits_of_many(passages, part)):
            k, m = int(index.k[item]), int(index.m[item])
            if edits <= k:
                a = max(0, stop - m - k)
                found = align(passage, part[a:stop], -k, 2 * k, k)
                put(item, (found[0], found[1] + a, found[2] + a))


def _exact(passage: np.ndarray, part: np.ndarray) -> int | None:
    """The alignment without edits, if there is one: where the passage starts."""
    whole, at = part.tobytes(), -1
    while (at := whole.find(passage.tobytes(), at + 1)) >= 0:
        if at % 4 == 0:
            return at // 4
    return None


GAP = np.full(1, 0x7FFFFFFF, np.uint32)


def search(index: Index, texts: list[str]) -> Iterator[tuple[int, dict[int, tuple[int, int, int]]]]:
    """(position, what ``regions`` finds) of each normalised text, in order; short texts are worked on side by side."""
    for a, z in blocks(texts, RUN_CHARS):
        if z == a + 1:
            yield a, regions(index, texts[a])
            continue
        found: list[dict] = [{} for _ in range(a, z)]
        spans, parts, at = [], [], 0
        for text, mine in zip(texts[a:z], found):
            def put(item, f, mine=mine):
                mine[item] = min(mine.get(item, f), f)

            for item in index.short:
                if index.texts[item] and (p := text.find(index.texts[item])) >= 0:
                    put(item, (0, p, p + int(index.m[item])))
            c = codes(text)
            spans.append((at, at + len(c), put))
            parts += [c, GAP]
            at += len(c) + 1
        settle(index, np.concatenate(parts), spans)
        yield from enumerate(found, a)


def _searching(index: Index):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, out = [], []
            for i, found in search(index, [normal(t.as_py()) for t in b.column("text")]):
                for item, (edits, start, end) in sorted(found.items()):
                    row.append(i)
                    out.append((index.ids[item], start, end, edits, int(index.m[item])))
            names = [c for c in b.schema.names if c != "text"]
            kept = [b.column(c).take(pa.array(row, pa.int64())) for c in names]
            cols = [pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*kept, *cols], names=[*names, "item_id", "start", "end", "edits", "item_chars"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str], q: int = Q, error: float = ERROR) -> DataFrame:
    """A row for each document and benchmark item found in it: the columns ``keep`` (not text) with SCHEMA's.

    Returned is the place with the fewest edits, at most ``error`` of the item's characters.
    """
    if clash := {c.split()[0] for c in SCHEMA.split(", ")} & set(keep):
        raise ValueError(f"results are named like columns to keep: {sorted(clash)}")
    texts = docs.select(*keep, "text")
    kinds = ", ".join(f"`{n}` {t}" for n, t in texts.dtypes if n != "text")
    out = None
    for ids, passages in _blocks(benchmark):
        got = texts.mapInArrow(_searching(Index(ids, passages, q, error)), f"{kinds}, {SCHEMA}")
        out = got if out is None else out.unionByName(got)
    return out


def _cleaning(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = [not found for _, found in search(index, [normal(t.as_py()) for t in b.column("text")])]
            yield b.filter(pa.array(clean, pa.bool_()))
    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR) -> DataFrame:
    """The rows of docs in which no benchmark item is found, unchanged."""
    for ids, passages in _blocks(benchmark):
        docs = docs.mapInArrow(_cleaning(Index(ids, passages, q, error)), docs.schema)
    return docs


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int | None], list[str]]]:
    """The benchmark's items in blocks of about BLOCK_CHARS; one empty block if it has none."""
    ids, texts, size, some = [], [], 0, False
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        text = normal(r["text"])
        if ids and size + len(text) > BLOCK_CHARS:
            yield ids, texts
            ids, texts, size, some = [], [], 0, True
        ids.append(r["item_id"])
        texts.append(text)
        size += len(text)
    if ids or not some:
        yield ids, texts

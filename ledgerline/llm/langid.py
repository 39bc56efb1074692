"""Language identification with unigram pieces, summed over all segmentations.

The pieces are a public vocabulary of byte strings that is never changed. Each
language has a probability for every piece; a word's probability is the sum,
over all ways to cut it into pieces, of the products of their probabilities,
which a forward pass adds up position by position. The probabilities are learned
by expectation maximisation: a forward-backward pass over the words of the
labelled texts gives each piece's expected count, and Spark adds those up.

Words are whole, whatever their length, and all pieces count, so no segmentation is left
out. Where the product of the smallest probabilities over a word's length
would leave the range of a double, the pass adds logarithms instead, with the same result.

Inside a task the passes run over the different words of a block of texts at
once, as arrays, a block having a bounded number of characters. A very long word
is summed over its last positions only when it is scored; when it is learned from, only
its own languages are held. What reaches the driver is one number a piece and language, so it is bounded by the vocabulary
times the number of languages (which is checked).

Nulls and odd rows: a null text, or one with no letter, is ``und`` with score 0;
so is every text if there was nothing to learn from. A null language is not
learned from. Repeated rows are learned from as often as they occur. Of equally
likely languages the first by name wins. Extra columns are ignored; in an empty
table nothing is learned or returned.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Pieces over PIECE bytes are few and looked up only where their first PIECE bytes are one's; a batch of words has at most CELLS bytes.
PIECE, CELLS = 16, 400_000
#: Sums are added plainly while they are sure to stay over exp(-SAFE).
SAFE = 600.0
BLOCK_CHARS = 4 << 20
MAX_LANGUAGES = 512
SCALE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


@dataclass
class Pieces:
    """The vocabulary as hashes of its byte strings, in the order of their ids, with the lengths that occur and the beginnings of long ones."""

    hashes: np.ndarray
    sizes: tuple[int, ...] = tuple(range(1, PIECE + 1))
    long_heads: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    @classmethod
    def load(cls, path: str) -> "Pieces":
        """Reads lines of base64 and rank; every single byte is a piece, whether listed or not."""
        with open(path, "rb") as f:
            listed = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
        pieces = sorted(listed | {bytes([i]) for i in range(256)})
        heads = {_hash(p[:PIECE]) for p in pieces if len(p) > PIECE}
        return cls(np.array([_hash(p) for p in pieces], np.uint64), tuple(sorted(set(map(len, pieces)))), np.array(sorted(heads), np.uint64))


def _hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def units(text: str) -> list[bytes]:
    """The words of a lower-cased text, each with a blank before it."""
    return [b" " + w for w in text.lower().encode().split()]


class Lattice:
    """The pieces that end at each position of a batch of words of one length."""

    def __init__(self, words: list[bytes], index: pd.Index, sizes: tuple[int, ...] = tuple(range(1, PIECE + 1)), long_heads: np.ndarray | None = None):
        n, length = len(words), len(words[0])
        text = np.frombuffer(b"".join(words), np.uint8).reshape(n, length).astype(np.uint64) + np.uint64(1)
        sums = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            sums[j + 1] = sums[j] * BASE + text[:, j]
        self.n, self.length, self.ends = n, length, [[] for _ in range(length)]
        self.reach = max((size for size in sizes if size <= length), default=1)
        long = None
        for size in sizes:
            if size > length:
                break
            power = np.uint64(pow(int(BASE), size, 1 << 64))
            if size <= PIECE:
                ids = index.get_indexer((sums[size:] - sums[:-size] * power).ravel())
                at = np.flatnonzero(ids >= 0)
                ids = ids[at]
            else:
                if long is None:
                    head = sums[PIECE:] - sums[:-PIECE] * np.uint64(pow(int(BASE), PIECE, 1 << 64))
                    long = np.flatnonzero(np.isin(head.ravel(), long_heads)) if long_heads is not None else np.zeros(0, np.int64)
                at = long[long < (length + 1 - size) * n]
                if not len(at):
                    continue
                ids = index.get_indexer(sums[size:].ravel()[at] - sums[:-size].ravel()[at] * power)
                at, ids = at[ids >= 0], ids[ids >= 0]
            if not len(at):
                continue
            start, row = np.divmod(at, n)
            cuts = np.flatnonzero(np.diff(start, prepend=-1))
            for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
                self.ends[start[a] + size - 1].append((size, row[a:z], ids[a:z]))

    def safe(self, p: np.ndarray) -> bool:
        """Whether no sum over these words can leave the range of a double."""
        return -np.log(p.min()) * self.length < SAFE

    def forward(self, p: np.ndarray) -> np.ndarray:
        """(position, word, language) sums of all segmentations up to each position. p: (piece, language)."""
        alpha = np.zeros((self.length + 1, self.n, p.shape[1]))
        alpha[0] = 1
        for j, found in enumerate(self.ends, 1):
            for size, rows, ids in found:
                alpha[j, rows] += alpha[j - size, rows] * p[ids]
        return alpha

    def log_forward(self, logp: np.ndarray, keep: int | None = None) -> np.ndarray:
        """Logarithms of ``forward``'s sums, for any length; only the last ``keep`` positions are held, in turns."""
        turns = keep or self.length + 1
        alpha = np.full((turns, self.n, logp.shape[1]), -np.inf)
        alpha[0] = 0
        for j, found in enumerate(self.ends, 1):
            now = alpha[j % turns]
            now[:] = -np.inf
            for size, rows, ids in found:
                now[rows] = np.logaddexp(now[rows], alpha[(j - size) % turns][rows] + logp[ids])
        return alpha

    def logs(self, p: np.ndarray) -> np.ndarray:
        """(word, language) logarithms of the words' probabilities."""
        if self.safe(p):
            return np.log(self.forward(p)[-1])
        turns = min(self.reach, self.length) + 1
        return self.log_forward(np.log(p), turns)[self.length % turns]

    def expected(self, p: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
        """Adds to out (language, piece) the expected number of uses, weights (word, language) being the words' counts."""
        if not self.safe(p):
            for k in np.flatnonzero(weights.any(0)).tolist():
                self._log_expected(np.log(p[:, k:k + 1]), weights[:, k:k + 1], out[k])
            return
        alpha = self.forward(p)
        beta = np.zeros_like(alpha)
        beta[-1] = weights / alpha[-1]
        for j in range(self.length, 0, -1):
            for size, rows, ids in self.ends[j - 1]:
                inside = beta[j, rows] * p[ids]
                used = alpha[j - size, rows] * inside
                for k in range(out.shape[0]):
                    out[k] += np.bincount(ids, used[:, k], minlength=out.shape[1])
                beta[j - size, rows] += inside

    def _log_expected(self, logp: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
        alpha = self.log_forward(logp)
        beta = np.full_like(alpha, -np.inf)
        with np.errstate(divide="ignore"):
            beta[-1] = np.log(weights) - alpha[-1]
        for j in range(self.length, 0, -1):
            for size, rows, ids in self.ends[j - 1]:
                inside = beta[j, rows] + logp[ids]
                np.add.at(out, ids, np.exp(alpha[j - size, rows] + inside)[:, 0])
                beta[j - size, rows] = np.logaddexp(beta[j - size, rows], inside)


def by_length(words: list[bytes], most: int = CELLS) -> Iterator[list[int]]:
    """Positions of the words, in batches of one length and ``most`` bytes (a longer word is a batch of its own)."""
    at: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        at.setdefault(len(w), []).append(i)
    for length, ids in at.items():
        n = max(1, most // length)
        for a in range(0, len(ids), n):
            yield ids[a:a + n]


def _counting(pieces: Pieces, languages: list[str], p: np.ndarray):
    known = {x: k for k, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, out = pd.Index(pieces.hashes), np.zeros((len(languages), len(pieces.hashes)))
        for b in batches:
            texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
            for a, z in blocks(texts, BLOCK_CHARS):
                counts = [Counter() for _ in languages]
                for text, lang in zip(texts[a:z], langs[a:z]):
                    if text and lang in known:
                        counts[known[lang]].update(units(text))
                words = sorted(set().union(*counts))
                weights = np.array([[c.get(w, 0) for c in counts] for w in words], float).reshape(len(words), len(languages))
                for ids in by_length(words):
                    Lattice([words[i] for i in ids], index, pieces.sizes, pieces.long_heads).expected(p, weights[ids], out)
        lang, piece = np.nonzero(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(np.rint(out[lang, piece] * SCALE).astype(np.int64))],
            names=["lang", "piece", "n"])
    return run


@dataclass
class Model:
    pieces: Pieces
    languages: list[str]
    log_floor: float
    p: np.ndarray  # (piece, language)


def learn(docs: DataFrame, training: Column, vocabulary: str = VOCABULARY, rounds: int = 1, smoothing: float = 0.1) -> Model:
    """Piece probabilities of each language of the rows of docs (text, lang) that ``training`` selects; all of them are used.

    ``rounds`` of expectation maximisation start from equal probabilities. ``smoothing`` is added to each expected count.
    """
    pieces = Pieces.load(vocabulary)
    rows = docs.where(training & F.col("lang").isNotNull()).select("text", "lang")
    found = rows.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    languages = [r["lang"] for r in found]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages: the model would not be bounded")
    v = len(pieces.hashes)
    p = np.full((v, max(1, len(languages))), 1.0 / v)
    for _ in range(rounds if languages else 0):
        sums = rows.mapInArrow(_counting(pieces, languages, p), "lang int, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        got = sums.toPandas()
        counts = np.full((len(languages), v), smoothing)
        counts[got["lang"], got["piece"]] += got["n"] / SCALE
        p = (counts / counts.sum(1, keepdims=True)).T.copy()
    return Model(pieces, languages, float(np.log(p.min())), p)


def _scoring(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pd.Index(model.pieces.hashes)
        for b in batches:
            texts = b.column("text").to_pylist()
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            for a, z in blocks(texts, BLOCK_CHARS):
                ids_of = _numbered()
                docs = [(i, np.fromiter(map(ids_of.__getitem__, units(texts[i])), np.int64))
                        for i in range(a, z) if model.languages and texts[i] and has_letter(texts[i])]
                words = list(ids_of)
                logs = np.zeros((len(words), len(model.languages)))
                for ids in by_length(words):
                    logs[ids] = Lattice([words[i] for i in ids], index, model.pieces.sizes, model.pieces.long_heads).logs(model.p)
                for i, ids in docs:
                    total = logs[ids].sum(0)
                    k = int(total.argmax())
                    lang[i], score[i] = model.languages[k], 1 / np.exp(total - total[k]).sum()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])
    return run


def _numbered() -> dict:
    """A dict that numbers its keys as they come."""
    from collections import defaultdict

    return defaultdict(count().__next__)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row with lang_pred and score, the posterior probability of lang_pred for the whole text."""
    texts = docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = dict(texts.dtypes)
    return texts.mapInArrow(_scoring(model, keep), ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", lang_pred string, score double")

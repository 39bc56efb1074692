import hashlib
from collections import defaultdict

import pytest
from helpers import as_docs, no_docs, odd_docs, some_docs
from pyspark.sql import functions as F

from ledgerline.llm import linededup, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def slow(rows, min_docs, min_chars=1, keep_first=False):
    """(doc_id, text) rows -> (doc_id, n_lines, n_dropped, kept) of each."""
    found = defaultdict(set)
    for d, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            found[key(line)].add((d is not None, d, t is not None, t, pos))
    common = {k: v for k, v in found.items() if len(k) >= min_chars and len({x[:4] for x in v}) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stays = [x for i, x in enumerate(lines) if key(x) not in common or keep_first and (d, i) == min((y[1], y[4]) for y in common[key(x)])]
        out.append((d, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, sf_small):
    rows = list(some_docs(spark, sf_small)[["doc_id", "text"]].itertuples(index=False, name=None))
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in slow(rows, 10)]
    got = queries.op6_line_dedup(spark, sf_small).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and any(w[2] for w in want)


def test_odd_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = linededup.with_bitmaps(docs, min_docs=2).select("doc_id", "n_lines", "n_dropped", "kept").collect()
        assert sorted(map(tuple, got), key=repr) == slow(rows, 2)
        assert set(docs.columns) <= set(linededup.with_bitmaps(docs).columns)


def test_first_occurrences_stay(spark):
    texts = ["a\nb\nA \nc", "b\n a\nd", "a\n" * 200 + "e", None, "", "\n\n"]
    rows = list(enumerate(texts))
    done = linededup.with_bitmaps(as_docs(spark, texts), min_docs=2, keep_first=True)
    assert sorted(map(tuple, done.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr) == slow(rows, 2, keep_first=True)
    bits = done.where("doc_id = 2").select(F.expr("transform(bitmap, w -> bit_count(w.bits))")).first()[0]
    assert bits == [64, 64, 64, 8]


def test_no_python_runs(spark, sf_small, capsys):
    queries.op6_line_dedup(spark, sf_small).explain()
    queries.op5_mixing_weights(spark, sf_small).explain()
    plans = capsys.readouterr().out
    assert "Python" not in plans and "Arrow" not in plans and "CartesianProduct" not in plans


def test_clashing_names(spark):
    docs = odd_docs(spark)
    names = ("_doc", "_row", "_d", "_r", "_lines", "_words", "__lines", "pos", "h1", "key", "line")
    more = docs.withColumns({c: F.lit(f"mine {c}") for c in names})
    got = linededup.with_bitmaps(more, min_docs=2)
    assert got.columns == [*more.columns, *linededup.RESULTS[:1], *linededup.RESULTS[1:]]
    plain = linededup.with_bitmaps(docs, min_docs=2).select("doc_id", "n_dropped", "kept").collect()
    assert sorted(plain, key=repr) == sorted(got.select("doc_id", "n_dropped", "kept").collect(), key=repr)
    assert all(r[c] == f"mine {c}" for r in got.collect() for c in names)
    for c in linededup.RESULTS:
        with pytest.raises(ValueError, match=c):
            linededup.with_bitmaps(docs.withColumn(c, F.lit(1)))

import numpy as np
import pandas as pd
import xxhash
from helpers import no_docs, odd_docs, some_docs
from pyspark.sql import functions as F

from ledgerline.llm import queries, simhash
from ledgerline.llm.components import components


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, radius=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(f)):
        groups.setdefault(root(i), []).append(ids[i])
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return [least[root(i)] for i in range(len(f))]


def test_query_against_brute_force(spark, sf_small):
    docs = some_docs(spark, sf_small)
    fps = [slow_fingerprint(t) for t in docs["text"]]
    want = sorted(zip(docs["doc_id"], [f"{f:016x}" for f in fps], slow_components(docs["doc_id"].tolist(), fps)))
    got = queries.op2_simhash_near_dedup(spark, sf_small)
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = docs.collect()
    fps = [slow_fingerprint(r["text"]) for r in rows]
    want = sorted(zip([r["doc_id"] for r in rows], fps, slow_components([r["doc_id"] for r in rows], fps)), key=repr)
    got = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in got), key=repr) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # doc_id 8 has two texts, each in a group of its own
    assert sorted(set(r["doc_id"] for r in kept.collect() if r["doc_id"])) == sorted({w[2] for w in want if w[2] is not None})
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.one_of_each(no_docs(spark)).count() == 0


def test_links_equal_all_pairs(spark):
    r = np.random.default_rng(3)
    heart = r.integers(0, 1 << 63, 4).astype(np.uint64)
    f = {int(h) for h in heart}
    for h in heart:  # clouds around four hearts, denser than real copies
        for _ in range(120):
            bits = r.choice(64, r.integers(1, 5), replace=False)
            f.add(int(h) ^ sum(1 << int(b) for b in bits))
    f = np.array(sorted(f), np.uint64).view(np.int64)
    want = {(min(a, b), max(a, b)) for i, a in enumerate(f.tolist()) for b in f[i + 1:].tolist() if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    for segments in (2, 4):
        got = simhash.links(spark.createDataFrame(pd.DataFrame({"fp": f})), 3, segments).select("a", "b").distinct().collect()
        assert {tuple(x) for x in got} == want
    blocks = simhash.block_links(spark.createDataFrame(pd.DataFrame({"fp": f})), 3).distinct().collect()
    assert blocks and all((min(x), max(x)) in want for x in map(tuple, blocks))


def test_dense_clouds_of_fingerprints(spark, monkeypatch):
    r = np.random.default_rng(11)
    fps = []
    for h in r.integers(0, 1 << 63, 5).astype(np.uint64):
        for _ in range(300):
            fps.append(int(h) ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 6), replace=False)))
    ids = list(range(len(fps)))
    rows = pd.DataFrame({"doc_id": ids, "row_hash": ids, "fp": np.array(fps, np.uint64).view(np.int64)})
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, words, seed: docs)
    got = simhash.near_duplicates(spark.createDataFrame(rows)).select("doc_id", "component_id").orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == slow_components(ids, fps)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (500, 500), (None, 3), (201, 200), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {x: 100 for x in range(100, 160)} | {500: 500, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_clashing_names(spark):
    from helpers import odd_docs
    from pyspark.sql import functions as F

    docs = odd_docs(spark)
    more = docs.withColumns({c: F.lit(f"mine {c}") for c in ("_hash", "_doc", "_row", "row_hash", "least", "group", "component_id")})
    got = simhash.one_of_each(more, words=3, radius=3, segments=2, seed=42)
    assert got.columns == more.columns and all(r["_hash"] == "mine _hash" and r["_row"] == "mine _row" for r in got.collect())
    assert got.count() == simhash.one_of_each(docs, words=3, radius=3, segments=2, seed=42).count()


def test_lookups_are_never_broadcast(spark):
    """An exploded row counts once in Spark's sizes, so the many lookups of a small table of nodes would go to the driver."""
    nodes = spark.range(500).select(F.xxhash64("id").alias("fp"))
    found = simhash.links(nodes)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan

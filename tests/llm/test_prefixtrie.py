import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import prefixtrie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def slow(rows):
    """(conv_id, turn, role, text) rows -> the nodes, with every conversation rebuilt and every prefix held."""
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 4
        base = None if c is None else c - (c % 20 if c >= 0 else -(-c % 20))
        head = own.get(base, []) if base is not None else []
        built[c] = tuple(head[:h] + ts[h:])
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], set()).add(c)
    least = lambda cs: min((c for c in cs if c is not None), default=None)
    kids, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, cs in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(cs) - 1) * words
    out = []
    for p, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if c is not None and len(built[c]) == len(p)))
        out.append((least(cs), len(p), least(nodes[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def fast(df):
    return sorted(map(tuple, prefixtrie.prefix_trie(df).collect()), key=repr)


def test_query_against_brute_force(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = slow(rows)
    assert sorted(map(tuple, queries.op13_prefix_trie(spark, sf_small).collect()), key=repr) == want and any(w[6] for w in want)


def random_rows(rng, n):
    """Conversations of few different turns, so that prefixes meet; copies, gaps in the ids, turnless ones after rebuilding."""
    rows = []
    for c in rng.sample(range(-30, 90), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "bot"][:1 + t % 2]), rng.choice(["a b", "c", "", None])))
    return rows


@pytest.mark.parametrize("block", [2, 4096])
def test_random_conversations(spark, block, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    monkeypatch.setattr(prefixtrie, "CHUNK_BYTES", 5)
    rows = random_rows(random.Random(block), 70)
    assert fast(spark.createDataFrame(rows, SCHEMA)) == slow(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "u", "x y"), (None, None, None, None), (20, 2, "u", "b"), (20, 2, "u", "b"), (20, 2, "u", "a"), (20, None, None, "first"), (20, 2, None, "z"),
            (21, 1, "u", "w " * 50000), (21, 0, "u", None), (33, 0, "u", "only"), (7, -3, "u", "neg"), (7, 5, "v", "\t\n")]
    assert fast(spark.createDataFrame(rows, SCHEMA)) == slow(rows)
    assert fast(spark.createDataFrame([(None, None, None, None)] * 2, SCHEMA)) == slow([(None, None, None, None)] * 2)
    assert fast(spark.createDataFrame([], SCHEMA)) == []
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("place", "part", "at", "depth", "f0", "words", "t0", "head", "c", "block")})
    assert fast(clash) == slow(rows)


def test_equal_hashes_are_noticed(spark, monkeypatch):
    turns = spark.createDataFrame([(1, "u", "a", 5, 5, 5, 1, 0, 0), (2, "u", "b", 5, 5, 5, 1, 0, 1)], "conv_id long, role string, text string, t0 long, t1 long, t2 long, words long, part int, at long")
    assert prefixtrie.turns_differ(turns) and not prefixtrie.turns_differ(turns.where("conv_id = 1").union(turns.where("conv_id = 1").withColumn("at", F.lit(9))))
    tries = iter([True, False])
    monkeypatch.setattr(prefixtrie, "turns_differ", lambda t: next(tries))
    rows = random_rows(random.Random(3), 10)
    assert fast(spark.createDataFrame(rows, SCHEMA)) == slow(rows)


def test_products_of_elements(spark):
    row = spark.range(50).select(prefixtrie.power(prefixtrie.BASES[0], F.col("id") * 997).alias("p")).collect()
    assert [r["p"] for r in row] == [pow(prefixtrie.BASES[0], 997 * i, prefixtrie.PRIME) for i in range(50)]

import hashlib

from helpers import no_docs, odd_docs, some_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import mixing, queries


def slow_shares(total, rooms, weights):
    """Fill proportionally; who is full leaves, until nobody is; then divide the rest."""
    out, open_ = {n: 0 for n in rooms}, {n for n in rooms if weights[n] > 0}
    left = total
    while open_:
        w = sum(weights[n] for n in open_)
        full = [n for n in open_ if rooms[n] * w <= weights[n] * left]
        if not full:
            for n in open_:
                out[n] = left * weights[n] // w
            break
        n = min(full, key=lambda n: rooms[n] / weights[n])
        out[n] = rooms[n]
        left -= rooms[n]
        open_.remove(n)
    return out


def slow_mix(rows, tree=mixing.TREE, budget=None, epochs=mixing.MAX_EPOCHS, seed=mixing.SEED):
    """rows: (doc_id, domain, lang, source, tokens) -> {row position: epochs}."""
    weight = lambda table, n: table.get(n, tree.default)
    have = {}
    for _, d, l, s, t in rows:
        have[d, l, s] = have.get((d, l, s), 0) + t
    room = lambda *at: epochs * sum(t for k, t in have.items() if k[:len(at)] == at)
    doms = {k[0] for k in have}
    total = sum(have.values()) if budget is None else budget
    top = slow_shares(total, {d: room(d) for d in doms}, {d: weight(tree.domain_weights, d) for d in doms})
    out = {}
    for d in doms:
        langs = {k[1] for k in have if k[0] == d}
        mid = slow_shares(top[d], {x: room(d, x) for x in langs}, {x: weight(tree.lang_weights, x) for x in langs})
        for x in langs:
            sources = {k[2] for k in have if k[:2] == (d, x)}
            low = slow_shares(mid[x], {s: room(d, x, s) for s in sources}, {s: weight(tree.source_weights, s) for s in sources})
            for s in sources:
                if not have[d, x, s]:
                    continue
                passes, rest = divmod(low[s], have[d, x, s])
                mine = [(int(hashlib.md5(f"{seed}:{passes}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16), repr(r[0]), i) for i, r in enumerate(rows) if r[1:4] == (d, x, s)]
                upto = 0
                for place in sorted({m[:2] for m in mine}):
                    peers = [m[2] for m in mine if m[:2] == place]
                    upto += sum(rows[i][4] for i in peers)
                    for i in peers:
                        if n := passes + (upto <= rest):
                            out[i] = n
    return out


def check(spark, docs, **how):
    rows = mixing.token_rows(docs).collect()
    rows = [(r["doc_id"], r["domain"], r["lang"], r["source"], r["n_tokens"]) for r in rows]
    want = sorted(((*rows[i], n) for i, n in slow_mix(rows, budget=how.get("budget_tokens"), epochs=how.get("max_epochs", 4)).items()), key=repr)
    got = mixing.mixed(docs, **how).select("doc_id", "domain", "lang", "source", "n_tokens", "epochs").collect()
    assert sorted(map(tuple, got), key=repr) == want
    return want


def test_query_against_brute_force(spark, sf_small):
    docs = spark.createDataFrame(some_docs(spark, sf_small))
    assert check(spark, docs)
    got = queries.op5_mixing_weights(spark, sf_small)
    assert got.count() == len(check(spark, docs, buckets=8))
    tokens = sum(len(t.split()) for t in some_docs(spark, sf_small)["text"])
    used = got.agg(F.sum(F.col("n_tokens") * F.col("epochs"))).first()[0]
    assert 0.8 * tokens < used <= tokens


def test_small_budgets_and_odd_rows(spark, sf_small):
    docs = spark.createDataFrame(some_docs(spark, sf_small))
    for budget in (0, 1, 5_000, 10**9):
        check(spark, docs, budget_tokens=budget, max_epochs=2)
    check(spark, odd_docs(spark), buckets=2)
    assert mixing.mixed(no_docs(spark)).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 5)), min_size=1, max_size=8), st.integers(0, 5000))
def test_shares_are_filled_exactly(children, total):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rooms, weights = ({f"c{i}": x[j] for i, x in enumerate(children)} for j in (0, 1))
    rows = [("p", f"c{i}", r, w, total) for i, (r, w) in enumerate(children)]
    got = mixing.shares(spark.createDataFrame(rows, "parent string, name string, room long, weight long, total long"), ["parent"], "name").collect()
    assert {r["name"]: r["budget"] for r in got} == slow_shares(total, rooms, weights)

import corpus_pipeline as P
from helpers import no_docs, odd_docs, some_docs
from test_decontam import slow_least
from test_linededup import key, slow as slow_lines
from test_mixing import slow_mix
from test_simhash import slow_components, slow_fingerprint

from ledgerline.llm import decontam, mixing
from ledgerline.llm.common import stored, table


def test_stages_against_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    text = {r["doc_id"]: r for r in docs.collect()}
    steps = [docs]
    for name, stage in P.STAGES:
        steps.append(stored(stage(spark, steps[-1], sf_small), name))
        assert name == "mixing" or steps[-1].columns == P.COLUMNS
    rows = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in steps]
    assert {d for d, _ in rows[0]} == set(text)
    # 1: rejects go, and nothing with letters in these tables is rejected.
    assert sorted(rows[1]) == sorted(r for r in rows[0] if any(c.isalpha() for c in r[1]))
    # 2: first occurrences stay.
    want = [(d, t) for d, _, k, t in slow_lines(rows[1], 10, keep_first=True) if not k or key(t.replace("\n", ""))]
    assert sorted(rows[2]) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].collect())
    # 3: one of each component.
    ids = [d for d, _ in rows[2]]
    groups = slow_components(ids, [slow_fingerprint(t) for _, t in rows[2]])
    assert sorted(rows[3]) == sorted((d, t) for (d, t), g in zip(rows[2], groups) if d == g) and len(rows[3]) < len(rows[2])
    # 4: whatever contains a passage goes.
    passages = [decontam.normal(r["text"]) for r in table(spark, sf_small, "benchmark").collect()]
    dirty = {d for d, t in rows[3] if any(p in decontam.normal(t) for p in passages)}
    gone = {d for d, _ in rows[3]} - {d for d, _ in rows[4]}
    assert dirty <= gone and dirty
    for d in gone - dirty:
        t = decontam.normal(dict(rows[3])[d])
        assert any(slow_least(p, t) <= 0.1 * len(p) for p in passages)
    # 5: the mixture.
    leaf = [(r["doc_id"], r["domain"], r["lang"], r["source"], r["n_tokens"]) for r in mixing.token_rows(steps[4]).collect()]
    want = sorted((leaf[i][0], n) for i, n in slow_mix(leaf).items())
    assert sorted((r["doc_id"], r["epochs"]) for r in steps[5].collect()) == want
    assert P.run(spark, sf_small).count() == len(want)


def test_odd_rows_pass_every_stage(spark, sf_small):
    for start in (odd_docs(spark), no_docs(spark)):
        for name, stage in P.STAGES:
            got = stored(stage(spark, start, sf_small), name)
            assert name == "mixing" or got.columns == P.COLUMNS
            assert got.count() <= start.count()
        docs = start
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, sf_small), name)


def test_near_duplicates_keep_one(spark, sf_small):
    docs = spark.createDataFrame(some_docs(spark, sf_small, 50))
    twice = docs.unionByName(docs)
    a = P.near_duplicates(spark, docs, sf_small).orderBy("doc_id").collect()
    assert P.near_duplicates(spark, twice, sf_small).orderBy("doc_id").collect() == a

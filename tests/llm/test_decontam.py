import numpy as np
from helpers import no_docs, odd_docs, some_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import decontam, queries
from ledgerline.llm.common import table


def slow_least(passage, text):
    """Edit distance of the passage to its best place in the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(text, k, r):
    out = list(text)
    for _ in range(k):
        i = int(r.integers(0, len(out)))
        what = r.integers(0, 3)
        if what == 0:
            out[i] = "#"
        elif what == 1:
            del out[i]
        else:
            out.insert(i, "#")
    return "".join(out)


def test_finds_every_passage_within_the_budget():
    r = np.random.default_rng(5)
    letters = list("abcdefgh ")
    passages = [decontam.normal("".join(r.choice(letters, n))) for n in (30, 60, 120, 200, 200, 333)]
    index = decontam.Index(list(range(len(passages))), passages, decontam.Q, decontam.ERROR)
    for trial in range(60):
        i = trial % len(passages)
        k = int(index.k[i])
        around = ["".join(r.choice(letters, 400)), "".join(r.choice(letters, 300))]
        text = decontam.normal(around[0] + " " + edited(passages[i], int(r.integers(0, k + 1)), r) + " " + around[1])
        found = decontam.regions(index, text)
        assert i in found
        edits, start, end = found[i]
        assert edits == slow_least(passages[i], text) <= k
        assert slow_least(passages[i], text[start:end]) == edits


def test_far_texts_are_left_alone():
    r = np.random.default_rng(6)
    passages = ["".join(r.choice(list("abcdefgh "), 150)) for _ in range(5)]
    index = decontam.Index(list(range(5)), passages, decontam.Q, decontam.ERROR)
    for i in range(5):
        k = int(index.k[i])
        text = edited(passages[i], 3 * k, r)
        assert (i in decontam.regions(index, text)) == (slow_least(passages[i], text) <= k)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=20))
def test_alignment_against_the_full_table(passage, text):
    found = decontam.align(decontam.codes(passage), decontam.codes(text), -len(passage), len(text), len(passage))
    assert found is not None and found[0] == slow_least(passage, text)
    assert slow_least(passage, text[max(0, found[1]):found[2]]) == found[0]


def test_query_against_exact_search(spark, sf_small):
    docs, items = some_docs(spark, sf_small), table(spark, sf_small, "benchmark").toPandas()
    got = queries.op4_benchmark_decontamination(spark, sf_small).toPandas()
    exact = {(d, i) for d, t in zip(docs["doc_id"], docs["text"]) for i, p in zip(items["item_id"], items["text"]) if decontam.normal(p) in decontam.normal(t)}
    assert exact == {(d, i) for d, i, e in zip(got["doc_id"], got["item_id"], got["edits"]) if e == 0} and exact
    texts = docs.set_index("doc_id")["text"]
    for r in got.itertuples():
        passage = decontam.normal(items.set_index("item_id")["text"][r.item_id])
        assert slow_least(passage, decontam.normal(texts[r.doc_id])[r.start:r.end]) == r.edits <= 0.1 * r.item_chars


def test_odd_rows(spark, monkeypatch):
    docs = odd_docs(spark)
    bench = spark.createDataFrame(
        [(1, "The quick  brown fox jumps over the lazy dog", "a"), (2, None, "b"), (3, "", None), (4, "saute", "c"), (None, "x", "d"), (5, "y z", "e")],
        "item_id long, text string, doc_id string")
    got = decontam.contaminated(docs, bench, ["doc_id"]).collect()
    want = [(1, 1), (2, 1), (2, 1), (8, 5), (None, 4), (1, None), (2, None), (2, None), (8, None), (9, None)]
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == sorted(want, key=repr)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 1)  # a block an item
    assert sorted(decontam.contaminated(docs, bench, ["doc_id"]).collect(), key=repr) == sorted(got, key=repr)
    clean = decontam.without_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 7
    assert decontam.contaminated(no_docs(spark), bench, ["doc_id"]).count() == 0
    assert decontam.contaminated(docs, bench.limit(0), ["doc_id"]).count() == 0


def full_table(passage, text):
    """Least edits by the full table, a row at once: the running minimum makes the insertions."""
    t, steps = decontam.codes(text), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, p in enumerate(decontam.codes(passage), 1):
        new = np.concatenate([[i], np.minimum(row[:-1] + (t != p), row[1:] + 1)])
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def test_query_against_full_tables(spark, sf_small):
    """Every document against every item, inexact hits included."""
    docs, items = some_docs(spark, sf_small), table(spark, sf_small, "benchmark").toPandas()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in queries.op4_benchmark_decontamination(spark, sf_small).collect()}
    texts = [decontam.normal(t) for t in docs["text"]]
    gap = "\uffff" * 64  # a passage across two texts would need more edits than any budget
    joined = gap.join(texts)
    assert 0.1 * max(map(len, map(decontam.normal, items["text"]))) < len(gap)
    near = [(i, decontam.normal(p)) for i, p in zip(items["item_id"], items["text"]) if full_table(decontam.normal(p), joined) <= 0.1 * len(decontam.normal(p))]
    want = {(d, i): e for i, p in near for d, t in zip(docs["doc_id"], texts) if (e := full_table(p, t)) <= int(0.1 * len(p))}
    assert got == want and want


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=20))
def test_least_edits_against_the_full_table(passage, text):
    edits, end = decontam.least_edits(decontam.codes(passage), decontam.codes(text))
    assert edits == full_table(passage, text) == full_table(passage, text[:end])


def test_least_edits_side_by_side():
    r = np.random.default_rng(12)
    for sizes in ((1, 63, 64, 65), (128, 129, 5, 200)):
        passages = [r.integers(0, 3, sizes[i % 4]).astype(np.uint32) for i in range(30)]
        text = r.integers(0, 3, 300).astype(np.uint32)
        assert decontam.least_edits_of_many(passages, text, 27) == [decontam.least_edits(p, text) for p in passages]


def test_common_grams():
    """Texts and passages of stock phrases and of one letter: as by the full table, quickly and in little memory."""
    import time
    import tracemalloc

    r = np.random.default_rng(3)
    stock = "which of the following statements about the passage is most nearly correct, given what you know "
    word = lambda n: "".join(r.choice(list("abcdefghijklmnop "), n))
    items = [decontam.normal("a" * 400), *[decontam.normal(stock + word(150)) for _ in range(1000)], *[decontam.normal(stock + word(6)) for _ in range(40)]]
    index = decontam.Index(list(range(len(items))), items, decontam.Q, decontam.ERROR)
    assert (index.left <= 0).sum() > 20
    texts = ["a" * 32000, decontam.normal(stock * 16), decontam.normal(word(200) + items[1010] + word(100) + edited(items[5], 9, r) + word(50)), "a" * 370 + "b" * 20]
    for t, seconds in zip(texts, (1.0, 1.0, 5.0, 1.0)):
        began = time.process_time()
        found = decontam.regions(index, t)
        assert time.process_time() - began < seconds
        some = [0, 5, 1010, *range(1001, 1041, 5), *range(1, 1001, 100)]
        assert {i: found[i][0] for i in some if i in found} == {i: e for i in some if (e := full_table(items[i], t)) <= index.k[i]}
    tracemalloc.start()
    decontam.regions(index, texts[0])
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(decontam, "RUN_CHARS", 500)
    r = np.random.default_rng(8)
    passage = decontam.normal("".join(r.choice(list("abcdefgh "), 200)))
    index = decontam.Index([9], [passage], decontam.Q, decontam.ERROR)
    for at in range(300, 900, 37):
        noise = "".join(r.choice(list("ijklmnop"), 3000))
        text = noise[:at] + edited(passage, int(index.k[0]), r) + noise[at:]
        assert 0 in decontam.regions(index, text)


def test_short_passages_have_the_whole_budget():
    r = np.random.default_rng(9)
    letters = list("abcdefghijklmnop")
    for m in range(1, 48):
        passages = ["".join(r.choice(letters, m)), "".join(r.choice(letters, 100))]
        index = decontam.Index([0, 1], passages, decontam.Q, decontam.ERROR)
        assert index.k[0] == m // 10 and index.k[1] == 10
        for _ in range(8):
            text = "".join(r.choice(letters, 60)) + edited(passages[0], m // 10, r) + "".join(r.choice(letters, 40)) + passages[1]
            found = decontam.regions(index, text)
            assert found[0][0] == slow_least(passages[0], text) <= m // 10 and found[1][0] == 0

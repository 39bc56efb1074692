"""Mergeable partials: merged batches give what all events at once give, and old events are not read again."""

import datetime as dt
import random
from decimal import Decimal

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from ledgerline.__main__ import main
from ledgerline.operators import audits, rollups
from ledgerline.plans import customer_summary as m1
from ledgerline.plans import faults, materialize, partials, registry, versions
from ledgerline.plans import subscription_revenue as m2
from ledgerline.session import delete_folder, work_dir
from ledgerline.sources import compaction, json_events, schemas
from ledgerline.sources.feeds import load_feeds
from ledgerline.sources.inline import feed_from_rows
from ledgerline.streaming import ingest

SPINE = (dt.date(2024, 1, 1), dt.date(2024, 4, 1))
GOLDEN = {"subscription": fx.SUB_A, "revenue": fx.REV_A, "churn": fx.CHURN_A, "engagement": fx.ENG_A}
AGGREGATES = {"subscription": rollups.agg_sub, "revenue": rollups.agg_rev, "churn": rollups.agg_churn, "engagement": rollups.agg_engage}


def _events(feed, n, seed, users=4):
    """Rows with many equal timestamps, days and ids, in three months."""
    rng, out = random.Random(seed), []
    for i in range(n):
        row = dict(GOLDEN[feed.name])
        month, day, hour = rng.choice([1, 2, 3]), rng.choice([1, 2, 28]), rng.choice([0, 0, 5, 23])
        row.update({feed.pk: f"e{rng.randrange(n // 2)}", "user_id": f"u{rng.randrange(users)}", "event_time": f"2024-0{month}-{day:02d}T{hour:02d}:00:00"})
        for c, t, _ in feed.fields:
            if t == schemas.NUMERIC:
                row[c] = float(Decimal(rng.randrange(10 ** 9)).scaleb(-6))
            elif t == schemas.INTEGER:
                row[c] = rng.randrange(1000)
        for c in partials.MONTH_PICKS[feed.name] + partials.TIME_PICKS.get(feed.name, []):
            if isinstance(row[c], str):
                row[c] = rng.choice("xyz")
        out.append(row)
    return out


def _same(a, b):
    b = b.select(*a.columns)
    assert a.dtypes == b.dtypes
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("name", list(schemas.FEEDS))
def test_merging_in_any_order(spark, name):
    feed = schemas.FEEDS[name]
    rows = _events(feed, 120, seed=len(name))
    whole = feed_from_rows(spark, feed, rows)
    random.Random(1).shuffle(rows)
    parts = [partials.of_events(feed_from_rows(spark, feed, p), feed) for p in (rows[:7], rows[7:80], rows[80:], [])]
    one = partials.merged(partials.merged(parts[2], parts[0], feed), partials.merged(parts[1], parts[3], feed), feed)
    held = one.cache()
    _same(partials.monthly(held, name), AGGREGATES[name](whole))
    if name in partials.TIME_PICKS:
        every = {"subscription": rollups.sub_by_timestamp, "revenue": rollups.rev_by_timestamp}[name](whole)
        span = F.date_format("event_time", "yyyy-MM" if name == "subscription" else "yyyy-MM-dd")
        first = every.groupBy("user_id", span.alias("_s")).agg(F.min("event_time").alias("event_time")).drop("_s")
        _same(partials.timed(held, name), every.join(first, ["user_id", "event_time"], "left_semi"))
    held.unpersist()


class _World:
    """Raw tables, partials and models in a folder of their own, and all events stored so far."""

    def __init__(self, spark):
        self.spark, self.root = spark, work_dir(spark, "test-partials")
        self.partials, self.out = f"{self.root}/partials", f"{self.root}/models"
        self.seen = {name: [] for name in schemas.FEEDS}

    def paths(self, name):
        return ingest.paths_of(schemas.FEEDS[name], self.root)

    def store(self, batch, **rows):
        for name, new in rows.items():
            feed = schemas.FEEDS[name]
            self.seen[name] += new
            messages = json_events.encode_events(feed_from_rows(self.spark, feed, new), feed).select("value")
            ingest.write_batch(messages, batch, feed, self.paths(name))

    def refresh(self, settled=True):
        return {name: partials.refresh(self.spark, self.paths(name).base, self.partials, feed, settled) for name, feed in schemas.FEEDS.items()}

    def update(self):
        return (partials.update_subscription_revenue(self.spark, self.partials, self.out),
                partials.update_customer_summary(self.spark, self.partials, self.out, *SPINE))

    def check(self):
        feeds = {name: feed_from_rows(self.spark, schemas.FEEDS[name], rows) for name, rows in self.seen.items()}
        read = lambda name: materialize.store_at(self.spark, f"{self.out}/{name}", True).read()
        _same(m2.subscription_revenue_summary(feeds), read("subscription_revenue_summary"))
        _same(m1.customer_summary(feeds, *SPINE), read("customer_summary"))


def _in_month(rows, month):
    return [r for r in rows if r["event_time"].startswith(f"2024-0{month}")]


def test_batches_without_reading_old_events(spark, monkeypatch):
    world = _World(spark)
    assert world.refresh() == {name: [] for name in schemas.FEEDS} and world.update() == (None, None)  # nothing ingested yet
    rev, sub, eng = (_events(schemas.FEEDS[n], 60, 5) for n in ("revenue", "subscription", "engagement"))
    world.store(0, revenue=rev[:30], subscription=sub[:30], engagement=eng)
    assert world.refresh(settled=False)["revenue"] == []  # the newest batch may be in the making
    assert world.refresh()["revenue"] == [(2024, 1), (2024, 2), (2024, 3)]
    world.update()
    world.check()
    assert world.refresh() == {name: [] for name in schemas.FEEDS} and world.update() == (0, 0)
    for name in ("revenue", "subscription", "engagement"):  # what is not there can't be read
        for month in (1, 2, 3):
            delete_folder(spark, f"{world.paths(name).table}/year=2024/month={month}/batch=0")
    world.store(1, revenue=_in_month(rev[30:], 2), subscription=_in_month(sub[30:], 2))

    def killed(*args):
        raise RuntimeError("killed before the commit")

    with monkeypatch.context() as m:
        m.setattr(versions, "write_commit", killed)
        with pytest.raises(RuntimeError):
            world.refresh()
    assert world.update() == (0, 0)
    touched = world.refresh()
    assert touched["revenue"] == touched["subscription"] == [(2024, 2)] and touched["engagement"] == []
    assert world.update() == (1, 1)  # the users are the same: only February
    world.check()
    new = fx.with_(fx.CHURN_A, user_id="newcomer", event_time="2024-03-05T00:00:00")
    world.store(2, churn=[new])
    assert world.refresh()["churn"] == [(2024, 3)] and world.update() == (0, None)  # every month has a new row
    world.check()


def test_rejects_compaction_and_lost_commits(spark):
    world = _World(spark)
    feed = schemas.REVENUE
    rev = _events(feed, 80, 9)
    world.store(0, revenue=rev[:20], subscription=_events(schemas.SUBSCRIPTION, 20, 9))
    world.refresh()
    ingest.write_batch(spark.createDataFrame([("{broken",)], "value string"), 1, feed, world.paths("revenue"))
    assert world.refresh()["revenue"] == []  # rejects only, and taken: the note has moved on
    assert partials.store_of(spark, world.partials, feed).note() == "1"
    for batch in (2, 3, 4):
        world.store(batch, revenue=rev[20 * (batch - 1):20 * batch])
    assert compaction.compact(spark, world.paths("revenue").base, feed, min_batches=2)
    assert world.refresh()["revenue"] == [(2024, 1), (2024, 2), (2024, 3)]  # merged before they were taken: made anew
    world.update()
    world.check()
    store = partials.store_of(spark, world.partials, feed)
    assert store.changed_months(store.last()) == [] and store.changed_months(0) is None
    store.vacuum(keep=1)
    assert store.changed_months(1) is None
    world.store(5, revenue=[fx.with_(rev[0], revenue_id="late", event_time="2024-01-01T00:00:00")])
    world.refresh()
    store.vacuum(keep=1)  # the commit that the model was made of is gone
    assert world.update()[0] is None
    world.check()


def test_refresh_command(spark):
    world = _World(spark)
    world.store(0, **{name: [GOLDEN[name]] for name in schemas.FEEDS})
    main(["refresh", "--raw-root", world.root, "--partials", world.partials, "--out", world.out, "--settled"], spark)
    store = materialize.store_at(spark, f"{world.out}/customer_summary", True)
    assert store.read().count() == 84 and store.read().where("total_payment_amount = 5000").count() == 1
    done = main(["refresh", "--raw-root", world.root, "--partials", world.partials, "--out", world.out], spark)
    assert done["customer_summary"] == 0 and store.last() == 1


@pytest.mark.parametrize("versioned", [False, True])
def test_build_counts_violations_while_writing(spark, sf_small, versioned):
    feeds = faults.with_violations(load_feeds(spark, sf_small, names=("subscription", "revenue")))
    out, name = work_dir(spark, "test-observed"), "subscription_revenue_summary"
    counts = registry.build(feeds, out, names=[name], versioned=versioned)[name].first()
    stored = materialize.store_at(spark, f"{out}/{name}", versioned).read()
    assert counts == audits.audit_counts(stored, registry.MODELS[name].audits).first() and sum(counts) > 0
    none = {k: v.limit(0) for k, v in feeds.items()}
    assert sum(registry.build(none, f"{out}/none", names=[name], versioned=versioned)[name].first()) == 0


@pytest.mark.parametrize("name", list(partials.TIME_PICKS))
def test_events_are_dealt_once(spark, name):
    """Month rows and earliest timestamps come from one shuffle of events, a merge from one of partials, the model from one a feed."""
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    feed = schemas.FEEDS[name]
    part = partials.of_events(feed_from_rows(spark, feed, _events(feed, 30, 3)), feed)
    assert shuffles(part) == 1
    path = work_dir(spark, "test-partials")
    part.write.parquet(path)
    stored = spark.read.parquet(path)
    assert shuffles(partials.merged(stored, stored, feed)) == 1

"""Registered queries over the driver's tables: name -> f(spark, sf_dir) -> DataFrame.

Every query reads the whole input tables (through ``sources.feeds``) so its
work grows with them. The customer grid for the driver's data spans
1995-01 .. 2024-12 (orders start in 1995, events are in 2024);
``customer_summary_reference_spine`` keeps the source model's own
2018-01 .. 2024-12 spine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import derive, timefns
from ledgerline.operators import audits, dedup, lookups, rollups, spine
from ledgerline.plans import faults, materialize, partials
from ledgerline.plans.customer_summary import OUTPUT_COLUMNS, customer_month_slice, customer_summary, filled, unfilled_summary
from ledgerline.plans.subscription_revenue import OUTPUT_ORDER, subscription_revenue_summary, summary_of_buckets
from ledgerline.session import ensure_utc, shuffles_dropped, work_dir
from ledgerline.sources import feeds as feedmod
from ledgerline.sources import bucketed, compaction, json_events, raw, schemas
from ledgerline.sources.layout import CODEC
from ledgerline.streaming import ingest as stream_ingest
from ledgerline.streaming import publish

DATA_SPINE = (dt.date(1995, 1, 1), dt.date(2024, 12, 1))
REF_SPINE = (timefns.DEFAULT_SPINE_START, timefns.DEFAULT_SPINE_END)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return register


def _feeds(spark, sf_dir, inject=False, names=None):
    feeds = feedmod.load_feeds(spark, sf_dir, names=names)
    return faults.with_violations(feeds) if inject else feeds


M2_FEEDS = ("subscription", "revenue")


# --- models -----------------------------------------------------------------

@query("customer_summary")
def q_customer_summary(spark, sf_dir):
    """M1 (plan shape of one scan), grid over the data's months."""
    return customer_summary(_feeds(spark, sf_dir), *DATA_SPINE, form="noted")


@query("customer_summary_star")
def q_customer_summary_star(spark, sf_dir):
    """M1, star form: four roll-ups, four left joins, as the model is written."""
    return customer_summary(_feeds(spark, sf_dir), *DATA_SPINE, form="star")


@query("customer_summary_stacked")
def q_customer_summary_stacked(spark, sf_dir):
    """M1, stacked form (one roll-up over the tagged union of the feeds)."""
    return customer_summary(_feeds(spark, sf_dir), *DATA_SPINE, form="stacked")


@query("customer_summary_reference_spine")
def q_customer_summary_ref(spark, sf_dir):
    """M1 with the model's own 2018-01 .. 2024-12 spine."""
    return customer_summary(_feeds(spark, sf_dir), *REF_SPINE, form="noted")


@query("summary_sorted")
def q_summary_sorted(spark, sf_dir):
    """M1 with the model's global ORDER BY user_id, year, month, month_year; row_no is each row's place in that output."""
    return _numbered(customer_summary(_feeds(spark, sf_dir), *DATA_SPINE, sort=True))


def _numbered(ordered: DataFrame) -> DataFrame:
    """row_no from the order in which rows come: partition by partition, and in order within each."""
    path = work_dir(ordered.sparkSession, "ordered")
    with shuffles_dropped(ordered.sparkSession):
        ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")).write.option("compression", CODEC).parquet(path)
    rows = ordered.sparkSession.read.parquet(path)
    # One row a partition, not one a row of data: broadcast, so that the rows stay where they are.
    parts = rows.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    upto = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.withColumn("_before", upto - F.col("n")).drop("n")
    return rows.join(F.broadcast(parts), "_part").withColumn("row_no", F.col("_before") + F.col("_at") - F.col("_first") + 1).select(*ordered.columns, "row_no")


@query("customer_summary_all_feeds")
def q_customer_summary_all(spark, sf_dir):
    """M1 with the event feeds moved to January 1998, where all four feeds meet in one grid row."""
    feeds = _feeds(spark, sf_dir)
    for name in ("churn", "engagement"):
        feeds[name] = feeds[name].withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 312 MONTHS"))
    return customer_summary(feeds, *DATA_SPINE, form="noted")


@query("customer_month_slice")
def q_slice(spark, sf_dir):
    """Minimum slice: subscription feed -> users -> grid -> roll-up -> left join -> fills."""
    return customer_month_slice(feedmod.subscription_feed(spark, sf_dir), *DATA_SPINE)


@query("subscription_revenue_summary")
def q_srs(spark, sf_dir):
    """M2: per (user, revenue day) in months with both a subscription and revenue."""
    return subscription_revenue_summary(_feeds(spark, sf_dir, names=M2_FEEDS))


# --- model parts --------------------------------------------------------------

@query("distinct_users")
def q_distinct_users(spark, sf_dir):
    return spine.distinct_users(_feeds(spark, sf_dir))


@query("month_spine")
def q_month_spine(spark, sf_dir):
    """Calendar: distinct users x the model's 84 months."""
    return spine.calendar(spine.distinct_users(_feeds(spark, sf_dir)), *REF_SPINE)


@query("day_spine")
def q_day_spine(spark, sf_dir):
    """Per engaged user, every day from the first to the last engagement day in the model's years."""
    return spine.day_spine(feedmod.engagement_feed(spark, sf_dir), dt.date(2018, 1, 1), dt.date(2024, 12, 31))


@query("agg_sub")
def q_agg_sub(spark, sf_dir):
    return rollups.agg_sub(feedmod.subscription_feed(spark, sf_dir))


@query("agg_rev")
def q_agg_rev(spark, sf_dir):
    return rollups.agg_rev(feedmod.revenue_feed(spark, sf_dir))


@query("agg_churn")
def q_agg_churn(spark, sf_dir):
    return rollups.agg_churn(feedmod.churn_feed(spark, sf_dir))


@query("agg_engage")
def q_agg_engage(spark, sf_dir):
    return rollups.agg_engage(feedmod.engagement_feed(spark, sf_dir))


@query("rev_by_timestamp")
def q_rev_ts(spark, sf_dir):
    return rollups.rev_by_timestamp(feedmod.revenue_feed(spark, sf_dir))


@query("sub_by_timestamp")
def q_sub_ts(spark, sf_dir):
    return rollups.sub_by_timestamp(feedmod.subscription_feed(spark, sf_dir))


# --- audits (over models built from feeds with rule-injected violations) ------

def _audited_model(spark, sf_dir, name: str) -> DataFrame:
    if name == "customer_summary":
        return customer_summary(_feeds(spark, sf_dir, inject=True), *DATA_SPINE)
    return subscription_revenue_summary(_feeds(spark, sf_dir, inject=True, names=M2_FEEDS))


@query("audit_counts_customer")
def q_audit_counts_customer(spark, sf_dir):
    """Q1-Q5 (and the gap-aware Q1/Q3) on customer_summary, one scan, one row."""
    m = customer_summary(_feeds(spark, sf_dir, inject=True), *DATA_SPINE)
    return audits.audit_counts(m, audits.CUSTOMER_AUDITS + audits.CUSTOMER_GAP_AWARE_AUDITS)


@query("audit_counts_revenue")
def q_audit_counts_revenue(spark, sf_dir):
    """Q6-Q9 on subscription_revenue_summary, one scan, one row."""
    m = subscription_revenue_summary(_feeds(spark, sf_dir, inject=True, names=M2_FEEDS))
    return audits.audit_counts(m, audits.REVENUE_AUDITS)


def _register_audit_rows(audit):
    def run(spark, sf_dir):
        return audits.violations(_audited_model(spark, sf_dir, audit.model), audit)
    run.__doc__ = f"Rows of {audit.model} that break '{audit.name}': {audit.description}."
    query(f"audit_rows_{audit.name}")(run)


for _a in audits.AUDITS.values():
    _register_audit_rows(_a)


# --- ingest, replay, streaming, materialization --------------------------------

def _json_ingest(spark, sf_dir):
    sub = feedmod.subscription_feed(spark, sf_dir)
    enc = json_events.encode_events(sub, schemas.SUBSCRIPTION,
                                    keep=[F.col("subscription_id").cast("bigint").alias("_k")])
    msgs = faults.corrupt_by_rule(enc, F.col("_k")).select("value")
    return json_events.split_valid(json_events.decode_events(msgs, schemas.SUBSCRIPTION),
                                   schemas.SUBSCRIPTION)


@query("json_ingest_valid")
def q_json_valid(spark, sf_dir):
    """Subscription events -> JSON text (some damaged by rule) -> decode -> valid rows."""
    return _json_ingest(spark, sf_dir)[0]


@query("json_ingest_rejects")
def q_json_rejects(spark, sf_dir):
    """Same input: rejected messages with their event id and reason."""
    rejects = _json_ingest(spark, sf_dir)[1]
    # Truncated text still has its id; a message without one has the empty text here.
    return rejects.select(F.regexp_extract("raw", r'"subscription_id":"([^"]*)"', 1).alias("subscription_id"), "reason")


@query("replay_dedup")
def q_replay_dedup(spark, sf_dir):
    """Revenue topic read twice from offset zero (JSON), decoded, de-duplicated by event id."""
    rev = feedmod.revenue_feed(spark, sf_dir)
    msgs = json_events.encode_events(rev, schemas.REVENUE)
    valid, _ = json_events.split_valid(
        json_events.decode_events(msgs.unionByName(msgs), schemas.REVENUE), schemas.REVENUE)
    return dedup.dedup_by_key(valid, [schemas.REVENUE.pk])


@query("stream_ingest_roundtrip")
def q_stream_roundtrip(spark, sf_dir):
    """All four topics as JSON files -> four concurrent streaming ingests (availableNow)
    -> raw tables; returns the engagement table read back."""
    paths = _ingested(spark, sf_dir)
    return stream_ingest.read_raw_table(spark, paths["customer_engagement"], schemas.ENGAGEMENT)


def _ingested(spark, sf_dir, damaged: bool = False) -> dict[str, stream_ingest.IngestPaths]:
    root = work_dir(spark, "ingest")
    sources = {}
    for name, feed in schemas.FEEDS.items():
        landing = f"{root}/landing/{feed.topic}"
        rows = feedmod.FEED_BUILDERS[name](spark, sf_dir)
        if damaged:
            publish.publish_files(_damaged(rows, feed), feed, landing)
        else:
            publish.publish_files(rows, feed, landing)
        sources[feed.topic] = stream_ingest.file_source(spark, landing)
    suffix = root.rsplit("-", 1)[1]
    return stream_ingest.run_ingest(sources, root, table_names={f.topic: f"{f.table}_{suffix}" for f in schemas.FEEDS.values()})


def _digest(text) -> Column:
    """32 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _damaged(rows: DataFrame, feed: schemas.Feed) -> DataFrame:
    """Some rows lose their event id, some their user: both are REQUIRED."""
    key = _digest(F.col(feed.pk))
    return rows.withColumns({
        "user_id": F.when(key % 101 != 1, F.col("user_id")),
        feed.pk: F.when(key % 97 != 1, F.col(feed.pk)),
    })


@query("stream_ingest_tables")
def q_stream_tables(spark, sf_dir):
    """All four topics, some messages without event id or user -> rows, content digest and rejects of each raw table."""
    paths = _ingested(spark, sf_dir, damaged=True)
    out = None
    for feed in schemas.FEEDS.values():
        rows = stream_ingest.read_all(spark, paths[feed.topic], feed)
        valid, bad = F.col("kind") == "valid", F.col("kind") == "rejects"
        # A sum of row digests needs no order, and is equal only for equal rows.
        digest = _digest(F.concat_ws("|", feed.pk, "user_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")))
        one = rows.agg(
            F.count(F.when(valid, 1)).alias("n_rows"),
            F.coalesce(F.sum(F.when(valid, digest)), F.lit(0)).alias("digest"),
            F.count(F.when(bad, 1)).alias("n_rejects"),
            F.count(F.when(bad & F.col("reason").contains(f"missing:{feed.pk}"), 1)).alias("without_id"),
            F.count(F.when(bad & F.col("reason").contains("missing:user_id"), 1)).alias("without_user"),
        ).select(F.lit(feed.table).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _table_digest(rows: DataFrame, feed: schemas.Feed) -> DataFrame:
    """n_rows and a digest of a raw table's rows: a sum, which needs no order and is equal only for equal rows."""
    one = _digest(F.concat_ws("|", feed.pk, "user_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")))
    return rows.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(one), F.lit(0)).alias("digest")).select(F.lit(feed.table).alias("table_name"), "*")


@query("stream_ingest_by_name")
def q_stream_by_name(spark, sf_dir):
    """A topic without a message (churn), one whose messages are all rejected (engagement), two as usual: all four tables read by name."""
    root = work_dir(spark, "ingest")
    suffix = root.rsplit("-", 1)[1]
    sources, names = {}, {}
    for name, feed in schemas.FEEDS.items():
        rows = feedmod.FEED_BUILDERS[name](spark, sf_dir)
        if name == "churn":
            rows = rows.where("churn_event_id is null")
        elif name == "engagement":
            rows = rows.withColumn(feed.pk, F.lit(None).cast("string"))
        publish.publish_files(rows, feed, f"{root}/landing/{feed.topic}")
        sources[feed.topic] = stream_ingest.file_source(spark, f"{root}/landing/{feed.topic}")
        names[feed.topic] = f"{feed.table}_{suffix}"
    stream_ingest.run_ingest(sources, root, table_names=names)
    out = [_table_digest(raw.read_raw_feed(spark, n, names[f.topic]), f) for n, f in schemas.FEEDS.items()]
    return reduce(DataFrame.unionByName, out)


@query("ingest_compacted")
def q_ingest_compacted(spark, sf_dir):
    """The engagement topic ingested in many batches, the older ones merged by a compaction; returns the table's rows by name."""
    root = work_dir(spark, "ingest")
    feed = schemas.ENGAGEMENT
    name = f"{feed.table}_{root.rsplit('-', 1)[1]}"
    publish.publish_files(feedmod.engagement_feed(spark, sf_dir).repartition(4), feed, f"{root}/landing")
    source = stream_ingest.file_source(spark, f"{root}/landing", max_files_per_trigger=1)
    paths = stream_ingest.run_ingest({feed.topic: source}, root, table_names={feed.topic: name})[feed.topic]
    if not compaction.compact(spark, paths.base, feed, min_batches=2, table=name):
        raise RuntimeError("nothing was merged")
    return raw.read_raw_feed(spark, feed.name, name)


@query("ingest_replays_refused")
def q_replays_refused(spark, sf_dir):
    """The revenue topic, some messages without user: four fifths ingested, then the whole topic again twice over; each message is stored
    once. Returns rows, content digest and rejects of the table, and the rows that came with the second batch."""
    root = work_dir(spark, "ingest")
    feed = schemas.REVENUE
    key = _digest(F.col(feed.pk))
    rows = feedmod.revenue_feed(spark, sf_dir).withColumn("user_id", F.when(key % 101 != 1, F.col("user_id")))
    names = {feed.topic: f"{feed.table}_{root.rsplit('-', 1)[1]}"}
    for part in (rows.where(key % 5 != 0), rows.unionByName(rows)):
        publish.publish_files(part, feed, f"{root}/landing")
        source = stream_ingest.file_source(spark, f"{root}/landing")
        paths = stream_ingest.run_ingest({feed.topic: source}, root, table_names=names, refuse_replays=True)[feed.topic]
    stored = stream_ingest.read_all(spark, paths, feed)
    valid = F.col("kind") == "valid"
    digest = _digest(F.concat_ws("|", feed.pk, "user_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")))
    return stored.agg(
        F.count(F.when(valid, 1)).alias("n_rows"),
        F.coalesce(F.sum(F.when(valid, digest)), F.lit(0)).alias("digest"),
        F.count(F.when(~valid, 1)).alias("n_rejects"),
        F.count(F.when(valid & (F.col("batch") > 0), 1)).alias("n_late"),
    ).select(F.lit(feed.table).alias("table_name"), "*")


MISSING_MONTH, STRAY_MONTH = "1998-06", "2003-01"
JUNE_98, JAN_03 = dt.date(1998, 6, 1), dt.date(2003, 1, 1)
M1_COLUMNS = ["user_id", "year", "month", "month_year"] + [c for c, _ in OUTPUT_COLUMNS]


def _model_columns(spark, path: str, columns) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


@query("restate_month")
def q_restate_month(spark, sf_dir):
    """M1 stored from an older version of the feeds (a month's events missing, and stray in another), then both months restated."""
    feeds = _feeds(spark, sf_dir)
    path = work_dir(spark, "customer_summary")
    materialize.write_model(unfilled_summary(faults.another_version(feeds, MISSING_MONTH, STRAY_MONTH), *DATA_SPINE), path, finish=filled)
    for month in (JUNE_98, JAN_03):
        materialize.restate_customer_summary(feeds, path, month, month, spine_start=DATA_SPINE[0], spine_end=DATA_SPINE[1])
    return _model_columns(spark, path, M1_COLUMNS)


@query("restate_new_users")
def q_restate_users(spark, sf_dir):
    """M1 stored before some users had joined, then one month restated: the whole grid has them."""
    feeds = _feeds(spark, sf_dir)
    path = work_dir(spark, "customer_summary")
    materialize.write_model(unfilled_summary(faults.without_a_user(feeds), *DATA_SPINE), path, finish=filled)
    materialize.restate_customer_summary(feeds, path, JUNE_98, JUNE_98, spine_start=DATA_SPINE[0], spine_end=DATA_SPINE[1])
    return _model_columns(spark, path, M1_COLUMNS)


@query("restate_revenue_months")
def q_restate_revenue(spark, sf_dir):
    """M2 stored from the older version, then both months restated; the stray month becomes empty."""
    feeds = _feeds(spark, sf_dir, names=M2_FEEDS)
    path = work_dir(spark, "subscription_revenue")
    old = subscription_revenue_summary(faults.another_version(feeds, MISSING_MONTH, STRAY_MONTH))
    materialize.write_model(old, path, cluster_by=("user_id", "event_date"))
    for month in (JUNE_98, JAN_03):
        materialize.restate_subscription_revenue(feeds, path, month, month)
    return _model_columns(spark, path, old.columns)


@query("restate_one_commit")
def q_restate_commit(spark, sf_dir):
    """M2 in versions: stored from the older version of the feeds, both months restated by one commit each; the first version still reads as it was."""
    feeds = _feeds(spark, sf_dir, names=M2_FEEDS)
    path = work_dir(spark, "subscription_revenue")
    old = subscription_revenue_summary(faults.another_version(feeds, MISSING_MONTH, STRAY_MONTH))
    store = materialize.store_at(spark, path, versioned=True)
    first = store.write(old, ("user_id", "event_date"))
    for month in (JUNE_98, JAN_03):
        materialize.restate_subscription_revenue(feeds, path, month, month, versioned=True)
    june = (F.col("year") == JUNE_98.year) & (F.col("month") == JUNE_98.month)
    if not store.read(first).where(june).isEmpty():
        raise RuntimeError("the first version has changed")
    return store.read().select(*old.columns)


@query("rebuild_revenue")
def q_rebuild(spark, sf_dir):
    """M2 built from the older version, then in full again: no stale month stays, even in a session with dynamic overwrite."""
    feeds = _feeds(spark, sf_dir, names=M2_FEEDS)
    path = work_dir(spark, "subscription_revenue")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for version in (faults.another_version(feeds, MISSING_MONTH, STRAY_MONTH), feeds):
            model = subscription_revenue_summary(version)
            materialize.write_model(model, path, cluster_by=("user_id", "event_date"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    return _model_columns(spark, path, model.columns)


def _kept_up(spark, sf_dir, names, update) -> str:
    """Raw tables stored in two batches, a fifth of each month's events late; after each batch partials and model are brought up to it."""
    feeds = _feeds(spark, sf_dir, names=names)
    root = work_dir(spark, "partials")
    for batch in (0, 1):
        for name, rows in feeds.items():
            feed = schemas.FEEDS[name]
            late = _digest(F.col(feed.pk)) % 5 == 0
            paths = stream_ingest.paths_of(feed, root)
            messages = json_events.encode_events(rows.where(late if batch else ~late), feed).select("value")
            stream_ingest.write_batch(messages, batch, feed, paths)
            partials.refresh(spark, paths.base, f"{root}/partials", feed, settled=True)
        update(spark, f"{root}/partials", f"{root}/models")
    return f"{root}/models"


@query("incremental_customer_summary")
def q_incremental_customer(spark, sf_dir):
    """M1 from mergeable partials: made of a first batch of events, then brought up to a second without reading the first again."""
    out = _kept_up(spark, sf_dir, tuple(schemas.FEEDS), lambda *at: partials.update_customer_summary(*at, *DATA_SPINE))
    return materialize.store_at(spark, f"{out}/customer_summary", versioned=True).read().select(*M1_COLUMNS)


@query("incremental_revenue_summary")
def q_incremental_revenue(spark, sf_dir):
    """M2 from mergeable partials, brought up to a second batch in the same way."""
    out = _kept_up(spark, sf_dir, M2_FEEDS, partials.update_subscription_revenue)
    return materialize.store_at(spark, f"{out}/subscription_revenue_summary", versioned=True).read().select(*OUTPUT_ORDER)


@query("revenue_summary_bucketed")
def q_revenue_bucketed(spark, sf_dir):
    """M2 from feeds stored in buckets of user and month: scans, roll-ups and join without a shuffle."""
    root = work_dir(spark, "buckets")
    for name, rows in _feeds(spark, sf_dir, names=M2_FEEDS).items():
        bucketed.store(rows, schemas.FEEDS[name], root)
    return summary_of_buckets({name: bucketed.read(spark, schemas.FEEDS[name], root) for name in M2_FEEDS})


@query("customer_summary_bucketed")
def q_customer_bucketed(spark, sf_dir):
    """M1 from the four feeds stored so: the roll-ups read whole groups and shuffle nothing but their results."""
    root = work_dir(spark, "buckets")
    for name, rows in _feeds(spark, sf_dir).items():
        bucketed.store(rows, schemas.FEEDS[name], root)
    return customer_summary(bucketed.read_all(spark, root), *DATA_SPINE)


# --- derived-column rules, lookups -------------------------------------------------

@query("derived_subscription")
def q_derived_sub(spark, sf_dir):
    """Annualize, season class and clip per subscription event, NULL inputs among them."""
    s = feedmod.subscription_feed(spark, sf_dir)
    rate = F.when(F.col("subscription_id").cast("bigint") % 11 != 0, F.col("growth_rate"))
    return s.select(
        "subscription_id",
        derive.annualize("subscription_amount").cast("decimal(38,9)").alias("annualized"),
        derive.season_class(F.month("event_time")).alias("season"),
        derive.clip(rate, Decimal("-0.5"), Decimal("0.5")).cast("decimal(38,9)").alias("clipped_growth_rate"),
    )


@query("derived_revenue")
def q_derived_rev(spark, sf_dir):
    """Due date, wire text, season class and delinquency rule per revenue event; absent events are dropped."""
    r = faults.some_absent(feedmod.revenue_feed(spark, sf_dir)).where(F.col("event").isNotNull()).select("event.*")
    return r.select(
        "revenue_id",
        derive.due_date("event_time").alias("due_date_rule"),
        timefns.to_wire_text("event_time").alias("event_time_text"),
        derive.season_class(F.month("event_time")).alias("season"),
        derive.delinquency("repayment_status", F.col("capital_utilization")).alias("delinquency_rule"),
    )


@query("derived_churn")
def q_derived_churn(spark, sf_dir):
    """Churn score from the row's own base and both high-risk defaults per churn event, NULL inputs among them."""
    c = feedmod.churn_feed(spark, sf_dir)
    key = F.col("churn_event_id").cast("bigint")
    drop = F.when(key % 13 != 0, F.col("usage_drop_percentage"))
    inputs = (feedmod.churn_base(key), "support_ticket_count", drop, "satisfaction_score")
    raw = derive.churn_risk_raw(*inputs)
    return c.select(
        "churn_event_id",
        derive.churn_score(*inputs).alias("churn_score_rule"),
        derive.high_risk_default(raw, F.lit("other"), F.lit("none")).alias("reason_rule"),
        derive.high_risk_default(raw, key % 2 == 1, F.lit(False)).alias("withdrawal_rule"),
    )


@query("derived_engagement")
def q_derived_eng(spark, sf_dir):
    """Zero-guarded conversion rate and clipped score per engagement event."""
    e = feedmod.engagement_feed(spark, sf_dir)
    return e.select(
        "engagement_id",
        derive.guarded_rate("financing_inquiries", "financing_conversion_rate").alias("guarded_rate_rule"),
        derive.clip("engagement_score", 10, 90).cast("bigint").alias("clipped_score"),
    )


@query("profile_lookup")
def q_profile_lookup(spark, sf_dir):
    """Revenue events with the user's profile attached."""
    rev = feedmod.revenue_feed(spark, sf_dir).select("revenue_id", "user_id", "payment_amount")
    return lookups.lookup_profiles(rev, feedmod.user_profiles(spark, sf_dir))


@query("cohort_month")
def q_cohort_month(spark, sf_dir):
    """Calendar rows (users x model months) that are a churn user's churn month."""
    f = _feeds(spark, sf_dir)
    cal = spine.calendar(spine.distinct_users(f), *REF_SPINE)
    cohort = rollups.with_month(f["churn"].select("user_id", "event_time"))
    return lookups.in_cohort(cal, cohort, ["user_id", "year", "month"])

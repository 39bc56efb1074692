"""End-to-end: streaming ingest, replay, restatement and the driver contract."""

import datetime as dt

from fixtures import CHURN_A
from pyspark.sql import functions as F

from ledgerline.plans import faults, materialize
from ledgerline.plans.catalog import DATA_SPINE
from ledgerline.plans.customer_summary import customer_summary
from ledgerline.session import work_dir
from ledgerline.sources import json_events, schemas
from ledgerline.sources.feeds import churn_feed, load_feeds
from ledgerline.sources.inline import feed_from_rows
from ledgerline.streaming import ingest


def _land(spark, df, feed, path):
    json_events.encode_events(df, feed).write.mode("append").text(path)


def _names(root, *topics):
    return {t: f"raw_{t}_{root.rsplit('-', 1)[1]}" for t in topics}


def test_stream_ingest_equals_batch_and_is_idempotent(spark, sf_small):
    root = work_dir(spark, "test-ingest")
    landing = f"{root}/landing/churn"
    src = churn_feed(spark, sf_small)
    _land(spark, src, schemas.CHURN, landing)
    bad = spark.createDataFrame([('{"churn_event_id":"x"',), ('{"user_id":"u"}',)], "value string")
    bad.write.mode("append").text(landing)
    names = _names(root, "churn")

    paths = ingest.run_ingest({"churn": ingest.file_source(spark, landing)}, root, table_names=names)
    table = ingest.read_raw_table(spark, paths["churn"], schemas.CHURN)
    assert table.exceptAll(src).count() == 0 and src.exceptAll(table).count() == 0
    rejects = ingest.read_rejects(spark, paths["churn"], schemas.CHURN)
    assert rejects.count() == 2
    assert spark.table(names["churn"]).count() == src.count()  # created first, its partitions registered

    # A second run over the same landing folder adds nothing (offsets in the checkpoint).
    ingest.run_ingest({"churn": ingest.file_source(spark, landing)}, root, table_names=names)
    assert ingest.read_raw_table(spark, paths["churn"], schemas.CHURN).count() == src.count()


def test_batch_run_again_replaces_itself(spark, sf_small):
    root = work_dir(spark, "test-again")
    paths = ingest.paths_of(schemas.CHURN, root)
    src = churn_feed(spark, sf_small)
    messages = json_events.encode_events(src, schemas.CHURN)
    for batch in (0, 1, 1, 0):  # as if stopped after each write and before its commit
        ingest.write_batch(messages.limit(50) if batch == 0 else messages.unionByName(messages.limit(1).selectExpr("'{' AS value")), batch, schemas.CHURN, paths)
    assert ingest.read_raw_table(spark, paths, schemas.CHURN).count() == 50 + src.count()
    assert ingest.read_rejects(spark, paths, schemas.CHURN).count() == 1


def test_stopped_stream_goes_on_without_loss_or_repeats(spark, sf_small):
    root = work_dir(spark, "test-stop")
    landing = f"{root}/landing/churn"
    src = churn_feed(spark, sf_small)
    json_events.encode_events(src, schemas.CHURN).repartition(6).write.text(landing)
    paths = ingest.paths_of(schemas.CHURN, root)
    source = lambda: ingest.file_source(spark, landing, max_files_per_trigger=1)

    def failing(df, batch_id):
        ingest.write_batch(df, batch_id, schemas.CHURN, paths)
        if batch_id == 2:
            raise RuntimeError("stopped after the write, before the commit")

    q = source().writeStream.foreachBatch(failing).option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001
        pass
    assert q.exception() is not None
    ingest.start_feed_ingest(source(), schemas.CHURN, paths).awaitTermination()
    table = ingest.read_raw_table(spark, paths, schemas.CHURN)
    assert table.exceptAll(src).count() == 0 and src.exceptAll(table).count() == 0


def test_kafka_options():
    from ledgerline.streaming import publish

    assert ingest.kafka_options("h:1", "churn", max_offsets_per_trigger=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "churn", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5"}
    assert ingest.kafka_options("h:1", "churn", streaming=False)["endingOffsets"] == "latest"
    assert publish.kafka_options(schemas.CHURN, "h:1") == {"kafka.bootstrap.servers": "h:1", "topic": "churn"}


def test_restate_replaces_exactly_the_month(spark, sf_small):
    f = load_feeds(spark, sf_small)
    old = faults.another_version(f, "1996-03", "2003-01")
    path = work_dir(spark, "test-restate")
    month = dt.date(1996, 3, 1)
    span = dict(spine_start=dt.date(1996, 1, 1), spine_end=dt.date(1996, 4, 1))
    full, stale = (customer_summary(x, *span.values()) for x in (f, old))
    materialize.write_model(stale, path)
    materialize.restate_customer_summary(f, path, month, month, **span)
    back = spark.read.parquet(path).select(*full.columns)
    assert back.exceptAll(full).count() == 0 and full.exceptAll(back).count() == 0
    assert stale.exceptAll(full).count() > 0


def test_full_refresh_replaces_everything(spark):
    path = work_dir(spark, "test-refresh")
    rows = spark.createDataFrame([("a", 2020, 1), ("b", 2020, 2)], "user_id string, year int, month int")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        materialize.write_model(rows, path)
        materialize.write_model(rows.where("month = 1"), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["user_id"] for r in spark.read.parquet(path).collect()] == ["a"]


def test_entry_and_contract(spark):
    import __spark_entry__ as ent

    df = ent.entry(spark)
    assert df.count() > 0
    qs, sqls = ent.queries(), ent.oracle_sql()
    assert set(sqls) <= set(qs)
    from ledgerline.plans.catalog import QUERIES

    assert set(QUERIES) <= set(sqls)  # each query of the models has its SQL
    assert "customer_summary" in qs and "subscription_revenue_summary" in qs


def test_registry_build_writes_and_audits(spark, sf_small):
    from ledgerline.plans import registry

    out = work_dir(spark, "test-build")
    f = load_feeds(spark, sf_small)
    res = registry.build(f, out)
    counts = res["subscription_revenue_summary"].first().asDict()
    assert counts["repayment_delinquency_consistency"] == 0
    assert spark.read.parquet(f"{out}/customer_summary").count() > 0


def test_ensure_raw_table_and_publish(spark, sf_small):
    from ledgerline.sources.tables_admin import ensure_raw_table
    from ledgerline.streaming.publish import publish_files

    root = work_dir(spark, "test-tables")
    name = ensure_raw_table(spark, schemas.CHURN, f"{root}/raw_churn", name="raw_churn_events_t")
    assert spark.catalog.tableExists(name)
    assert ensure_raw_table(spark, schemas.CHURN, f"{root}/raw_churn", name=name) == name
    assert [c.name for c in spark.table(name).schema][:3] == ["churn_event_id", "user_id", "event_time"]
    src = churn_feed(spark, sf_small)
    publish_files(src, schemas.CHURN, f"{root}/landing")
    assert spark.read.text(f"{root}/landing").count() == src.count()


def test_ingest_then_build_end_to_end(spark, sf_small):
    """JSON landing files -> streaming ingest -> raw tables -> models -> audits."""
    from ledgerline.plans import registry
    from ledgerline.sources.feeds import FEED_BUILDERS
    from ledgerline.sources.raw import read_raw_feeds
    from ledgerline.streaming.publish import publish_files

    root = work_dir(spark, "test-e2e")
    sources = {}
    for name, feed in schemas.FEEDS.items():
        publish_files(FEED_BUILDERS[name](spark, sf_small), feed, f"{root}/landing/{feed.topic}")
        sources[feed.topic] = ingest.file_source(spark, f"{root}/landing/{feed.topic}")
    paths = ingest.run_ingest(sources, root, table_names=_names(root, *sources))
    raw = read_raw_feeds(spark, {name: paths[feed.topic].table for name, feed in schemas.FEEDS.items()})
    res = registry.build(raw, f"{root}/models")
    direct = customer_summary(load_feeds(spark, sf_small))
    built = spark.read.parquet(f"{root}/models/customer_summary").select(*direct.columns)
    assert built.exceptAll(direct).count() == 0 and direct.exceptAll(built).count() == 0
    assert res["customer_summary"].first()["key_dimensions_not_null"] == 0


def test_restate_model2_empties_stale_months(spark, sf_small):
    from ledgerline.plans import registry
    from ledgerline.plans.subscription_revenue import subscription_revenue_summary

    out = work_dir(spark, "test-restate2")
    f = load_feeds(spark, sf_small, names=("subscription", "revenue"))
    registry.build(faults.another_version(f, "1997-03", "2003-01"), out, names=["subscription_revenue_summary"])
    registry.restate("subscription_revenue_summary", f, out, dt.date(1997, 3, 1), dt.date(2003, 1, 1))
    full = subscription_revenue_summary(f)
    back = spark.read.parquet(f"{out}/subscription_revenue_summary").select(*full.columns)
    assert back.exceptAll(full).count() == 0 and full.exceptAll(back).count() == 0


def test_command_line_ingest_build_restate_audit(spark, sf_small):
    from ledgerline.__main__ import main
    from ledgerline.sources.feeds import FEED_BUILDERS
    from ledgerline.streaming.publish import publish_files

    root = work_dir(spark, "test-cli")
    for name, feed in schemas.FEEDS.items():
        publish_files(FEED_BUILDERS[name](spark, sf_small), feed, f"{root}/landing/{feed.topic}")
    for f in schemas.FEEDS.values():  # the command uses the feeds' own table names
        spark.sql(f"DROP TABLE IF EXISTS {f.table}")
    tables = main(["ingest", "--landing", f"{root}/landing", "--root", f"{root}/raw", "--max-files", "1000"], spark=spark)
    assert set(tables) == {f.topic for f in schemas.FEEDS.values()}
    built = main(["build", "--raw-root", f"{root}/raw", "--out", f"{root}/models"], spark=spark)
    assert built["subscription_revenue_summary"]["repayment_delinquency_consistency"] == 0
    main(["restate", "--raw-root", f"{root}/raw", "--out", f"{root}/models",
          "--model", "customer_summary", "--start", "1996-01-01", "--end", "1996-02-01"], spark=spark)
    audited = main(["audit", "--out", f"{root}/models"], spark=spark)
    assert audited["customer_summary"] == built["customer_summary"]
    assert "allowed_repayment_and_trend_skip_gaps" in built["customer_summary"]
    assert main(["publish", "--raw-root", f"{root}/raw", "--landing", f"{root}/again", "--feed", "churn"], spark=spark) == {"churn": "churn"}
    sent = lambda where: spark.read.text(f"{root}/{where}/churn")
    assert sent("again").exceptAll(sent("landing")).count() == 0


def test_landing_files_are_compressed_and_bounded(spark, monkeypatch):
    """Published messages take a fraction of their text on disk, in several files, and are all ingested."""
    from ledgerline.session import _place
    from ledgerline.streaming import publish

    monkeypatch.setattr(publish, "FILE_MESSAGES", 1000)
    root = work_dir(spark, "test-landing")
    n, feed = 4000, schemas.CHURN
    src = feed_from_rows(spark, feed, [CHURN_A]).drop("churn_event_id").crossJoin(spark.range(n).selectExpr("cast(id as string) as churn_event_id"))
    publish.publish_files(src.select(*feed.columns).coalesce(1), feed, f"{root}/landing")
    place, files = _place(spark, f"{root}/landing")
    sent = spark.read.text(f"{root}/landing")
    assert files.getContentSummary(place).getLength() * 5 < sent.agg(F.sum(F.length("value"))).first()[0]
    assert sent.select(F.input_file_name()).distinct().count() == 4
    paths = ingest.run_ingest({feed.topic: ingest.file_source(spark, f"{root}/landing")}, root, table_names={feed.topic: "raw_landing_t"})
    stored = ingest.read_raw_table(spark, paths[feed.topic], feed)
    assert stored.count() == n and stored.exceptAll(src.select(*stored.columns)).isEmpty()

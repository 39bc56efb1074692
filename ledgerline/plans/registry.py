"""Model registry and the build entry point.

Each model is a function of the four feeds, materialized in full (FULL
kind) with its audits attached explicitly. ``build`` writes the requested
models and returns one row of audit counts per model; models read only raw
feeds, never each other, so they can be built in any order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from ledgerline.operators import audits
from ledgerline.plans import materialize
from ledgerline.plans.customer_summary import customer_summary
from ledgerline.plans.subscription_revenue import subscription_revenue_summary, summary_of_buckets


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    keys: tuple
    kind: str = "FULL"
    audits: list = field(default_factory=list)
    of_buckets: Callable[[dict[str, DataFrame]], DataFrame] | None = None  # from feeds stored in buckets; None: as ``build``


MODELS: dict[str, Model] = {
    "customer_summary": Model(
        "customer_summary", lambda feeds: customer_summary(feeds),
        ("user_id", "year", "month"), audits=audits.CUSTOMER_AUDITS + audits.CUSTOMER_GAP_AWARE_AUDITS),
    "subscription_revenue_summary": Model(
        "subscription_revenue_summary", subscription_revenue_summary,
        ("user_id", "event_date"), audits=audits.REVENUE_AUDITS, of_buckets=summary_of_buckets),
}


def build(feeds: dict[str, DataFrame], out_root: str, names=None, versioned: bool = False, bucketed: bool = False) -> dict[str, DataFrame]:
    """Materialize models under ``out_root/<name>`` and audit the written tables.

    ``versioned``: each as a new version of its table, in one commit. ``bucketed``: the feeds come from ``sources.bucketed``.
    Returns name -> one-row DataFrame of violation counts per attached audit,
    observed by the job that writes the table; the table is not read again.
    """
    results = {}
    for name in names or MODELS:
        model = MODELS[name]
        path = f"{out_root.rstrip('/')}/{name}"
        df = (bucketed and model.of_buckets or model.build)(feeds)
        spark, seen = df.sparkSession, Observation()
        counts = audits.count_columns(model.audits)
        store = materialize.store_at(spark, path, versioned)
        store.write(df, tuple(k for k in model.keys if k not in materialize.PARTITION_COLUMNS), observed=(seen, *counts))
        found = seen.get
        schema = ", ".join(f"`{a.name}` bigint" for a in model.audits)
        results[name] = spark.createDataFrame([tuple(found.get(a.name, 0) for a in model.audits)], schema)
    return results


RESTATERS = {
    "customer_summary": materialize.restate_customer_summary,
    "subscription_revenue_summary": materialize.restate_subscription_revenue,
}


def restate(name: str, feeds: dict[str, DataFrame], out_root: str,
            first_month: dt.date, last_month: dt.date, versioned: bool = False) -> None:
    """Recompute one model for [first_month, last_month] and replace just those
    (year, month) partitions of its table under ``out_root/<name>``."""
    RESTATERS[name](feeds, f"{out_root.rstrip('/')}/{name}", first_month, last_month, versioned=versioned)

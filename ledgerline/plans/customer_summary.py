"""Model ``customer_summary``: dense customer x month grid with gap fills.

Rows = distinct users x spine months, exactly (each roll-up is unique on
(user_id, year, month), so the left joins never multiply rows). Columns: keys,
month text, and 27 roll-up columns with NULL filled by 'N/A', 0 or FALSE.

Four plan shapes give the same rows:

* ``grid`` (the default): the feeds' roll-ups are put side by side where they are, and the empty
  months are made beside them, as constants, from the users' months alone (``_empty_months``), a
  second scan of each feed. No wide row is shuffled after its roll-up, nothing is joined to a grid,
  and what asks for months with events only, as most audits do, never makes the others.
* ``noted``: the same for those who want the whole grid, from one scan. Each event leaves a note of its month
  with its user (``_noted``) in the shuffle that deals it anyway, and a user's notes become the empty months.

* ``star``: the model as written - four monthly roll-ups, each left-joined to
  the calendar. All joins use the same keys, so after the calendar is
  shuffled once on (user_id, year, month) each roll-up only shuffles itself.
* ``stacked``: the three feeds that need ANY_VALUE picks (subscription,
  revenue, churn) are tagged, unioned and rolled up by one aggregate;
  engagement - by far the largest feed, without picks - keeps its own hash
  aggregate. Two roll-up shuffles instead of four and two joins over the
  grid instead of four, with the engagement rows never passing through the
  sort-based aggregate that string picks need.

The user list of star and stacked is a distinct over the raw feeds' user_id alone, a second
scan of each feed; they also take a given user list, as month-range restatement needs.

No shape broadcasts anything that grows with the data; AQE may still
turn a join into a broadcast at runtime when a side measures small.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import timefns
from ledgerline.functions.picks import pick_struct
from ledgerline.operators import rollups, spine
from ledgerline.operators.rollups import MONTH_KEYS
from ledgerline.sources.schemas import FEEDS

# Fill used for each output column when its month has no event.
STRING_FILL = "N/A"
OUTPUT_COLUMNS = [
    ("subscription_plan", STRING_FILL), ("region", STRING_FILL), ("user_segment", STRING_FILL),
    ("avg_growth_rate", 0), ("total_annualized_revenue", 0), ("avg_customer_growth_rate", 0),
    ("total_payment_amount", 0), ("avg_revenue_stability_score", 0), ("total_advance_amount", 0),
    ("repayment_status", STRING_FILL), ("revenue_trend", STRING_FILL), ("avg_revenue_volatility", 0),
    ("payment_delinquency", STRING_FILL),
    ("avg_churn_risk", 0), ("avg_customer_tenure", 0), ("avg_last_activity_gap", 0),
    ("total_support_ticket_count", 0), ("avg_usage_drop_percentage", 0), ("avg_satisfaction_score", 0),
    ("cancellation_reason", STRING_FILL), ("capital_withdrawal_flag", False),
    ("avg_engagement_score", 0), ("avg_session_duration", 0), ("total_login_count", 0),
    ("total_financing_inquiries", 0), ("total_feature_interaction_count", 0),
    ("total_capital_access_count", 0),
]
SORT_KEYS = ["user_id", "year", "month", "month_year"]
#: Rows before the fills may hold the output columns in one, which is NULL in an empty month, and no month text.
VALUES = "_values"
#: Among such rows a user's empty months of one year may be one row, without a month: bit m - 1 of this column stands for month m. NULL in other rows.
EMPTY = "_empty"
#: Where an event's note has its month's place in the spine.
NOTE = "_note"


def _fill(joined: DataFrame) -> DataFrame:
    types = dict(joined.dtypes)
    return joined.select(
        "user_id", "year", "month", "month_year",
        *[F.coalesce(F.col(c), F.lit(v).cast(types[c])).alias(c) for c, v in OUTPUT_COLUMNS],
    )


def spread(rows: DataFrame) -> DataFrame:
    """Rows as dealt -> a row each month."""
    if EMPTY not in rows.columns:
        return rows
    months = F.when(F.col(EMPTY).isNull(), F.array("month")).otherwise(F.expr(f"filter(sequence(1, 12), m -> shiftright({EMPTY}, m - 1) & 1 = 1)"))
    return rows.withColumn("month", F.explode(months)).select(*MONTH_KEYS, VALUES)


def filled(rows: DataFrame) -> DataFrame:
    """The model's rows from ``unfilled_summary`` or ``unfilled_of_rollups``: narrow to the end, so that what deals and sorts them does not carry the fills."""
    if VALUES not in rows.columns:
        return _fill(rows)
    text = F.concat_ws("-", F.lpad(F.col("year").cast("string"), 4, "0"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return _fill(spread(rows).select(*MONTH_KEYS, text.alias("month_year"), f"{VALUES}.*"))


def _star(feeds: dict[str, DataFrame], start: dt.date, end: dt.date,
          users: DataFrame | None = None) -> DataFrame:
    cal = _calendar(users if users is not None else spine.distinct_users(feeds), start, end)
    return reduce(lambda acc, part: acc.join(part, MONTH_KEYS, "left"), _rolled_up(feeds), cal)


def _calendar(users: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The grid, dealt for joins on MONTH_KEYS to an explicit number of tasks: adaptive execution would coalesce the narrow rows to
    hardly more tasks than there are cores, and the wide ones they become are made and written in the last few of them. Dealt
    are users and first days; what else a row has is made of the day behind that."""
    days = timefns.month_sequence(timefns.month_start(start), timefns.month_start(end))
    users = users.repartition(_width(users))  # see spine.calendar
    cal = users.select("user_id", F.explode(days).alias("_day"))
    cal = cal.repartition(_width(cal), "user_id", timefns.year_of("_day"), timefns.month_of("_day"))
    cal = rollups.with_month(cal, "_day").drop("_day")
    _, at = _place(start, end)
    return cal.select(*MONTH_KEYS, F.element_at(timefns.month_rows(start, end), at + 1)["month_year"].alias("month_year"))


def _rolled_up(feeds: dict[str, DataFrame], spine: tuple[dt.date, dt.date] | None = None) -> list[DataFrame]:
    """The four roll-ups; with ``spine``, also the notes (``_noted``). Subscriptions and revenue are dealt as events, few to a
    user's month; churn and engagement, of which one user's month may have any number, as partial rows."""
    notes = _notes(spine) if spine else {}
    rows = {name: _noted(df, _read_by_rollup(name), spine) if spine else df for name, df in feeds.items()}
    return [
        rollups.agg_sub(_dealt(rows["subscription"], _read_by_rollup("subscription")), **notes),
        rollups.agg_rev(_dealt(rows["revenue"], _read_by_rollup("revenue")), **notes),
        rollups.agg_churn(rows["churn"], **notes),
        rollups.agg_engage(rows["engagement"], **notes),
    ]


PICKS = {"subscription": rollups.SUB_PICKS, "revenue": rollups.REV_PICKS, "churn": rollups.CHURN_PICKS, "engagement": []}


def _read_by_rollup(feed: str) -> list[str]:
    """The columns of a feed that its roll-up reads, beside user and time."""
    return [FEEDS[feed].pk, *[c for _, c, _ in rollups.MEASURES[feed]], *PICKS[feed]]


def _picked(feeds: dict[str, DataFrame]) -> DataFrame:
    """Monthly roll-up of the three feeds with picks, in one aggregate over their tagged union."""
    needed = {
        "s": (feeds["subscription"], ["subscription_id", "subscription_plan", "region", "user_segment",
                                      "growth_rate", "annualized_revenue", "customer_growth_rate"]),
        "r": (feeds["revenue"], ["revenue_id", "payment_amount", "revenue_stability_score",
                                 "advance_amount", "repayment_status", "revenue_trend",
                                 "revenue_volatility", "payment_delinquency"]),
        "c": (feeds["churn"], ["churn_event_id", "churn_risk", "customer_tenure_days",
                               "last_activity_gap_days", "support_ticket_count",
                               "usage_drop_percentage", "satisfaction_score",
                               "cancellation_reason", "capital_withdrawal_flag"]),
    }
    tagged = [
        rollups.with_month(df.select("user_id", "event_time", *cols)).withColumn("_feed", F.lit(tag))
        for tag, (df, cols) in needed.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    feed = F.col("_feed")
    picked = stacked.groupBy(*MONTH_KEYS).agg(
        pick_struct(rollups.SUB_PICKS, ["event_time", "subscription_id"], when=feed == "s").alias("_ps"),
        pick_struct(rollups.REV_PICKS, ["event_time", "revenue_id"], when=feed == "r").alias("_pr"),
        pick_struct(rollups.CHURN_PICKS, ["event_time", "churn_event_id"], when=feed == "c").alias("_pc"),
        *rollups.sub_measures(), *rollups.rev_measures(), *rollups.churn_measures(),
    )
    picks = {c: f"_ps.{c}" for c in rollups.SUB_PICKS}
    picks.update({c: f"_pr.{c}" for c in rollups.REV_PICKS})
    picks.update({c: f"_pc.{c}" for c in rollups.CHURN_PICKS})
    stacked_cols = rollups.SUB_COLUMNS + rollups.REV_COLUMNS + rollups.CHURN_COLUMNS
    return picked.select(*MONTH_KEYS, *[F.col(picks.get(c, c)).alias(c) for c in stacked_cols])


def _stacked(feeds: dict[str, DataFrame], start: dt.date, end: dt.date,
             users: DataFrame | None = None) -> DataFrame:
    cal = _calendar(users if users is not None else spine.distinct_users(feeds), start, end)
    return (cal.join(_picked(feeds), MONTH_KEYS, "left")
            .join(rollups.agg_engage(feeds["engagement"]), MONTH_KEYS, "left"))


def _grid(feeds: dict[str, DataFrame], start: dt.date, end: dt.date,
          users: DataFrame | None = None, narrow: bool = False, in_order: bool = False) -> DataFrame:
    if users is not None:
        raise ValueError("the grid form takes its users from the feeds")
    if in_order:
        return _grid_of(rollups.side_by_side(_rolled_up(feeds)), start, end, narrow, in_order=True)
    return _beside_empty_months(rollups.side_by_side(_rolled_up(feeds)), _months_of(feeds), start, end, narrow)


def _noted_grid(feeds: dict[str, DataFrame], start: dt.date, end: dt.date,
                users: DataFrame | None = None, narrow: bool = False) -> DataFrame:
    if users is not None or any(_bucketed(df) for df in feeds.values()):
        raise ValueError("the noted form takes its users from the feeds, which are not in buckets")
    spine = start, end
    return _with_empty_months(rollups.side_by_side(_rolled_up(feeds, spine), bits=[*_notes(spine)]), start, end, narrow)


def _width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucketed(df: DataFrame) -> bool:
    """Whether rows are dealt by user, year and month already (``sources.bucketed``)."""
    return {"year", "month"} <= set(df.columns)


def _dealt(df: DataFrame, columns: list[str]) -> DataFrame:
    """A feed's rows, cut to what its roll-up reads, by user and month: sorted once, where partial rows with picks are sorted
    twice, wider than the events, and hardly fewer. Year and month are not dealt but made of the time again. Rows dealt so
    already stay where they are."""
    if _bucketed(df):
        return df.select(*MONTH_KEYS, "event_time", *columns)
    # Texts of many values first, those of few side by side: so they are compressed best.
    rows = df.select(columns[0], "user_id", "event_time", *columns[1:], *[c for c in (NOTE,) if c in df.columns])
    return rollups.dealt_by_month(rows, _width(df))


def _noted(df: DataFrame, columns: list[str], spine: tuple[dt.date, dt.date]) -> DataFrame:
    """A feed's events, each followed by a note of its place in the spine (NOTE; NULL in events). A note has a user and
    nothing else, so by user, year and month all notes of a user are one group, that of the events without a time.

    Events dealt as they are leave a note each, so a user's notes, some bytes each, are in one task; of those dealt as partial rows
    a task has one note a user.
    """
    _, at = _place(*spine, "event_time")
    rows = df.select("user_id", "event_time", *columns, F.explode(F.array(F.lit(None).cast("int"), at)).alias(NOTE))
    return rows.select("user_id", NOTE, *[F.when(F.col(NOTE).isNull(), F.col(c)).alias(c) for c in ("event_time", *columns)])


def _notes(spine: tuple[dt.date, dt.date]) -> dict[str, Column]:
    """A group's notes as a bitmap of the spine's months, in words of 64."""
    n, _ = _place(*spine)
    return {f"_months{k}": F.expr(f"bit_or(CASE WHEN {NOTE} BETWEEN {64 * k} AND {64 * k + 63} THEN shiftleft(1L, {NOTE} % 64) END)") for k in range((n + 63) // 64)}


def _with_empty_months(rows: DataFrame, start: dt.date, end: dt.date, narrow: bool = False) -> DataFrame:
    """Month rows inside the spine, and of each user's notes (the row without a month) the months that are not among them; events
    without a user have none. ``narrow``: the output columns as one, VALUES, and a user's empty months of a year as one row (EMPTY)."""
    n, at = _place(start, end)
    words = ", ".join(_notes((start, end)))
    is_note, no_user = F.col("year").isNull(), F.col("user_id").isNull()
    if narrow:
        years = F.expr(f"filter(array({', '.join(_empty_of_year(y, start, end) for y in range(start.year, end.year + 1))}), y -> y.months <> 0)")
        here = F.array(F.struct("year", F.lit(None).cast("int").alias("months")))
        rows = rows.withColumn("_year", F.explode(F.when(is_note, years).when(~no_user & (at < n), here)))
        return rows.select("user_id", "_year.year", F.when(~is_note, F.col("month")).alias("month"), F.col("_year.months").alias(EMPTY),
                           F.when(~is_note, F.struct(*[c for c, _ in OUTPUT_COLUMNS])).alias(VALUES))
    empty = F.expr(f"filter(sequence(0, {n - 1}), i -> user_id IS NULL OR shiftright(coalesce(get(array({words}), cast(i div 64 AS INT)), 0L), i % 64) & 1L = 0L)")
    made = F.when(is_note, empty).when(~no_user & (at < n), F.array(at))
    rows = rows.withColumn("_month", F.explode(made))
    found = F.element_at(timefns.month_rows(start, end), F.col("_month") + 1)
    keys = "user_id", *[found[c].alias(c) for c in ("year", "month", "month_year")]
    return rows.select(*keys, *[F.when(~is_note, F.col(c)).alias(c) for c, _ in OUTPUT_COLUMNS])


def _empty_of_year(year: int, start: dt.date, end: dt.date) -> str:
    """SQL of a struct (year, months): the bits of the year's months in the spine that are not in the words of a user's notes."""
    n, _ = _place(start, end)
    first = (year - start.year) * 12 - (start.month - 1)  # January's place
    valid = sum(1 << m for m in range(12) if 0 <= first + m < n)
    word = lambda k: f"coalesce(_months{k}, 0L)" if k < (n + 63) // 64 else "0L"
    k, at = divmod(max(first, 0), 64)
    held = f"shiftrightunsigned({word(k)}, {at})" if first >= 0 else f"shiftleft({word(0)}, {-first})"
    if at > 52:  # the year goes on in the next word
        held = f"({held} | shiftleft({word(k + 1)}, {64 - at}))"
    return f"named_struct('year', {year}, 'months', CASE WHEN user_id IS NULL THEN {valid} ELSE cast((~{held}) & {valid}L AS INT) END)"


def _months_of(feeds: dict[str, DataFrame]) -> DataFrame:
    """The user, year and month of all events, each once."""
    parts = [rollups.with_month(df.select("user_id", "event_time", *[c for c in ("year", "month") if c in df.columns])).select(*MONTH_KEYS)
             for df in feeds.values()]
    return reduce(DataFrame.union, parts).distinct()


def _place(start: dt.date, end: dt.date, ts: str | None = None) -> tuple[int, Column]:
    """How many months the spine has, and a row's place in it from 0, or that number if it lies outside; of the row's year and month, or of ``ts``."""
    n = (end.year - start.year) * 12 + end.month - start.month + 1
    year, month = (timefns.year_of(ts), timefns.month_of(ts)) if ts else (F.col("year"), F.col("month"))
    place = (year - start.year) * 12 + month - start.month
    return n, F.when(place.between(0, n - 1), place).otherwise(n)


def _beside_empty_months(rows: DataFrame, months: DataFrame, start: dt.date, end: dt.date, narrow: bool = False) -> DataFrame:
    """Month rows inside the spine, and the empty months of the users in ``months``.

    ``narrow``: the output columns as one, VALUES.
    """
    n, at = _place(start, end)
    names = F.element_at(timefns.month_rows(start, end), F.col("_at") + 1)
    here = rows.withColumn("_at", at).where((F.col("_at") < n) & F.col("user_id").isNotNull())
    here = here.select("user_id", "year", "month", names["month_year"].alias("month_year"), *[c for c, _ in OUTPUT_COLUMNS])
    keys = here.columns[:4]
    empty = _empty_months(months, start, end)
    if narrow:
        keys.remove("month_year")
        here = here.select(*keys, F.struct(*[c for c, _ in OUTPUT_COLUMNS]).alias(VALUES))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in here.schema.fields[len(keys):]]
    return here.union(empty.select(*keys, *nothing))


def _empty_months(months: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """user_id, year, month, month_year of the spine's months that are not among a user's; events without a user have none.

    The months of a user, each once and nothing beside them, are put in order, and each emits the empty ones up to the next;
    those outside the spine sort last. A window over a user is bounded by the spine, however many events the user has. They
    are dealt to an explicit number of tasks, as small as they are next to what they emit (see ``spine.calendar``).
    """
    n, at = _place(start, end)
    rows = months.select("user_id", at.alias("_at")).distinct().repartition(_width(months), "user_id")
    by_month = Window.partitionBy("user_id").orderBy("_at")
    rows = rows.withColumns({"_first": F.lag("_at").over(by_month).isNull(), "_to": F.coalesce(F.lead("_at").over(by_month), F.lit(n))})
    rows = rows.withColumn("_from", F.when(F.col("_first"), 0).otherwise(F.col("_at"))).where("_from < _to")
    rows = rows.withColumn("_month", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)))
    rows = rows.where((F.col("_month") != F.col("_at")) | F.col("user_id").isNull())
    found = F.element_at(timefns.month_rows(start, end), F.col("_month") + 1)
    return rows.select("user_id", *[found[c].alias(c) for c in ("year", "month", "month_year")])


def _grid_of(rows: DataFrame, start: dt.date, end: dt.date, narrow: bool = False, in_order: bool = False) -> DataFrame:
    """Month rows of a user, in order, each followed by the empty months up to the next.

    ``narrow``: the output columns as one, VALUES. ``in_order``: rows come in the order of SORT_KEYS, partition by
    partition; dealt by ranges of users are the month rows, not the grid.

    A user has at most one row a month here, so a window over a user is bounded
    by the months of the data, however many events the user has. Months outside
    the spine sort last and emit nothing, unless the user has no other: then the
    first of them emits the whole empty grid. Events without a user make a grid
    of empty months, as the model's joins on user_id do.
    """
    months = timefns.month_rows(start, end)
    n, at = _place(start, end)
    rows = rows.withColumn("_at", at)
    if in_order:
        rows = rows.repartitionByRange("user_id")
    by_month = Window.partitionBy("user_id").orderBy("_at")
    rows = rows.withColumns({"_from": F.lag("_at").over(by_month), "_to": F.lead("_at").over(by_month)})
    rows = rows.withColumns({"_from": F.when(F.col("_from").isNull(), 0).otherwise(F.col("_at")), "_to": F.coalesce("_to", F.lit(n))})
    rows = rows.where("_from < _to").withColumn("_month", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)))
    here = (F.col("_month") == F.col("_at")) & F.col("user_id").isNotNull()
    at = F.element_at(months, F.col("_month") + 1)
    keys = "user_id", at["year"].alias("year"), at["month"].alias("month"), at["month_year"].alias("month_year")
    if narrow:
        return rows.select(*keys[:3], F.when(here, F.struct(*[c for c, _ in OUTPUT_COLUMNS])).alias(VALUES))
    return rows.select(*keys, *[F.when(here, F.col(c)).alias(c) for c, _ in OUTPUT_COLUMNS])


def customer_summary(
    feeds: dict[str, DataFrame],
    spine_start: dt.date = timefns.DEFAULT_SPINE_START,
    spine_end: dt.date = timefns.DEFAULT_SPINE_END,
    form: str = "grid",
    sort: bool = False,
    users: DataFrame | None = None,
) -> DataFrame:
    """Build the model from the four feeds.

    ``form`` picks the plan shape ("grid", the default, "noted", "star" or "stacked"); all
    return the same rows.
    ``users`` overrides the user list (default: every user of the feeds; not in
    the grid and noted forms); month-range restatement passes the full list with range-cut
    feeds.
    ``sort=True`` gives rows in the model's global ORDER BY, partition by partition (in
    the grid form a range shuffle of the month rows by user, each of which then makes its
    months in order; in the others one of the whole grid); tables keep no order, so
    writers use ``plans.materialize`` instead, which clusters and sorts within files.
    """
    if sort and form == "grid":
        return filled(_grid(feeds, spine_start, spine_end, users, narrow=True, in_order=True))
    out = _fill(BUILDERS[form](feeds, spine_start, spine_end, users))
    return out.orderBy(*SORT_KEYS) if sort else out


BUILDERS = {"grid": _grid, "noted": _noted_grid, "star": _star, "stacked": _stacked}


def unfilled_summary(feeds: dict[str, DataFrame], spine_start: dt.date, spine_end: dt.date, form: str = "noted",
                     users: DataFrame | None = None) -> DataFrame:
    """The model's rows as writers deal and sort them, before the fills; ``filled`` makes the model of them."""
    narrow = {"narrow": True} if form in ("grid", "noted") else {}
    return BUILDERS[form](feeds, spine_start, spine_end, users, **narrow)


def unfilled_of_rollups(monthly: DataFrame, spine_start: dt.date, spine_end: dt.date) -> DataFrame:
    """The same from month rows that hold all feeds' roll-up columns, one a user and month (NULL where a feed has none)."""
    return _grid_of(monthly, spine_start, spine_end, narrow=True)


def summary_of_rollups(monthly: DataFrame, spine_start: dt.date, spine_end: dt.date) -> DataFrame:
    """The model from such month rows."""
    return filled(unfilled_of_rollups(monthly, spine_start, spine_end))


def customer_month_slice(
    subscription: DataFrame,
    spine_start: dt.date = timefns.DEFAULT_SPINE_START,
    spine_end: dt.date = timefns.DEFAULT_SPINE_END,
) -> DataFrame:
    """Minimum slice: one feed -> users -> spine -> monthly roll-up -> left join -> fills."""
    cal = _calendar(subscription.select("user_id").distinct(), spine_start, spine_end)
    agg = rollups.agg_sub(_dealt(subscription, _read_by_rollup("subscription")))
    joined = cal.join(agg, MONTH_KEYS, "left")
    types = dict(joined.dtypes)
    fills = [(c, v) for c, v in OUTPUT_COLUMNS if c in rollups.SUB_COLUMNS]
    return joined.select(
        "user_id", "year", "month", "month_year",
        *[F.coalesce(F.col(c), F.lit(v).cast(types[c])).alias(c) for c, v in fills],
    )

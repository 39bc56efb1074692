"""Model 1 against a brute-force evaluation on random small feeds.

Event times and event ids are drawn from tiny sets, so ties in the ANY_VALUE
ordering are frequent; the picked values must still come from one row, the
least (event_time, id, values...) one, in both plan shapes.
"""

import datetime as dt
from decimal import Decimal

from fixtures import REV_A, SUB_A, feeds, with_
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.plans.customer_summary import customer_summary

USERS = ["u1", "u2", "u3"]
TIMES = ["2024-01-05T00:00:00", "2024-01-05T00:00:00", "2024-01-20T10:00:00",
         "2024-02-01T00:00:00", "2024-03-31T23:59:59", "2023-12-31T00:00:00"]
START, END = dt.date(2024, 1, 1), dt.date(2024, 3, 1)

sub_rows = st.lists(st.tuples(st.sampled_from(USERS), st.sampled_from(TIMES), st.sampled_from(["a", "b"]),
                              st.sampled_from(["basic", "pro", "enterprise"]),
                              st.sampled_from(["EU", "NA"]), st.integers(0, 500)), max_size=12)
rev_rows = st.lists(st.tuples(st.sampled_from(USERS), st.sampled_from(TIMES), st.sampled_from(["x", "y"]),
                              st.sampled_from(["on_track", "delayed", "completed"]),
                              st.integers(1, 900), st.integers(1, 100)), max_size=12)


def _month(t):
    d = dt.datetime.fromisoformat(t)
    return d.year, d.month


def _brute(subs, revs):
    users = {r[0] for r in subs} | {r[0] for r in revs}
    months = [(2024, 1), (2024, 2), (2024, 3)]
    out = {}
    for u in users:
        for ym in months:
            s = [r for r in subs if r[0] == u and _month(r[1]) == ym]
            v = [r for r in revs if r[0] == u and _month(r[1]) == ym]
            row = {}
            if s:
                pick = min((dt.datetime.fromisoformat(r[1]), r[2], r[3], r[4]) for r in s)
                row["subscription_plan"], row["region"] = pick[2], pick[3]
                row["total_annualized_revenue"] = sum(Decimal(r[5]) for r in s)
            else:
                row["subscription_plan"], row["region"] = "N/A", "N/A"
                row["total_annualized_revenue"] = Decimal(0)
            if v:
                row["repayment_status"] = min((dt.datetime.fromisoformat(r[1]), r[2], r[3]) for r in v)[2]
                row["total_payment_amount"] = sum(Decimal(r[4]) for r in v)
                row["avg_revenue_stability_score"] = float(sum(r[5] for r in v)) / len(v)
            else:
                row["repayment_status"] = "N/A"
                row["total_payment_amount"] = Decimal(0)
                row["avg_revenue_stability_score"] = 0.0
            out[(u, *ym)] = row
    return out


@settings(max_examples=12, deadline=None)
@given(sub_rows, rev_rows)
def test_model1_matches_brute_force(spark, subs, revs):
    f = feeds(
        spark,
        [with_(SUB_A, user_id=u, event_time=t, subscription_id=pk, subscription_plan=p, region=g,
               annualized_revenue=a) for u, t, pk, p, g, a in subs],
        [with_(REV_A, user_id=u, event_time=t, revenue_id=pk, repayment_status=st_,
               payment_amount=amt, revenue_stability_score=sc) for u, t, pk, st_, amt, sc in revs],
    )
    want = _brute(subs, revs)
    cols = ["subscription_plan", "region", "total_annualized_revenue", "repayment_status",
            "total_payment_amount", "avg_revenue_stability_score"]
    for form in ("stacked", "star"):
        got = {(r.user_id, r.year, r.month): {c: r[c] for c in cols}
               for r in customer_summary(f, START, END, form=form).collect()}
        assert got == want, form

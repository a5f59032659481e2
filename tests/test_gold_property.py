"""Gold layer vs a brute-force evaluation of the original definitions."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from propensia.operators import layers as L

GROUPS = ["grocery_retail", "food_beverage", "transport_travel", "financial_services", "other"]
SCHEMA = ("customer_token string, transaction_date date, amount_usd double, channel_clean string, "
          "is_cross_border boolean, age int, tenure_months int, merchant_category_group string")


def brute(rows):
    """Per (token, date): rows-frame sums over active days, calendar diversity."""
    by_day = {}
    for tok, d, usd, ch, xb, age, ten, grp in rows:
        by_day.setdefault((tok, d), []).append((usd, ch, xb, age, ten, grp))
    out = {}
    for tok in {k[0] for k in by_day}:
        days = sorted(d for t, d in by_day if t == tok)
        daily = []
        for d in days:
            txs = by_day[(tok, d)]
            usd = [t[0] for t in txs if t[0] is not None]
            daily.append((d, len(txs), sum(usd) if usd else None, sum(t[1] == "digital" for t in txs), sum(bool(t[2]) for t in txs)))
        for i, (d, *_rest) in enumerate(daily):
            def frame(n):
                return daily[max(0, i - n + 1): i + 1]
            vol30 = [x[2] for x in frame(30) if x[2] is not None]
            cnt30 = sum(x[1] for x in frame(30))
            groups = {t[5] for dd in days if d - dt.timedelta(days=29) <= dd <= d for t in by_day[(tok, dd)]}
            out[(tok, d)] = (
                sum(x[1] for x in frame(7)), cnt30, sum(x[1] for x in frame(90)),
                (sum(vol30) / cnt30) if vol30 else None,
                sum(x[3] for x in frame(30)) / cnt30, sum(x[4] for x in frame(90)), len(groups),
            )
    return out


row = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]),  # one token holds about half of all rows
    st.integers(0, 120),
    st.one_of(st.none(), st.floats(0.01, 1000, allow_nan=False)),
    st.sampled_from(["digital", "branch", "atm"]),
    st.booleans(),
    st.sampled_from(GROUPS),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=120))
def test_gold_matches_definitions(spark, rows):
    base = dt.date(2024, 1, 1)
    data = [(t, base + dt.timedelta(days=d), u, ch, xb, 30, 12, g) for t, d, u, ch, xb, g in rows]
    got = {(r.customer_token, r.feature_date): r for r in L.gold(L.daily_customer(spark.createDataFrame(data, SCHEMA))).collect()}
    want = brute(data)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert (g.txn_count_7d, g.txn_count_30d, g.txn_count_90d) == w[:3]
        assert (g.avg_txn_size_30d is None) == (w[3] is None)
        if w[3] is not None:
            assert math.isclose(g.avg_txn_size_30d, w[3], rel_tol=1e-9)
        assert math.isclose(g.digital_ratio_30d, w[4], rel_tol=1e-12)
        assert g.cross_border_count_90d == w[5] and g.merchant_diversity_30d == w[6] and g.recency_days == 0

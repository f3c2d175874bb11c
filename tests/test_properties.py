"""Property tests (hypothesis): operators against brute force on random small inputs."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from roadlake.operators import aggregates as G


def _p85(vals):
    v = sorted(vals)
    return v[max(1, math.ceil(0.85 * len(v))) - 1]


groups = st.dictionaries(st.sampled_from(list("abcdef")),
                         st.lists(st.integers(min_value=1, max_value=99), min_size=1, max_size=40),
                         min_size=1, max_size=6)


@settings(max_examples=8, deadline=None)
@given(groups)
def test_free_flow_exact_property(spark, data):
    import datetime as dt
    rows = [(k, float(v), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "b", "n")
            for k, vals in data.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "link_id string, speed double, data_as_of timestamp_ntz, "
                                     "borough string, link_name string")
    got = {r.link_id: r.free_flow_speed for r in G.free_flow_lookup(df).collect()}
    assert got == {k: float(_p85(v)) for k, v in data.items()}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=300),
       st.sampled_from([10, 1000]))
def test_exact_quartiles_property(spark, vals, acc):
    import numpy as np
    df = spark.createDataFrame([(float(v),) for v in vals], "c double")
    d = G.describe_column(df, "c", digits=9, accuracy=acc).head()
    got = [d.p25, d.p50, d.p75]
    exp = [float(np.quantile(np.array(vals, dtype=float), q)) for q in (0.25, 0.5, 0.75)]
    assert all(abs(a - b) < 1e-8 for a, b in zip(got, exp))

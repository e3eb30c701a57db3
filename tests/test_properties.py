"""Property tests against brute force (few examples each: every example is a
Spark job)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewlake.operators.joins import range_join
from reviewlake.operators.ordering import global_row_number

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

ranges_st = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60), st.integers(0, 25)),
                     min_size=1, max_size=8)
points_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 90)), min_size=1, max_size=40)


@SETTINGS
@given(ranges=ranges_st, points=points_st, width=st.integers(1, 30))
def test_range_join_equals_brute_force(spark, ranges, points, width):
    r = [(k, lo, lo + ln) for k, lo, ln in ranges]
    want = sorted((k, p, lo, hi) for k, p in points for k2, lo, hi in r if k == k2 and lo <= p <= hi)
    pdf = spark.createDataFrame(points, "k string, p long")
    rdf = spark.createDataFrame(r, "k string, lo long, hi long")
    got = sorted(tuple(x) for x in range_join(pdf, rdf, "k", "p", "lo", "hi", width).select("k", "p", "lo", "hi").collect())
    assert got == want


@SETTINGS
@given(keys=st.lists(st.tuples(st.text(alphabet="abc", max_size=3), st.integers(0, 5)), min_size=1, max_size=60,
                     unique=True),
       parts=st.integers(1, 6))
def test_global_row_number_equals_sort(spark, keys, parts):
    df = spark.createDataFrame(keys, "k string, v long").repartition(3)
    got = sorted((r.k, r.v, r.n) for r in global_row_number(df, ["k", "v"], "n", num_partitions=parts).collect())
    want = sorted((k, v, i) for i, (k, v) in enumerate(sorted(keys)))
    assert got == want

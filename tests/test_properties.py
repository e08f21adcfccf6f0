"""Randomised invariants, checked against plain-Python brute force.

Few examples each (every example runs Spark jobs), no deadline.
"""

import datetime as dt

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata.operators import checks
from strata.operators.dedup import latest_per_key
from strata.operators.effective_join import resolve
from strata.operators.scd import empty_scd2, scd2

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)

times = st.one_of(st.none(), st.integers(0, 5).map(lambda h: BASE + dt.timedelta(hours=h)))
rows = st.lists(st.tuples(st.integers(0, 4), times, st.integers(0, 2), st.sampled_from(["a", "b", None])),
                min_size=1, max_size=25)


def _desc_nulls_last(v):
    return (0,) if v is None else (1, v)


@settings(**SETTINGS)
@given(rows, st.integers(1, 5))
def test_latest_per_key_matches_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, "k int, t timestamp, d int, v string").repartition(parts)
    got = {r.k: tuple(r) for r in latest_per_key(df, ["k"], ["t", "d"]).collect()}
    want = {}
    for r in data:
        rank = tuple(_desc_nulls_last(x) for x in (r[1], r[2], r[3]))
        if r[0] not in want or rank > want[r[0]][0]:
            want[r[0]] = (rank, r)
    assert got == {k: v[1] for k, v in want.items()}


snapshot = st.dictionaries(st.integers(0, 3), st.tuples(st.sampled_from(["x", "y"]), st.booleans()), max_size=4)


@settings(**SETTINGS)
@given(st.lists(snapshot, min_size=1, max_size=4))
def test_scd2_fold_matches_brute_force(spark, loads):
    """Each load: key -> (attribute, has change time).  Versions, intervals and
    the active flag follow the textbook SCD2 rule."""
    ts = TimestampType()
    schema = "k int, a string, m timestamp"
    dim = None
    expected: dict[int, list] = {}
    for i, snap in enumerate(loads):
        load_ts = BASE + dt.timedelta(days=i + 1)
        batch = [(k, a, BASE + dt.timedelta(days=i, hours=k) if has_t else None)
                 for k, (a, has_t) in sorted(snap.items())]
        inc = spark.createDataFrame(batch, schema)
        if dim is None:
            dim = empty_scd2(inc, ["k"], ["a"], "sk", ts)
        dim = scd2(dim, inc, ["k"], ["a"], "m", "sk", load_ts.isoformat(sep=" "), ts_type=ts).checkpoint()
        for k, a, m in batch:
            hist = expected.setdefault(k, [])
            if not hist or hist[-1][0] != a:
                start = m or load_ts
                if hist:
                    hist[-1][2] = start
                hist.append([a, start, None])
    got = {}
    for r in dim.collect():
        got.setdefault(r.k, []).append((r.record_version, r.a, r.start_effective_date, r.end_effective_date,
                                        r.is_active))
    want = {k: [(i + 1, a, s, e, e is None and i == len(h) - 1) for i, (a, s, e) in enumerate(h)]
            for k, h in expected.items()}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert checks.active_unique(dim, ["k"]).first().ok
    sks = [r.sk for r in dim.collect()]
    assert sorted(sks) == list(range(1, len(sks) + 1))


versions = st.lists(st.integers(1, 4), min_size=1, max_size=4)  # gaps between version starts (days)
events = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 12)), min_size=1, max_size=30)


@settings(**SETTINGS)
@given(st.lists(versions, min_size=1, max_size=3), events, st.sampled_from(["broadcast", "salted", "shuffle"]))
def test_resolve_keeps_every_fact_and_picks_the_covering_version(spark, per_key, evs, strategy):
    dim_rows, sk = [], 0
    for k, gaps in enumerate(per_key):
        start = BASE
        starts = []
        for g in gaps:
            start = start + dt.timedelta(days=g, hours=9)
            starts.append(start)
        for i, s in enumerate(starts):
            sk += 1
            dim_rows.append((sk, k, s, starts[i + 1] if i + 1 < len(starts) else None))
    dim = spark.createDataFrame(dim_rows, "sk long, k int, s timestamp, e timestamp")
    facts = spark.createDataFrame([(i, k, (BASE + dt.timedelta(days=d)).date()) for i, (k, d) in enumerate(evs)],
                                  "id int, k int, d date")
    out = resolve(facts, dim, "k", "d", sk="sk", start="s", end="e", strategy=strategy,
                  hot_factor=1, partitions=100, salt_buckets=3)
    got = {r.id: r.sk for r in out.collect()}
    assert sorted(got) == list(range(len(evs)))            # rows in = rows out
    for i, (k, d) in enumerate(evs):
        day = BASE + dt.timedelta(days=d)
        cover = [r[0] for r in dim_rows if r[1] == k and r[2] <= day and (r[3] is None or day < r[3])]
        assert got[i] == (cover[0] if cover else None)


@settings(**SETTINGS)
@given(rows)
def test_silver_does_not_depend_on_delivery_order(spark, data):
    df = spark.createDataFrame(data, "k int, t timestamp, d int, v string")
    a = sorted(latest_per_key(df, ["k"], ["t", "d"]).collect())
    b = sorted(latest_per_key(df.orderBy(F.rand(7)).repartition(3), ["k"], ["t", "d"]).collect())
    assert a == b

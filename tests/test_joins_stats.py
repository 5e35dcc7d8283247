import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from sideline.operators.joins import (last_name_semi, lookup, pre_incident, pre_incident_counts,
                                      restrict_to, semi)
from sideline.operators.stats import (as_percent, by_month, compare_profiles, dedup_first, freq,
                                      share, with_delta)

D = dt.date


def acts(spark, rows):
    return spark.createDataFrame(rows, "pid string, eid int, a_day date, label string")


def incs(spark, rows):
    return spark.createDataFrame(rows, "pid string, iid int, i_day date")


def test_window_edges(spark):
    a = acts(spark, [("p", 1, D(2018, 12, 2), "x"), ("p", 2, D(2018, 12, 3), "x"),
                     ("p", 3, D(2018, 12, 9), "x"), ("p", 4, D(2018, 12, 10), "x")])
    i = incs(spark, [("p", 1, D(2018, 12, 10))])
    got = pre_incident(a, i, "pid", "a_day", "i_day", 7)
    assert sorted(r.eid for r in got.collect()) == [2, 3]
    r = got.filter("eid = 2").first()
    assert (r.window_start, r.window_end) == (D(2018, 12, 3), D(2018, 12, 9))


def test_double_count(spark):
    a = acts(spark, [("p", 1, D(2018, 12, 8), "x")])
    i = incs(spark, [("p", 1, D(2018, 12, 9)), ("p", 2, D(2018, 12, 10)), ("q", 3, D(2018, 12, 10))])
    assert pre_incident(a, i, "pid", "a_day", "i_day", 7).count() == 2
    assert pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", 7).first().n == 2


day = st.integers(0, 40).map(lambda k: D(2024, 1, 1) + dt.timedelta(days=k))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("pqr"), day, st.sampled_from("xyz")), max_size=40),
       st.lists(st.tuples(st.sampled_from("pqrs"), day), max_size=12),
       st.integers(1, 10))
def test_interval_join_equals_brute_force(spark, arows, irows, days):
    a = acts(spark, [(p, k, d, l) for k, (p, d, l) in enumerate(arows)])
    i = incs(spark, [(p, k, d) for k, (p, d) in enumerate(irows)])
    got = sorted((r.eid, r.iid) for r in pre_incident(a, i, "pid", "a_day", "i_day", days).collect())
    want = sorted((ka, ki) for ka, (pa, da, _) in enumerate(arows) for ki, (pi, di) in enumerate(irows)
                  if pa == pi and di - dt.timedelta(days=days) <= da < di)
    assert got == want
    counts = {r.label: r.n for r in pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", days).collect()}
    want_counts = {}
    for ka, ki in want:
        lab = arows[ka][2]
        want_counts[lab] = want_counts.get(lab, 0) + 1
    assert counts == want_counts


def test_interval_join_plan_is_equi_join(spark):
    a = acts(spark, [("p", 1, D(2018, 12, 8), "x")])
    i = incs(spark, [("p", 1, D(2018, 12, 9))])
    plan = pre_incident(a, i, "pid", "a_day", "i_day", 7)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_hot_key_is_spread_over_days(spark):
    # one person holds most activity; the join key is (person, day), so no single task gets them all
    rows = [("hot", k, D(2024, 1, 1) + dt.timedelta(days=k % 30), "x") for k in range(3000)]
    rows += [("cold", 10000 + k, D(2024, 1, 5), "y") for k in range(30)]
    a = acts(spark, rows)
    i = incs(spark, [("hot", 1, D(2024, 1, 20)), ("hot", 2, D(2024, 1, 25)), ("cold", 3, D(2024, 1, 6))])
    n = pre_incident(a, i, "pid", "a_day", "i_day", 7).count()
    want = sum(1 for p, _, d, _ in rows for (q, _, di) in [("hot", 1, D(2024, 1, 20)), ("hot", 2, D(2024, 1, 25)),
                                                       ("cold", 3, D(2024, 1, 6))]
               if p == q and di - dt.timedelta(days=7) <= d < di)
    assert n == want


def test_semi_restrict_lookup(spark):
    ev = spark.createDataFrame([("A. X", 1), ("B. Y", 2), (None, 3)], "name string, g int")
    keys = spark.createDataFrame([("A. X",), ("A. X",), (None,)], "k string")
    assert [r.g for r in semi(ev, keys, "name", "k").collect()] == [1]
    r = restrict_to(ev, "name", keys, "k", keep_as="fmt").collect()
    assert [(x.g, x.fmt) for x in r] == [(1, "A. X")]
    games = spark.createDataFrame([(1, D(2018, 1, 2)), (1, D(2018, 1, 1)), (2, None)], "g int, d date")
    assert lookup(ev, games, "g", dedup=True).count() == 3
    assert lookup(ev, games, "g", dedup=False).count() == 4
    assert lookup(ev, games, "g", dedup=True).filter("g = 1").first().d == D(2018, 1, 1)


def test_last_name_semi(spark):
    ev = spark.createDataFrame([("James", 1), ("Jr.", 2), ("Curry", 3), ("", 4)], "playerName string, k int")
    ppl = spark.createDataFrame([("LeBron James",), ("Tim Hardaway Jr.",), (None,), ("",)], "Player_Name string")
    got = sorted(r.k for r in last_name_semi(ev, "playerName", ppl, "Player_Name").collect())
    assert got == [1, 2]


def test_freq_and_share(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    assert [tuple(r) for r in freq(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert sorted(tuple(r) for r in freq(df, "c", dropna=False).collect() if r[0]) == [("a", 2), ("b", 1)]
    assert freq(df, "c", dropna=False).filter("c is null").first().n == 1
    s = share(df, "c").collect()
    assert abs(sum(r.share for r in s) - 1.0) < 1e-12
    empty = spark.createDataFrame([], "c string")
    assert freq(empty, "c").count() == 0 and share(empty, "c").count() == 0


def test_percent_half_even(spark):
    df = spark.createDataFrame([(0.00125,), (0.00135,), (0.5,)], "s double")
    assert [r[0] for r in df.select(as_percent("s")).collect()] == [0.12, 0.14, 50.0]


def test_compare_profiles_align(spark):
    a = spark.createDataFrame([("x", .5), ("y", .5)], "k string, share double")
    b = spark.createDataFrame([("x", .9), ("z", .1)], "k string, share double")
    cmp = with_delta(compare_profiles(a, b, "k", "share", "A", "B"), "B", "A", "k")
    got = {r.k: (r.A, r.B) for r in cmp.collect()}
    assert got == {"x": (.5, .9), "y": (.5, 0.0), "z": (0.0, .1)}
    assert [r.k for r in cmp.collect()][0] == "x"


def test_dedup_first(spark):
    df = spark.createDataFrame([("A", D(2018, 1, 1), "y"), ("A", D(2018, 1, 1), "x"),
                                ("A", None, "y"), ("A", None, "x")], "p string, d date, t string")
    got = {(r.p, r.d, r.t) for r in dedup_first(df, ["p", "d"], ["t"]).collect()}
    assert got == {("A", D(2018, 1, 1), "x"), ("A", None, "x")}


def test_dedup_first_is_partially_aggregated(spark):
    df = spark.createDataFrame([("A", 1, "x")], "p string, d int, t string")
    plan = dedup_first(df, ["p"], ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_by_month(spark):
    df = spark.createDataFrame([(D(2018, 1, 5),), (D(2018, 1, 31),), (D(2018, 3, 1),), (None,)], "d date")
    assert [tuple(r) for r in by_month(df, "d").collect()] == [(D(2018, 1, 1), 2), (D(2018, 3, 1), 1)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("pq"), day, st.sampled_from(["x", "y", "it's"])), max_size=40),
       st.lists(st.tuples(st.sampled_from("pqr"), day), max_size=10))
def test_counts_with_known_labels_equal_generic(spark, arows, irows):
    a = acts(spark, [(p, k, d, l) for k, (p, d, l) in enumerate(arows)])
    i = incs(spark, [(p, k, d) for k, (p, d) in enumerate(irows)])
    generic = {r.label: r.n for r in pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", 7).collect()}
    known = {r.label: r.n for r in pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", 7,
                                                        labels=["x", "y", "it's", "z"]).collect()}
    assert generic == known


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("pq"), day, st.sampled_from("xy")), max_size=40),
       st.lists(st.tuples(st.sampled_from("pqr"), day), max_size=10),
       st.integers(1, 30), st.integers(2, 9))
def test_bucketed_interval_join_equals_daily(spark, arows, irows, days, width):
    a = acts(spark, [(p, k, d, l) for k, (p, d, l) in enumerate(arows)])
    i = incs(spark, [(p, k, d) for k, (p, d) in enumerate(irows)])
    daily = pre_incident(a, i, "pid", "a_day", "i_day", days)
    bucketed = pre_incident(a, i, "pid", "a_day", "i_day", days, bucket_days=width)
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, bucketed.collect()))


def test_semi_dedups_key_side_before_shuffle(spark):
    ev = spark.createDataFrame([("a", 1)], "name string, g int")
    keys = spark.createDataFrame([("a",)] * 5, "k string")
    plan = semi(ev, keys, "name", "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan


def test_bucketed_interval_join_plan_is_equi_join(spark):
    a = acts(spark, [("p", 1, D(2018, 12, 8), "x")])
    i = incs(spark, [("p", 1, D(2018, 12, 9))])
    plan = pre_incident(a, i, "pid", "a_day", "i_day", 90, bucket_days=7)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_key_partition_is_split_by_aqe(spark):
    """A third of all activity on one person and one day: AQE splits the hot join partition."""
    rows = [("hot", k, D(2024, 1, 10), "x") for k in range(20000)]
    rows += [(f"u{k % 200}", 100000 + k, D(2024, 1, 1) + dt.timedelta(days=k % 20), "y") for k in range(40000)]
    a = acts(spark, rows)
    i = incs(spark, [("hot", 1, D(2024, 1, 12))] + [(f"u{k}", 10 + k, D(2024, 1, 15)) for k in range(200)])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = pre_incident(a, i, "pid", "a_day", "i_day", 7)
        n = len(out.collect())  # runs this plan itself, so the final adaptive plan is inspectable
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = sum(1 for p, _, d, _ in rows if p == "hot") + \
        sum(1 for p, _, d, _ in rows if p != "hot" and D(2024, 1, 8) <= d < D(2024, 1, 15))
    assert n == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]),
                          st.sampled_from(["x", "y", "z", None])), max_size=30))
def test_dedup_first_property(spark, rows):
    df = spark.createDataFrame(rows, "k string, d int, t string")
    out = [tuple(r) for r in dedup_first(df, ["k", "d"], ["t"]).collect()]
    keys = [(k, d) for k, d, _ in out]
    assert len(keys) == len(set(keys)) == len({(k, d) for k, d, _ in rows})
    for k, d, t in out:
        group = [r[2] for r in rows if (r[0], r[1]) == (k, d)]
        # first by t ascending with NULL first
        want = None if None in group else min(group)
        assert t == want


def test_top_k_ties_break_by_label(spark):
    df = spark.createDataFrame([(c,) for c in "ccbbaad"], "c string")
    assert [tuple(r) for r in freq(df, "c", limit=2).collect()] == [("a", 2), ("b", 2)]


def test_dedup_first_single_fixed_width_value(spark):
    df = spark.createDataFrame([(1, D(2018, 1, 2)), (1, D(2018, 1, 1)), (2, None), (2, D(2018, 1, 5)), (3, D(2018, 2, 2))],
                               "g int, d date")
    out = dedup_first(df, ["g"])
    assert {(r.g, r.d) for r in out.collect()} == {(1, D(2018, 1, 1)), (2, None), (3, D(2018, 2, 2))}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_closed_label_shares_equal_share(spark):
    from sideline.operators.stats import closed_label_shares
    df = spark.createDataFrame([(c,) for c in "aabbbcx"], "c string")
    got = {r.c: (r.n, r.share) for r in closed_label_shares(df, "c", ["a", "b", "c", "x", "unused"]).collect()}
    want = {r.c: (r.n, r.share) for r in share(df, "c").collect()}
    assert got == want
    empty = spark.createDataFrame([], "c string")
    assert closed_label_shares(empty, "c", ["a"]).count() == 0


ROW = st.tuples(st.sampled_from(["p", "q", "r", None]), st.one_of(st.none(), st.integers(0, 60)))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(ROW, st.sampled_from(["x", "y", None])), max_size=25), st.lists(ROW, max_size=12), st.sampled_from([1, 5, 15, 40]))
def test_windows_from_their_edges_equal_days_written_out(spark, activity, incidents, days):
    from sideline.operators import joins as J
    day = lambda n: None if n is None else dt.date(2018, 1, 1) + dt.timedelta(n)
    a = spark.createDataFrame([(p, day(n), lab) for (p, n), lab in activity], "pid string, a_day date, label string")
    i = spark.createDataFrame([(p, day(n)) for p, n in incidents], "pid string, i_day date")
    found = {}
    short = J.LONG_WINDOW
    for form, limit in (("edges", 0), ("days", 1000)):
        J.LONG_WINDOW = limit
        try:
            found[form] = (sorted((r.label, r.n) for r in pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", days).collect()),
                           sorted((r.label, r.n) for r in pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", days, labels=["x", "y"]).collect()),
                           sorted(tuple(r) for r in J.overall_and_window_counts(a, i, "pid", "a_day", "i_day", "label", days)
                                  .na.drop().select("pid", "_day", "label", "_n", "_m").collect()))
        finally:
            J.LONG_WINDOW = short
    assert found["edges"] == found["days"]


def test_long_windows_do_not_write_out_days(spark):
    a = spark.createDataFrame([("p", dt.date(2018, 1, 1), "x")], "pid string, a_day date, label string")
    i = spark.createDataFrame([("p", dt.date(2018, 6, 1))], "pid string, i_day date")
    plans = {}
    for days in (7, 90, 365):
        df = pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", days)
        plans[days] = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" in plans[7] and "sequence(" not in plans[90]
    assert pre_incident_counts(a, i, "pid", "a_day", "i_day", "label", 365).first().n == 1

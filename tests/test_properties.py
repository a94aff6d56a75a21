"""Property tests (hypothesis) against brute-force Python statements."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators.merge import merge_metrics, merge_metrics_chain
from daybook.operators.reload import reload_window
from daybook.operators.snapshot import latest_snapshot, newest_sums

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

feed_rows = st.lists(st.tuples(st.integers(1, 3), st.integers(20000101, 20000103), st.sampled_from("ab"),
                               st.one_of(st.none(), st.integers(-5, 9).map(float)),
                               st.one_of(st.none(), st.integers(1, 3))), min_size=0, max_size=40)
FEED = "CENTER int, PERIOD int, ACCOUNT string, DATA_VALUE double, EXTRACT_DATE_ID int"


def brute_newest(rows, key):
    groups = defaultdict(list)
    for r in rows:
        if None in (r[0], r[1], r[2], r[4]):
            continue
        groups[key(r)].append(r)
    out = {}
    for k, rs in groups.items():
        top = max(r[4] for r in rs)
        vals = [r[3] for r in rs if r[4] == top and r[3] is not None]
        out[k] = sum(vals) if vals else None
    return out


@SETTINGS
@given(feed_rows)
def test_newest_sums_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, FEED)
    got = {(r.CENTER, r.PERIOD, r.ACCOUNT): r.DATA_VALUE
           for r in newest_sums(df, ["CENTER", "PERIOD", "ACCOUNT"], {"DATA_VALUE": None}).collect()}
    assert got == brute_newest(rows, lambda r: (r[0], r[1], r[2]))


@SETTINGS
@given(feed_rows)
def test_latest_snapshot_keeps_exactly_newest_rows(spark, rows):
    df = spark.createDataFrame(rows, FEED)
    def order(t):
        return tuple((x is None, x if x is not None else 0) for x in t)
    got = sorted((tuple(r) for r in latest_snapshot(df, ["CENTER", "PERIOD"]).collect()), key=order)
    tops = {}
    for r in rows:
        if None not in (r[0], r[1], r[4]):
            tops[(r[0], r[1])] = max(tops.get((r[0], r[1]), r[4]), r[4])
    keep = [r for r in rows if None not in (r[0], r[1], r[4]) and r[4] == tops[(r[0], r[1])]]
    assert got == sorted(keep, key=order)


metric_frames = st.lists(st.dictionaries(st.tuples(st.integers(1, 3), st.integers(1, 3)),
                                         st.one_of(st.none(), st.integers(0, 9).map(float)), max_size=6),
                         min_size=1, max_size=4)


@SETTINGS
@given(metric_frames)
def test_union_merge_equals_full_outer_chain(spark, frames):
    dfs = [spark.createDataFrame([(c, p, v) for (c, p), v in fr.items()], f"CENTER int, PERIOD int, V{i} double")
           for i, fr in enumerate(frames)]
    cols = ["CENTER", "PERIOD"] + [f"V{i}" for i in range(len(frames))]
    a = sorted(tuple(r) for r in merge_metrics(dfs).select(*cols).collect())
    b = sorted(tuple(r) for r in merge_metrics_chain(dfs).select(*cols).collect())
    assert a == b


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(1, 9), st.integers(0, 9).map(float)), max_size=15),
       st.lists(st.tuples(st.integers(1, 2), st.integers(4, 6), st.integers(0, 9).map(float)), max_size=8),
       st.integers(1, 9))
def test_reload_is_idempotent_and_bounded(spark, hist, fresh, exp):
    schema = "CENTER int, PERIOD int, M double"
    h, f = spark.createDataFrame(hist, schema), spark.createDataFrame(fresh, schema)
    once = reload_window(h, f, exp)
    twice = reload_window(once, f, exp)
    rows1 = sorted(tuple(r) for r in once.collect())
    assert rows1 == sorted(tuple(r) for r in twice.collect())
    assert rows1 == sorted([r for r in hist if r[1] < exp] + [r for r in fresh if r[1] >= exp])

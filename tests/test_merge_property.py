"""merge_frames against a plain model of SQL MERGE, on random small tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationday.operators.merge import coalesce_source_target, merge_frames

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
VALS = st.one_of(st.none(), st.integers(-5, 5))
ROW = st.tuples(KEYS, st.sampled_from([1, 2]), VALS, VALS)


def model(target, source, update, insert):
    """MERGE: a NULL key never matches; matched rows take update[c](s, t) for
    listed columns; unmatched source rows insert the listed columns."""
    out, matched_t = [], set()
    src_by_key = {(r[0], r[1]): r for r in source if r[0] is not None}
    for i, t in enumerate(target):
        s = src_by_key.get((t[0], t[1])) if t[0] is not None else None
        if s is None:
            out.append(t)
            continue
        matched_t.add((t[0], t[1]))
        out.append(tuple(t[j] if j < 2 else update.get(j, lambda s, t: t)(s[j], t[j]) for j in range(4)))
    for s in source:
        if s[0] is None or (s[0], s[1]) not in matched_t:
            out.append(tuple(s[j] if j < 2 or j in insert else None for j in range(4)))
    return sorted(out, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(ROW, max_size=8, unique_by=lambda r: (r[0], r[1]) if r[0] is not None else id(r)),
       source=st.lists(ROW, max_size=8, unique_by=lambda r: (r[0], r[1]) if r[0] is not None else id(r)),
       coalesce=st.booleans(), insert_v=st.booleans())
def test_merge_frames_matches_model(spark, target, source, coalesce, insert_v):
    schema = "k string, p int, v int, w int"
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame(source, schema)
    upd = {"v": coalesce_source_target("v") if coalesce else "source"}
    insert = ["k", "p", "w"] + (["v"] if insert_v else [])
    got = sorted((tuple(r) for r in merge_frames(t, s, ["k", "p"], upd, insert).collect()), key=repr)
    py_update = {2: (lambda s_, t_: s_ if s_ is not None else t_) if coalesce else (lambda s_, t_: s_)}
    want = model(target, source, py_update, {0, 1, 3} | ({2} if insert_v else set()))
    assert got == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 3)),
                               st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from(["x", "y", None])),
                     max_size=15))
def test_dedupe_latest_matches_model(spark, rows):
    from stationday.operators.dedupe import dedupe_latest

    df = spark.createDataFrame(rows, "k string, seq int, v int, s string")
    got = sorted((tuple(r) for r in dedupe_latest(df, ["k"], order=["seq"], tiebreak=["v", "s"]).collect()),
                 key=repr)

    def rank(r):  # NULL orders below any value, field by field
        return tuple((x is not None, x if x is not None else 0) for x in (r[1], r[2], r[3]))

    best = {}
    for r in rows:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    assert got == sorted(best.values(), key=repr)

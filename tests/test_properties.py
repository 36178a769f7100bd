"""Property tests: predicates against brute force on random small frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions.predicates import cherry_pick, latest

key = st.one_of(st.none(), st.integers(0, 4))
pairs = st.lists(st.tuples(key, key), min_size=1, max_size=12)


def _newest(rows):
    # Sort each key descending with NULLs last; take the first row.
    def k(t):
        return tuple((v is not None, v if v is not None else 0) for v in t)

    return max(rows, key=k)


def _latest_brute(source, target, tuple_order):
    a0, b0 = _newest(target)
    out = []
    for a, b in source:
        if tuple_order:
            ok = a is None or b is None or (a0 is not None and a > a0) or (
                a0 is not None and b0 is not None and a == a0 and b > b0
            )
        else:
            ok = (a is None or (a0 is not None and a > a0)) and (b is None or (b0 is not None and b > b0))
        if ok:
            out.append((a, b))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=pairs, source=pairs, tuple_order=st.booleans())
def test_latest_matches_brute_force(spark, target, source, tuple_order):
    t = spark.createDataFrame(target, "a INT, b INT")
    s = spark.createDataFrame(source, "a INT, b INT")
    got = sorted((tuple(r) for r in s.where(latest(t, ["a", "b"], tuple_order=tuple_order)).collect()), key=repr)
    assert got == _latest_brute(source, target, tuple_order)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(request=st.lists(st.tuples(st.integers(0, 4), key), max_size=15), source=pairs)
def test_cherry_pick_matches_brute_force(spark, request, source):
    s = spark.createDataFrame(source, "a INT, b INT")
    pred = cherry_pick([{"a": a, "b": b} for a, b in request])
    got = sorted((tuple(r) for r in s.where(pred).collect()), key=repr)
    want = sorted(
        (
            (a, b)
            for a, b in source
            if any((a is None or a == ra) and (b is None or (rb is not None and b == rb)) for ra, rb in request)
        ),
        key=repr,
    )
    assert got == want

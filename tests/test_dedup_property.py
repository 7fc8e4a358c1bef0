"""keep_latest against a small pure-Python model on random rows (nulls, ties)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from cardmarts.operators import keep_latest

KEYS = st.sampled_from([None, "a", "b", "c"])
TS = st.integers(0, 3)
TEXT = st.one_of(st.none(), st.sampled_from(["", "x", "y", "xy", "Z"]))


def model(rows):
    """Per key: the greatest row by (ts, v, w), all descending with nulls last."""
    def rank(r):
        # a non-null value beats null, a larger value beats a smaller one
        return tuple((x is not None, x if x is not None else "") for x in (r[1], r[2], r[3]))
    best = {}
    for r in rows:
        k = r[0]
        if k not in best or rank(r) > rank(best[k]):
            best[k] = r
    return sorted(best.values(), key=repr)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(KEYS, TS, TEXT, TEXT), min_size=1, max_size=40))
def test_keep_latest_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "id string, _ingested_at int, v string, w string")
    got = sorted((tuple(r) for r in keep_latest(df, "id").collect()), key=repr)
    assert got == model(rows)

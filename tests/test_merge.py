from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starward.operators.merge import applied, change_counts, fact_merge

COLS = ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame(list(rows), "a int, b int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equal_new_gone(spark):
    m = fact_merge(frame(spark, [(1, 1), (2, 2)]), frame(spark, [(1, 1), (3, 3)]), COLS)
    assert rows(m.state) == [(1, 1), (3, 3)]
    assert rows(m.inserted) == [(3, 3)]
    assert rows(m.deleted) == [(2, 2)]


def test_null_is_deleted_and_inserted_again(spark):
    m = fact_merge(frame(spark, [(1, None)]), frame(spark, [(1, None)]), COLS)
    assert rows(m.state) == rows(m.inserted) == rows(m.deleted) == [(1, None)]


def test_changes_and_their_counts(spark):
    fact = frame(spark, [(1, 1), (2, 2)])
    m = fact_merge(fact, frame(spark, [(1, 1), (3, 3), (3, 3)]), COLS)
    assert change_counts(m.changes) == {"inserted": 2, "deleted": 1}
    assert rows(applied(fact, m.changes, COLS)) == [(1, 1), (3, 3), (3, 3)]


def by_hand(fact, source):
    def match(x, y):
        return None not in x and x == y

    keep = [f for f in fact if any(match(f, s) for s in source)]
    gone = [f for f in fact if not any(match(f, s) for s in source)]
    new = [s for s in source if not any(match(s, f) for f in fact)]
    return sorted(keep + new, key=str), sorted(new, key=str), sorted(gone, key=str)


values = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 1))), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values, values)
def test_against_brute_force(spark, fact, source):
    m = fact_merge(frame(spark, fact), frame(spark, source), COLS, unique=len(fact) % 2 == 0)
    state, new, gone = by_hand(fact, source)
    assert (rows(m.state), rows(m.inserted), rows(m.deleted)) == (state, new, gone)
    assert len(new) - len(gone) == len(state) - len(fact)
    assert change_counts(m.changes) == {"inserted": len(new), "deleted": len(gone)}
    assert rows(applied(frame(spark, fact), m.changes, COLS, m.unique)) == state

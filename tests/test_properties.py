"""Property checks (hypothesis) on small generated interaction tables."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from featurelake.operators import cleaning, merge
from conftest import tx_rows

row = st.tuples(
    st.sampled_from(["t1", "t2", "t3"]),
    st.one_of(st.none(), st.sampled_from(["U1", "U2"])),
    st.sampled_from(["P1", "P2"]),
    st.one_of(st.none(), st.sampled_from(["1.5", "ERROR_VAL", "2"])),
    st.one_of(st.none(), st.integers(min_value=0, max_value=7)),
    st.sampled_from(["2024-01-01 00:00:00", "2024-01-02T00:00:00.000000+00:00"]),
)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12))
def test_dedupe_idempotent_and_union_counts(spark, rows):
    df = tx_rows(spark, rows)
    once = cleaning.dedupe_rows(df)
    assert once.count() == len(set(rows))
    assert sorted(cleaning.dedupe_rows(once).collect(), key=repr) == sorted(once.collect(), key=repr)
    assert merge.merge_layers(df, df).count() == 2 * len(rows)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12))
def test_prepare_idempotent_on_complete_rows(spark, rows):
    complete = [r for r in rows if r[1] is not None and r[4] is not None]
    if not complete:
        return
    p1 = cleaning.prepare(tx_rows(spark, complete))
    p2 = cleaning.prepare(p1)
    assert sorted(p1.collect(), key=repr) == sorted(p2.collect(), key=repr)

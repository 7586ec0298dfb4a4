"""Property tests: keyed operators against a brute-force model on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hiremart import schemas
from hiremart.operators import scd2
from hiremart.operators.upsert import insert_ignore, upsert

from conftest import rows

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.integers(min_value=0, max_value=6)
vals = st.sampled_from(["a", "b", "c", None])
batch_rows = st.lists(st.tuples(keys, vals), min_size=0, max_size=25)
target_rows = st.dictionaries(keys, vals, max_size=6)


def _batch(spark, data):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)],
                                 "k int, v string, seq int")


@SETTINGS
@given(target=target_rows, data=batch_rows)
def test_upsert_matches_model(spark, target, data):
    t = spark.createDataFrame(sorted(target.items()), "k int, v string")
    model = dict(target)
    for k, v in data:                 # arrival order: the later row wins
        model[k] = v
    got = upsert(t, _batch(spark, data), ["k"], ["seq"])
    assert rows(got) == rows(spark.createDataFrame(sorted(model.items()), "k int, v string"))
    assert rows(upsert(got, _batch(spark, data), ["k"], ["seq"])) == rows(got)   # idempotent


@SETTINGS
@given(target=target_rows, data=batch_rows)
def test_insert_ignore_matches_model(spark, target, data):
    t = spark.createDataFrame(sorted(target.items()), "k int, v string")
    model = {}
    for k, v in data:                 # the first row of a new key wins
        if k not in target and k not in model:
            model[k] = v
    got = insert_ignore(t, _batch(spark, data), ["k"], ["seq"])
    assert rows(got) == rows(spark.createDataFrame(sorted(model.items()), "k int, v string"))


T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
emp = st.dictionaries(st.integers(min_value=1, max_value=6),
                      st.tuples(st.sampled_from(["n1", "n2"]), st.sampled_from(["u", None]),
                                st.sampled_from([True, False, None])), max_size=6)


def _staged(spark, d):
    return spark.createDataFrame([(k, *v) for k, v in sorted(d.items())],
                                 "employer_id bigint, employer_name string, alternate_url string, trusted boolean")


@SETTINGS
@given(first=emp, second=emp)
def test_scd2_two_loads_match_model(spark, first, second):
    dim = scd2.scd2_apply(schemas.empty(spark, schemas.DIM_EMPLOYER), _staged(spark, first), T1)
    dim = scd2.scd2_apply(dim, _staged(spark, second), T2)
    current = {r["employer_id"]: (r["employer_name"], r["alternate_url"], r["trusted"])
               for r in dim.filter("is_current").collect()}
    model = {**first, **second}       # latest staged attributes are current
    assert current == model
    closed = sorted(r["employer_id"] for r in dim.filter("NOT is_current").collect())
    assert closed == sorted(k for k in first if k in second and first[k] != second[k])

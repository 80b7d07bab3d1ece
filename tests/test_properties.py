"""Property tests: Spark column functions against the Python semantics the
reference's scripts use (int(), re.sub, str.split, dict upsert)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asklens.functions import text as X
from asklens.operators import graph as G
from asklens.operators import ratings as R

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

# Fixed value: the crawler's tag regex, run with Python's re as the reference does.
PY_TAG = r'(<[\d\w\s\;\:\'\"\,\.\/\?\!\@\#\$\%\^\&\*\(\)\-\_\=\+]+\/*>)'


def _py_int(s):
    try:
        return int(s)
    except (ValueError, TypeError):
        return None


def _col(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789 +-.a\t", max_size=12), min_size=1, max_size=30))
def test_tolerant_int_is_python_int(spark, values):
    got = [r[0] for r in _col(spark, values).orderBy("i").select(X.tolerant_int("s")).collect()]
    assert got == [_py_int(v) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="<>/ab é\"'=;{}[]|~_1\t.-", max_size=25), min_size=1, max_size=20))
def test_strip_tags_is_python_re(spark, values):
    got = [r[0] for r in _col(spark, values).orderBy("i").select(X.strip_tags("s")).collect()]
    assert got == [re.sub(PY_TAG, "", v) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="abc/:.org", max_size=20), min_size=1, max_size=20))
def test_org_token_is_python_split(spark, values):
    got = [r[0] for r in _col(spark, values).orderBy("i").select(X.org_token("s")).collect()]
    assert got == [v.split("/org/")[-1] for v in values]


@SETTINGS
@given(st.lists(st.from_regex(r"[a-z0-9_-]{1,8}", fullmatch=True), min_size=1, max_size=20))
def test_profile_url_token_is_python_split(spark, tokens):
    urls = [f"https://h.example/people/{t}/following" for t in tokens]
    got = [r[0] for r in _col(spark, urls).orderBy("i").select(X.url_token("s")).collect()]
    want = [u.split("/people/")[-1].split("/following")[0] for u in urls]
    assert got == want


@SETTINGS
@given(st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 5)), st.floats(0, 10), max_size=15),
       st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 5)), st.floats(0, 10), max_size=15))
def test_upsert_is_dict_update(spark, old, new):
    schema = "UId int, QId int, rate double"
    o = spark.createDataFrame([(a, b, r) for (a, b), r in old.items()], schema)
    n = spark.createDataFrame([(a, b, r) for (a, b), r in new.items()], schema)
    want = dict(old)
    want.update(new)
    got = {(r["UId"], r["QId"]): r["rate"] for r in R.upsert(o, n).collect()}
    assert got == want


@SETTINGS
@given(st.sets(st.text(alphabet="abcXY09", min_size=1, max_size=6), min_size=1, max_size=60),
       st.integers(1, 9))
def test_dense_index_is_sorted_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "node string").repartition(parts)
    got = {r["node"]: r["id"] for r in G.dense_index(df, "node").collect()}
    want = {k: i for i, k in enumerate(sorted(keys, key=lambda s: s.encode()))}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=80, unique=True),
       st.integers(1, 7))
def test_rank_within_group_is_sorted_position(spark, rows, parts):
    df = spark.createDataFrame(rows, "g long, o long").repartition(parts)
    got = {(r["g"], r["o"]): r["r"] for r in G.rank_within_group(df, "g", "o", "r").collect()}
    want = {}
    for g in {g for g, _ in rows}:
        for i, o in enumerate(sorted(o for gg, o in rows if gg == g)):
            want[(g, o)] = i
    assert got == want


@SETTINGS
@given(st.lists(st.integers(0, 30), min_size=1, max_size=200), st.integers(1, 6))
def test_hot_keys_never_exceed_max_keys(spark, keys, max_keys):
    from collections import Counter

    from asklens.operators.skew import hot_keys
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    hot, n = hot_keys(df, "k", min_rows=0, max_keys=max_keys)
    assert n <= max_keys
    threshold = len(keys) / max_keys
    assert {r["k"] for r in hot.collect()} == {k for k, c in Counter(keys).items() if c > threshold}

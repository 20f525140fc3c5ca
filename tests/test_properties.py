"""Property tests: operators against plain-Python models on random small inputs."""
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators.checks import table_diff
from ledgerlake.operators.dml import Clause, merge

KEYS = st.integers(min_value=0, max_value=6)
VALS = st.integers(min_value=-5, max_value=20)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def merge_model(target, source):
    """Ordered clauses: matched & s == amt -> delete; matched & s > amt -> subtract;
    matched otherwise -> keep; not matched -> insert."""
    out = []
    src = dict(source)
    for k, s in target:
        if k in src:
            a = src[k]
            if s == a:
                continue
            if s > a:
                out.append((k, s - a))
                continue
        out.append((k, s))
    tkeys = {k for k, _ in target}
    out += [(k, a) for k, a in source if k not in tkeys]
    return sorted(out)


@SETTINGS
@given(st.dictionaries(KEYS, VALS, max_size=6), st.dictionaries(KEYS, VALS, max_size=6))
def test_merge_matches_model(spark, target, source):
    t = spark.createDataFrame(sorted(target.items()), "k int, s int")
    s = spark.createDataFrame(sorted(source.items()), "k int, amt int")
    clauses = [Clause("matched", "delete", F.col("s") == F.col("src_amt")),
               Clause("matched", "update", F.col("s") > F.col("src_amt"), {"s": F.col("s") - F.col("src_amt")}),
               Clause("not_matched", "insert", None, {"k": F.col("src_k"), "s": F.col("src_amt")})]
    got = sorted(tuple(r) for r in merge(t, s, {"k": "k"}, clauses).collect())
    assert got == merge_model(sorted(target.items()), sorted(source.items()))


def test_merge_inserts_source_rows_with_null_keys(spark):
    t = spark.createDataFrame([(1, 10), (None, 5)], "k int, s int")
    s = spark.createDataFrame([(1, 1), (None, 7), (None, 7), (2, 2)], "k int, amt int")
    clauses = [Clause("matched", "update", None, {"s": F.col("src_amt")}),
               Clause("not_matched", "insert", None, {"k": F.col("src_k"), "s": F.col("src_amt")})]
    got = sorted((tuple(r) for r in merge(t, s, {"k": "k"}, clauses).collect()), key=repr)
    assert got == [(1, 1), (2, 2), (None, 5), (None, 7), (None, 7)]


@SETTINGS
@given(st.lists(st.tuples(KEYS, st.one_of(st.none(), st.sampled_from("abc"))), max_size=8),
       st.lists(st.tuples(KEYS, st.one_of(st.none(), st.sampled_from("abc"))), max_size=8))
def test_table_diff_is_bag_difference(spark, a, b):
    A = spark.createDataFrame(a, "k int, v string")
    B = spark.createDataFrame(b, "k int, v string")
    got = Counter()
    for r in table_diff(A, B).collect():
        got[(r.k, r.v, r.side)] += r.n
    ca, cb = Counter(a), Counter(b)
    want = Counter()
    for row, n in (ca - cb).items():
        want[row + ("a_only",)] += n
    for row, n in (cb - ca).items():
        want[row + ("b_only",)] += n
    assert got == want

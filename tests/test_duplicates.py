"""Repeated records by digest, also where digests collide."""

import pytest
from pyspark.sql import functions as F

from lendlake.operators import duplicates as dup
from lendlake.operators import marts
from lendlake.operators.quality import Check, run_checks

ROWS = [("a", 1.0, None), ("a", 1.0, None), ("a", None, 1), ("a", None, None), ("b", 0.0, 2), ("b", -0.0, 2), ("c", 3.0, 4)]
SCHEMA = "x string, y double, z int"


@pytest.mark.parametrize("limit", [dup.MAX_BROADCAST_DIGESTS, 0])
@pytest.mark.parametrize("digest", [None, "all equal", "two values"])
def test_groups_do_not_depend_on_the_digest(spark, monkeypatch, digest, limit):
    monkeypatch.setattr(dup, "MAX_BROADCAST_DIGESTS", limit)
    forced = {None: None, "all equal": (F.lit(7).cast("long"), F.lit(7).cast("long")), "two values": (F.length("x").cast("long"), F.ascii("x").cast("long") % 2)}[digest]
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = dup.repeats(df, ["x", "y", "z"], digest=forced)
    groups = {tuple(r)[:3]: r["n"] for r in found.groups.collect()}
    assert {k: n for k, n in groups.items() if n > 1} == {("a", 1.0, None): 2, ("b", 0.0, 2): 2}
    assert found.total == 7 and found.single + len(groups) == 5
    assert marts.duplicate_vectors(df, ["x", "y", "z"]).first().asDict() == {
        "duplicate_feature_vector_groups": 2, "duplicate_feature_vector_loan_count": 4,
        "duplicate_feature_vector_rate": 4 / 7, "distinct_feature_vector_count": 5,
    }


def test_empty_table(spark):
    r = marts.duplicate_vectors(spark.createDataFrame([], SCHEMA), ["x", "y", "z"]).first()
    assert tuple(r) == (0, None, None, 0)


def test_all_unique_keys_of_a_table_in_one_read(spark):
    df = spark.createDataFrame([("1", "a", None), ("1", "b", None), ("2", "a", None), (None, "a", None), (None, "a", "z"), ("12", "3", "q"), ("1", "23", "q")], "k string, l string, m string")
    checks = [Check("unique", "t", "k"), Check("unique_combination", "t", columns=["k", "l"]), Check("unique", "t", "m"), Check("unique_combination", "t", columns=["k", "l", "m"])]
    found = run_checks({"t": df}, checks)
    assert [r["n_violations"] for r in found.orderBy("check_order").collect()] == [1, 1, 1, 0]
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(check") == 1

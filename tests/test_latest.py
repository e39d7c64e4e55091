import pytest

from tasteforge.operators.latest import latest_per_key

ROWS = [
    ("a", "2026-06-08T19:23:58", "f1", 1),
    ("a", "2026-06-08T19:23:58.441272", "f2", 2),
    ("b", "2026-06-08T10:00:00", "f1", 3),
    ("b", "2026-06-08T10:00:00", "f9", 4),
    ("c", None, "f1", 5),
    ("c", None, "f2", 6),
    ("d", None, "f1", 7),
    ("d", "2020-01-01T00:00:00", "f0", 8),
    (None, "2020-01-01T00:00:00", "f0", 9),
    (None, "2021-01-01T00:00:00", "f0", 10),
]
SCHEMA = "k STRING, at STRING, file STRING, n INT"


@pytest.mark.parametrize("partitions", [1, 3, 10])
@pytest.mark.parametrize("reverse", [False, True])
def test_latest_row_whatever_the_layout(spark, partitions, reverse):
    rows = ROWS[::-1] if reverse else ROWS
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = latest_per_key(df, ["k"], "at", ["file"])
    assert got.columns == df.columns
    assert sorted(r.n for r in got.collect()) == [2, 4, 6, 8, 10]


def test_hot_key_is_reduced_before_its_one_shuffle(spark, plan):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 'hot', string(id)) AS k", "id AS at")
    latest = latest_per_key(df, ["k"], "at")
    text = plan(latest)
    assert text.count("Exchange hashpartitioning") == text.count("Exchange") == 1
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")  # the partial limit feeds the exchange
    assert latest.where("k = 'hot'").first()["at"] == 999

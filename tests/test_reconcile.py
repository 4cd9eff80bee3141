"""Parity by digests against a plain join, and the diff of two sources."""

import random

import pytest
from pyspark.sql import functions as F

from supplierlens.plans import reconcile

SCHEMA = "id long, part string, received_qty double, uom string"


def plain(left, right, c):
    """(compared, only left, only right, differing) of one column, by rows."""
    a, b = ({r[0]: r[c] for r in rows} for rows in (left, right))
    both = a.keys() & b.keys()
    return len(both), len(a.keys() - both), len(b.keys() - both), sum(a[k] != b[k] for k in both)


@pytest.mark.parametrize("ranges", [1, 7, 1 << 16])
def test_parity_by_ranges(spark, ranges):
    rnd = random.Random(4)
    left = [(i, f"P{i % 9}", float(i % 5), "EA") for i in range(400)]
    right = [(i, p if i != 17 else "X", q if i % 50 else None, u) for i, p, q, u in left if i not in (3, 4)] + [(900, "N", 1.0, "EA")]
    rnd.shuffle(right)
    out = reconcile.dataset_parity("purchase_orders", spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA),
                                   ["id"], ["part", "received_qty", "uom"], ranges)
    for r in out.collect():
        c = ["id", "part", "received_qty", "uom"].index(r["column_name"])
        want = plain(left, right, c)
        assert (r["compared"], r["only_left"], r["only_right"], r["documented"] + r["undocumented"]) == want
        if r["column_name"] == "received_qty":  # a blank for a zero is documented
            assert r["documented"] == sum(1 for i, _, q, _ in right if q is None and i < 900 and i % 5 == 0)


def test_equal_datasets_join_nothing(spark):
    rows = [(i, f"P{i}", 1.0, "EA") for i in range(300)]
    one, two = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[::-1], SCHEMA)
    ranges = reconcile._compared_ranges(
        *[df.select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("_range"), "*") for df in (one, two)], ["id"], ["part", "uom"])
    assert ranges.where(F.col("_keys_differ") | F.array_contains("_differ", True)).count() == 0
    out = reconcile.dataset_parity("items", one, two, ["id"], ["part", "uom"]).collect()
    assert [(r["compared"], r["only_left"], r["undocumented"]) for r in out] == [(300, 0, 0)] * 2


def test_rows_without_a_key_meet_nothing(spark):
    rows = [(1, "A", 1.0, "EA"), (None, "B", 1.0, "EA")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = reconcile.dataset_parity("items", df, df, ["id"], ["part"]).first()
    assert (out["compared"], out["only_left"], out["only_right"]) == (1, 1, 1)


def shuffled_rows(df):
    """Rows that the shuffles of an executed plan moved, without those of written tables that it reads."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.outputPartitioning().toString():
            rows += node.metrics().apply("shuffleRecordsWritten").value()
    return rows


def test_a_missing_row_does_not_move_the_values_of_its_range(spark):
    """Only keys of which values differ are joined with values, however many ranges lack a row."""
    right = [(i, f"P{i}", float(i), "EA") for i in range(3000)]
    left = [r if r[0] != 777 else (777, "X", 777.0, "EA") for r in right if r[0] % 30]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = reconcile.dataset_parity("items", spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA),
                                       ["id"], ["part", "received_qty", "uom"], 20)
        assert shuffled_rows(out) <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {(r["compared"], r["only_left"], r["only_right"], r["column_name"], r["undocumented"]) for r in out.collect()} == {
        (2900, 0, 100, "part", 1), (2900, 0, 100, "received_qty", 0), (2900, 0, 100, "uom", 0)}


@pytest.mark.parametrize("ranges", [1, 40])
@pytest.mark.parametrize("apart", [(), ("received_qty",), ("part", "uom"), ("part", "received_qty", "uom")])
def test_columns_apart_give_the_same_counts(spark, ranges, apart):
    """Against crosswise pairs in plain Python, with keys that are missing or repeated and values that are missing."""
    rnd, schema, columns = random.Random(5), "a long, b string, part string, received_qty double, uom string", ["part", "received_qty", "uom"]

    def some(n):
        return [(rnd.choice([None, *range(25)]), rnd.choice([None, "x", "y"]), rnd.choice([None, "P", " P "]),
                 rnd.choice([None, 0.0, 1.0]), rnd.choice(["EA", "EA", None])) for _ in range(n)]

    same = [(100 + i, "z", "P", 1.0, "EA") for i in range(60)]
    left, right = some(90) + same + same[:3], some(80) + same
    pairs = [(x, y) for x in left for y in right if x[:2] == y[:2] and None not in x[:2]]
    out = reconcile.dataset_parity("purchase_orders", spark.createDataFrame(left, schema), spark.createDataFrame(right, schema),
                                   ["a", "b"], columns, ranges, apart)
    rows = out.collect()
    assert [r["column_name"] for r in rows] == columns
    for r in rows:
        i = 2 + columns.index(r["column_name"])
        off = [(x[i], y[i]) for x, y in pairs if (x[i] and str(x[i]).strip(), x[i] is None) != (y[i] and str(y[i]).strip(), y[i] is None)]
        known = [p for p in off if i == 3 and not (p[0] or 0) and not (p[1] or 0)]
        assert r["compared"] == len(pairs)
        assert r["only_left"] == sum(not any(x is p for p, _ in pairs) for x in left)
        assert r["only_right"] == sum(not any(y is p for _, p in pairs) for y in right)
        assert (r["documented"], r["undocumented"]) == (len(known), len(off) - len(known))


def test_a_value_in_the_next_column_differs(spark):
    left = spark.createDataFrame([(1, "x", None, None), (2, None, 1.0, "y")], SCHEMA)
    right = spark.createDataFrame([(1, None, None, "x"), (2, "y", 1.0, None)], SCHEMA)
    out = reconcile.dataset_parity("items", left, right, ["id"], ["part", "uom"]).collect()
    assert [(r["compared"], r["undocumented"]) for r in out] == [(2, 2)] * 2

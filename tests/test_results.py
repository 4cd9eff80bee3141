"""Digests of loaded values, named bad values, complete result sets and the distance to a target."""

import pytest
from pyspark.sql import functions as F

from supplierlens.functions.digest import column_digests
from supplierlens.plans import census
from supplierlens.sources import contracts, ingest, sinks


def test_digests_see_shifted_and_cut_values(spark):
    rows = [(1, "abc", 1.5), (2, "abd", None), (3, None, 2.5)]

    def digests(rows):
        df = spark.createDataFrame(rows, "k long, t string, v double")
        return [r["value_digest"] for r in column_digests(df, "x", ["k", "t", "v"]).collect()]

    plain = digests(rows)
    assert digests(rows[::-1]) == plain
    assert digests([(1, "ab", 1.5), *rows[1:]])[1] != plain[1]
    assert digests([(1, "abc", 15.0), *rows[1:]])[2] != plain[2]
    assert digests([(1, "abc", None), (2, "abd", 1.5), rows[2]])[2] == plain[2]  # a column by itself knows no rows
    assert digests(rows + rows[:1]) != plain
    assert digests([]) == [0, 0, 0]


def test_up_to_eight_bad_values_are_named(spark):
    bad = [f"maybe {i}" for i in range(9)]
    df = spark.createDataFrame([(x,) for x in ["yes", "0", None, *bad, *bad]], "resolved string").repartition(4)
    with pytest.raises(contracts.ContractError) as error:
        ingest.check_truth(df, ("resolved",))
    watch = ingest.TruthWatch(df, ("resolved",))
    assert watch.df.where("resolved IS NULL").count() == 1 + 18
    with pytest.raises(contracts.ContractError) as seen:
        watch.check()
    assert str(seen.value) == str(error.value)
    assert sum(x in str(error.value) for x in bad) == ingest.NAMED
    good = ingest.TruthWatch(df.where("resolved IN ('yes', '0')"), ("resolved",))
    assert sorted(r[0] for r in good.df.collect()) == [False, True]
    good.check()


def test_one_bad_value_is_always_named(spark):
    for x in ("ja", "2", "", "vrai"):
        with pytest.raises(contracts.ContractError, match=repr(x)):
            ingest.check_truth(spark.createDataFrame([(x,), ("1",)], "resolved string"), ("resolved",))


def test_sets_without_or_beside_their_manifest_are_refused(spark, tmp_path):
    one, two = spark.range(5).withColumn("x", F.lit(1.5)), spark.range(3)
    folder = str(tmp_path / "set")
    sinks.write_tables({"one": one, "two": two}, folder)
    with pytest.raises(sinks.IncompleteSet, match="no manifest"):
        sinks.read_result_set(spark, folder)
    sinks.write_result_set({"one": one, "two": two}, folder)
    assert {n: df.count() for n, df in sinks.read_result_set(spark, folder).items()} == {"one": 5, "two": 3}
    two.withColumn("id", F.col("id") + 1).write.mode("overwrite").parquet(f"{folder}/two")
    with pytest.raises(sinks.IncompleteSet, match="two"):
        sinks.read_result_set(spark, folder)


def test_distance_to_known_measures(spark, sample):
    from supplierlens.sources.sampledata import SampleTables

    lines = census.line_facts(SampleTables(spark, sample))
    plain = {r["candidate"]: r.asDict() for r in census.scope_fingerprint(lines).collect()}
    target = {k: v for k, v in plain["buyer 5-LOW"].items() if k != "candidate"}
    rows = census.scope_fingerprint(lines, target=target).collect()
    nearest = [r for r in rows if r["distance_rank"] == 1]
    assert len(nearest) == 1 and nearest[0]["distance"] == 0
    assert all(r["distance"] == sum(abs(plain[r["candidate"]][k] - v) for k, v in target.items()) for r in rows)

"""Ordered computations when one group holds a large share of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.locks import lock_as_of
from tidemark.operators.ordered import Splits, _dealt, _keyed, carry_forward, number_rows, running_total
from tidemark.operators.select import stable_row_id
from tidemark.operators.versions import assign_ingestion_id, assign_process_id

SMALL = Splits(every=4, size=16)


@pytest.fixture
def skewed(spark):
    """A third of the rows in one group, all at one moment; some keys are null."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield (
        spark.range(6000)
        .withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, (F.col("id") % 37).cast("string")))
        .withColumn("at", F.when(F.col("k") == "hot", F.lit(7)).otherwise(F.hash("id") % 100))
        .withColumn("v", F.when(F.hash("id") % 5 == 0, F.col("id")))
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def local(df):
    data = sorted(df.collect(), key=lambda r: (r["k"] or "", r["k"] is not None, r["at"], r["id"]))
    return data


def expected_numbers(df):
    count, out = {}, {}
    for r in local(df):
        count[r["k"]] = count.get(r["k"], 0) + 1
        out[r["id"]] = count[r["k"]]
    return out


@pytest.mark.parametrize("moment", ["timestamp'2026-04-01 10:00:00'", "timestamp_micros(1775037600000000 + id * 7)"])
def test_a_hot_hour_or_moment_is_spread(spark, moment):
    """All rows of the group in one hour, or at one moment with ids that begin alike."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.lit("hot").alias("k"), F.expr(moment).alias("at"), F.format_string("ev_%010d", "id").alias("tie")
    )
    splits = Splits(every=8, size=100)
    keyed, keys = _keyed(rows, ["k"], ["at", "tie"])
    sizes = [r["count"] for r in _dealt(keyed, keys, splits).groupBy("_split").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 2000 and sum(sizes) == 40_000
    few = [r["count"] for r in _dealt(keyed, keys, Splits(8, 100, most=10)).groupBy("_split").count().collect()]
    assert 5 < len(few) <= 11 and max(few) < 10_000 and sum(few) == 40_000
    numbers = number_rows(rows, ["k"], ["at", "tie"], "n", splits=splits)
    assert numbers.where(F.col("n") != F.substring("tie", 4, 10).cast("long") + 1).count() == 0


def test_two_scans_and_one_shuffle_of_the_rows(spark, folder):
    spark.range(20_000).selectExpr("id % 3 AS k", "id", "id * 2 AS v", "'x' AS payload").write.parquet(f"{folder}/t")
    rows = spark.read.parquet(f"{folder}/t")
    base = spark.range(3).selectExpr("id AS k", "100 * id AS base")
    for df in (
        number_rows(rows, ["k"], ["id"], "n", splits=SMALL),
        number_rows(rows, ["k"], ["id"], "n", base, splits=SMALL),
        carry_forward(rows, ["k"], ["id"], "v", "last", splits=SMALL),
    ):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan
        dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
        assert len(dealt) == 2 and sum("ReusedExchange" in line for line in dealt) == 1


@pytest.mark.parametrize("splits", [Splits(), SMALL, Splits(1, 1)])
def test_number_rows(skewed, splits):
    found = number_rows(skewed, ["k"], ["at", "id"], "n", splits=splits)
    assert {r["id"]: r["n"] for r in found.collect()} == expected_numbers(skewed)


def test_one_group_over_everything_and_a_base(spark, rows):
    everything = number_rows(spark.range(500), [], ["id"], "n", splits=SMALL)
    assert everything.where("n != id + 1").count() == 0
    data = rows("k string, i int", ("a", 1), ("a", 2), (None, 1), ("c", 5))
    base = rows("k string, base long", ("a", 10), (None, 20), ("unused", 5), ("c", None))
    found = number_rows(data, ["k"], ["i"], "n", base, splits=Splits(1, 1))
    assert sorted(((r["k"], r["i"]), r["n"]) for r in found.collect() if r["k"]) == [(("a", 1), 11), (("a", 2), 12), (("c", 5), 1)]
    assert [r["n"] for r in found.where("k IS NULL").collect()] == [21] and found.columns == ["k", "i", "n"]


def test_running_total(spark):
    data = spark.range(1000).selectExpr("id % 2 AS k", "id", "id % 7 AS w")
    found = {r["id"]: r["t"] for r in running_total(data, ["k"], ["id"], F.col("w"), "t", splits=SMALL).collect()}
    for k in range(2):
        total = 0
        for i in range(k, 1000, 2):
            total += i % 7
            assert found[i] == total


@pytest.mark.parametrize("splits", [Splits(), SMALL, Splits(1, 1)])
@pytest.mark.parametrize("include", [True, False])
def test_carry_forward(skewed, include, splits):
    last, expected = {}, {}
    for r in local(skewed):
        if not include:
            expected[r["id"]] = last.get(r["k"])
        if r["v"] is not None:
            last[r["k"]] = r["v"]
        if include:
            expected[r["id"]] = last.get(r["k"])
    found = carry_forward(skewed, ["k"], ["at", "id"], "v", "c", include, splits)
    assert {r["id"]: r["c"] for r in found.collect()} == expected


def test_no_job_runs_while_plans_are_built(spark, rows):
    events, ledger = rows(EVENT, (1, 1, "p", "t", "m")), rows(LEDGER, (2, "p", "t", "m", "000001"))
    asked = rows("request_id string, process_name string, data_referencia string, created_at int, process_id string", ("a", "p", "m", 1, "1"))
    loads = rows(LEDGER + ", status string, loaded_at int", (2, "p", "t", "m", "000001", "LOADED_SOR", 1))
    rules = rows("process_name string, sor_table_name string, enabled boolean", ("p", "t", True))
    spark.sparkContext.setJobGroup("plans", "building")
    assign_ingestion_id(events, ledger)
    assign_process_id(asked.drop("process_id"), asked)
    lock_as_of(asked, rules, loads)
    stable_row_id(events, ["process_name"], ["event_id"], "n")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("plans") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


EVENT = "event_id int, event_time int, process_name string, sor_table_name string, data_referencia string"
LEDGER = "event_id int, process_name string, sor_table_name string, data_referencia string, ingestion_id string"


def test_ids_continue_and_a_second_run_adds_nothing(rows):
    events = rows(EVENT, *[(i, 100 - i, "p", "t", "202604") for i in range(4)], (9, 1, "p", "u", "202604"))
    ledger = rows(LEDGER, (50, "p", "t", "202604", "999998"), (3, "p", "t", "202604", "000001"))
    first = assign_ingestion_id(events, ledger).collect()
    assert {r["event_id"]: r["ingestion_id"] for r in first} == {
        2: "999999", 1: "1000000", 0: "1000001", 9: "000001",
    }
    grown = ledger.unionByName(
        rows(LEDGER, *[(r["event_id"], "p", r["sor_table_name"], "202604", r["ingestion_id"]) for r in first])
    )
    assert assign_ingestion_id(events, grown).count() == 0


def test_process_ids_in_both_forms(rows):
    asked = rows("request_id string, process_name string, data_referencia string, created_at int", ("a", "seguros", "202604", 1))
    known = rows("process_id string, process_name string, data_referencia string, request_id string", ("proc_seguros_202604_007", "seguros", "202604", None))
    assert assign_process_id(asked, known, named=True).first()["process_id"] == "proc_seguros_202604_008"
    assert assign_process_id(asked, known).first()["process_id"] == "000008"
    assert assign_process_id(asked.limit(0), known).count() == 0
    again = known.withColumn("request_id", F.lit("a"))
    assert assign_process_id(asked, again).count() == 0


def test_an_event_or_request_delivered_twice_gets_one_id(rows):
    events = rows(EVENT, (1, 10, "p", "t", "m"), (1, 12, "p", "t", "m"), (2, 11, "p", "t", "m"), (None, 5, "p", "t", "m"), (None, 6, "p", "t", "m"), (None, 6, "p", "t", "m"))
    found = assign_ingestion_id(events, rows(LEDGER, (7, "p", "t", "m", "000004"))).collect()
    assert sorted((r["event_time"], r["ingestion_id"]) for r in found) == [(5, "000005"), (6, "000006"), (10, "000007"), (11, "000008")]
    asked = rows("request_id string, process_name string, data_referencia string, created_at int", ("a", "p", "m", 2), ("a", "p", "m", 1))
    known = rows("process_id string, process_name string, data_referencia string, request_id string", ("000001", "p", "m", "z"))
    assert [(r["created_at"], r["process_id"]) for r in assign_process_id(asked, known).collect()] == [(1, "000002")]
    with pytest.raises(ValueError, match="request_id"):
        assign_process_id(asked, known.drop("request_id"))

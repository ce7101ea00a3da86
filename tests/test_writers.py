"""Writers: replaced and untouched partitions, text keys, empty results, CSV files."""

from __future__ import annotations

import glob
import os

import pytest

from tidemark import DestSpec
from tidemark.sinks import (
    append_manifest,
    check_partition_keys,
    compact_partitions,
    destination_settings,
    export_csv,
    present_files,
    read_manifest,
    write_catalog_table,
    write_partitions,
    write_result,
    written_files,
)
from tidemark.sinks.manifest import partition_folder
from tidemark.sinks.partitions import write_files


def test_only_written_partitions_change(spark, rows, folder):
    schema = "v int, ingestion_id string"
    dest = DestSpec(folder, "t", partition_keys=["ingestion_id"])
    assert write_partitions(rows(schema, (1, "000008"), (2, None), (3, "a:b/c")), dest).rows == 3
    for _ in range(2):
        assert write_partitions(rows(schema, (20, None), (30, "a:b/c")), dest, ["ingestion_id"]).rows == 2
    assert write_partitions(rows(schema), dest).rows == 0
    back = spark.read.schema(schema).parquet(dest.path)
    assert {tuple(r) for r in back.collect()} == {(1, "000008"), (20, None), (30, "a:b/c")}
    assert "000008" in " ".join(os.listdir(dest.path))


def test_a_job_may_replace_what_it_reads(spark, rows, folder):
    dest = DestSpec(folder, "t", partition_keys=["p"])
    write_partitions(rows("v int, p string", (1, "x"), (2, "y")), dest)
    own = spark.read.schema("v int, p string").parquet(dest.path).where("p = 'x'").selectExpr("v + 10 AS v", "p")
    write_partitions(own, dest)
    assert {tuple(r) for r in spark.read.schema("v int, p string").parquet(dest.path).collect()} == {(11, "x"), (2, "y")}


def test_partition_keys_are_checked():
    assert check_partition_keys(["a", "b"], [" b ", ""]) == ["b"]
    for keys in ([], [" "], ["B"], ["nope"], ["a", "b"]):
        with pytest.raises(ValueError):
            check_partition_keys(["a", "b"], keys)


def test_large_partition_is_split_by_rebalance(spark, rows, folder):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    df = spark.range(0, 200000, 1, 8).selectExpr("uuid() AS v", "if(id % 3 > 0, 'hot', cast(id % 7 AS string)) AS p")
    dest = DestSpec(folder, "t", partition_keys=["p"])
    assert write_partitions(df, dest).rows == 200000
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(glob.glob(f"{dest.path}/p=hot/*.parquet")) > 1


def test_catalog_table_grows_by_columns_only(spark, rows, folder):
    dest = DestSpec(folder, "t", database="tm_test", partition_keys=["p"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tm_test LOCATION '{folder}/db'")
    spark.sql("DROP TABLE IF EXISTS tm_test.t")
    write_catalog_table(rows("a int, p string", (1, "x"), (2, "y")), dest)
    assert write_result(rows("b string, a int, p string", ("n", 10, "x")), dest).rows == 1
    assert {tuple(r) for r in spark.table("tm_test.t").select("a", "b", "p").collect()} == {(10, "n", "x"), (2, None, "y")}
    write_catalog_table(rows("a int, p string", (3, "z")), dest)
    assert spark.table("tm_test.t").where("p = 'z' AND b IS NULL").count() == 1
    with pytest.raises(ValueError, match="cannot change"):
        write_catalog_table(rows("a string, p string", ("1", "x")), dest)
    with pytest.raises(ValueError, match="cannot change"):
        write_catalog_table(rows("a int, p string", (1, "x")), DestSpec(folder, "t", database="tm_test", partition_keys=["a"]))
    spark.sql("DROP TABLE tm_test.t")
    spark.sql("DROP DATABASE tm_test")


def test_csv_exports(spark, rows, folder):
    df = rows("a int, b string", (1, "x,y"), (2, None)).repartition(2)
    parts = DestSpec(folder, "parts", kind="csv")
    assert export_csv(df, parts).rows == 2
    one = DestSpec(folder, "one", kind=" CSV ", header=False, file_name="import.csv", single=True)
    for _ in range(2):
        assert write_result(df, one).path.endswith("one/import.csv")
    with open(f"{folder}/one/import.csv") as f:
        assert sorted(f.read().split("\n")) == ["", '1,"x,y"', "2,"]
    assert [f for f in os.listdir(f"{folder}/one") if not f.startswith(".")] == ["import.csv"]
    export_csv(df.limit(0), DestSpec(folder, "none", kind="csv", file_name="x.csv", single=True))
    with open(f"{folder}/none/x.csv") as f:
        assert f.read().strip() == "a,b"
    large = DestSpec(folder, "large", kind="csv", file_name="big.csv")
    assert export_csv(df, large).rows == 2
    assert os.path.isdir(f"{folder}/large/big.csv")
    assert spark.read.option("header", "true").csv(f"{folder}/large/big.csv").count() == 2


def test_destination_kind_and_settings(rows, folder):
    with pytest.raises(ValueError, match="kind"):
        write_result(rows("a int", (1,)), DestSpec(folder, "t", kind="orc"))
    technical = {"group_files": "inPartition", "group_size_bytes": 1, "compression": "snappy", "block_size_bytes": 1, "s3_destino": "t"}
    merged = destination_settings(technical, {"dev": {"s3_destino": "e", "compression": "gzip"}}, {"compression": "zstd"}, "dev")
    assert (merged["s3_destino"], merged["compression"]) == ("e", "zstd")
    with pytest.raises(ValueError, match="block_size_bytes"):
        destination_settings({}, {"dev": {}}, {}, "dev")
    with pytest.raises(ValueError, match="environment"):
        destination_settings(technical, {}, {}, "hom")


def test_manifest_counts_rows_without_sorting_them(spark, rows, folder):
    """A task of the listing holds one count per file, whatever the number of its rows."""
    report = write_partitions(rows("v int, k string", (1, "a"), (2, "a"), (3, "b+c")), DestSpec(folder, "t", partition_keys=["k"]))
    listed = written_files(spark, report)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert {(r.partition, r.rows) for r in listed.collect()} == {("k=a", 2), ("k=b+c", 1)}


def test_manifest_of_a_write(spark, rows, folder):
    """Values that paths escape, nulls, an untouched partition, and a partition written twice."""
    schema = "v int, k string, m string"
    odd = ["a:b/c", "50%", "x=y", "'q'", "é[1]", "000008", "sp ace", "1+1"]
    dest = DestSpec(folder, "t", partition_keys=["k", "m"])
    first = write_partitions(rows(schema, *[(i, o, "1") for i, o in enumerate(odd)], (9, None, "2"), (10, None, "2")), dest)
    assert {partition_folder(p) for p in first.partitions} == {
        os.path.relpath(os.path.dirname(f), dest.path) for f in glob.glob(f"{dest.path}/*/*/*.parquet")
    }
    append_manifest(spark, first, f"{folder}/manifest", "w1")
    second = write_partitions(rows(schema, (5, "a:b/c", "1"), (6, "a:b/c", "1"), (7, "new", "1")), dest)
    listed = written_files(spark, second)
    assert len(second.partitions) == 2
    assert {(r.partition, r.rows) for r in listed.collect()} == {("k=a%3Ab%2Fc/m=1", 2), ("k=new/m=1", 1)}
    append_manifest(spark, second, f"{folder}/manifest", "w2")
    nothing = write_partitions(rows(schema), dest)
    assert nothing.partitions == [] and written_files(spark, nothing).count() == 0
    append_manifest(spark, nothing, f"{folder}/manifest", "w3")
    there = {os.path.join(r.partition, r.file_name): (r.rows, r.bytes) for r in present_files(read_manifest(spark, f"{folder}/manifest")).collect()}
    files = {os.path.relpath(f, dest.path): os.path.getsize(f) for f in glob.glob(f"{dest.path}/*/*/*.parquet")}
    assert {k: b for k, (_, b) in there.items()} == files
    assert sum(n for n, _ in there.values()) == spark.read.schema(schema).parquet(dest.path).count() == 12


def test_catalog_writes_look_at_their_own_partitions_only(spark, rows, folder):
    dest = DestSpec(folder, "t", database="tm_own", partition_keys=["p"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tm_own LOCATION '{folder}/db'")
    spark.sql("DROP TABLE IF EXISTS tm_own.t")
    write_partitions(rows("a int, p string", (0, "before")), dest)
    write_catalog_table(rows("a int, p string", (1, "x")), dest)
    write_partitions(rows("a int, p string", (5, "aside")), dest)
    write_catalog_table(rows("a int, p string", (2, "it's"), (3, None), (4, "x")), dest)
    assert {tuple(r) for r in spark.table("tm_own.t").collect()} == {(0, "before"), (2, "it's"), (3, None), (4, "x")}
    elsewhere = DestSpec(f"{folder}/two", "t", database="tm_own", partition_keys=["p"])
    with pytest.raises(ValueError, match="lies at"):
        write_result(rows("a int, p string", (7, "x")), elsewhere)
    assert not os.path.exists(f"{folder}/two")
    write_result(rows("a int, p string", (8, "x")), DestSpec(f"file:{folder}/", "t", database="tm_own", partition_keys=["p"]))
    assert spark.table("tm_own.t").where("p = 'x'").first()["a"] == 8
    spark.sql("DROP TABLE tm_own.t")
    spark.sql("DROP DATABASE tm_own")


def test_one_file_from_many_tasks(spark, folder):
    df = spark.range(0, 1600, 1, 16).selectExpr("id", "'é,' || id AS t")
    spark.sparkContext.setJobGroup("single", "export")
    dest = DestSpec(folder, "one", kind="csv", file_name="all.csv", single=True)
    assert export_csv(df, dest).rows == 1600
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("single") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) == 16
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with open(f"{folder}/one/all.csv", encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines[0] == "id,t" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(1600))
    assert [f for f in os.listdir(f"{folder}/one") if not f.startswith(".")] == ["all.csv"]


def test_compaction_rewrites_only_what_is_scattered(spark, rows, folder):
    schema = "v int, s string, k string"
    dest = DestSpec(folder, "t", partition_keys=["k"])
    df = spark.range(0, 4000, 1, 20).selectExpr("cast(id as int) v", "uuid() s", "case id % 4 when 0 then 'a:b' when 1 then null else 'whole' end k").persist()
    write_files(df.where("k = 'whole'").coalesce(1), dest, ["k"])
    write_files(df.where("k IS NULL OR k <> 'whole'"), dest, ["k"])
    count = lambda k: len(glob.glob(f"{dest.path}/k={k}/*.parquet"))
    assert (count("a%3Ab"), count("__HIVE_DEFAULT_PARTITION__"), count("whole")) == (20, 20, 1)
    untouched = glob.glob(f"{dest.path}/k=whole/*.parquet")
    confined = compact_partitions(spark, dest, df.schema, [{"k": "whole"}])
    assert confined.rows == 0 and compact_partitions(spark, dest, df.schema, []).rows == 0
    report = compact_partitions(spark, dest, df.schema)
    assert report.rows == 2000 and sorted(map(str, (p["k"] for p in report.partitions))) == ["None", "a:b"]
    assert (count("a%3Ab"), count("__HIVE_DEFAULT_PARTITION__")) == (1, 1)
    assert glob.glob(f"{dest.path}/k=whole/*.parquet") == untouched
    back = spark.read.schema(schema).parquet(dest.path)
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    assert compact_partitions(spark, dest, df.schema).rows == 0  # nothing is left to do
    files = [os.path.getsize(f) for f in glob.glob(f"{dest.path}/k=a*/*.parquet")]
    write_files(df.where("k = 'a:b'"), dest, ["k"])
    assert compact_partitions(spark, dest, df.schema, target=sum(files) // 2).rows == 1000 and 1 < count("a%3Ab") <= 10
    df.unpersist()

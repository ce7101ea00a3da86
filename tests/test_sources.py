"""Scans: leading zeros, dialects, dated paths, duplicate removal, plans."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import SourceSpec
from tidemark.operators.counts import observed
from tidemark.operators.dedup import drop_duplicates
from tidemark.operators.select import latest_rows, staged_sql, surrogate_row_id, technical_columns
from tidemark.sources import load_source, load_sources, read_csv, read_dated, read_landing, read_parquet, read_table, resolve_schemas, schema_changes


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_keeps_leading_zeros_and_dialect(spark, folder):
    with open(f"{folder}/a.csv", "w", encoding="ISO-8859-1") as f:
        f.write("id;nome\n000001;'a;b'\n000002;'não'\n")
    df = read_csv(
        spark, f"{folder}/a.csv", schema="id string, nome string", delimiter=";", quote="'", encoding="ISO-8859-1",
        predicate="id <> '{FORA}'", params={"FORA": "000003"},
    )
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("000001", "a;b"), ("000002", "não")]
    plain = read_csv(spark, f"{folder}/a.csv", delimiter=";", quote="'", encoding="ISO-8859-1")
    assert {r["id"] for r in plain.collect()} == {"000001", "000002"}


def test_csv_without_header(spark, folder):
    with open(f"{folder}/a.csv", "w") as f:
        f.write("1,x\n2,y\n")
    assert read_csv(spark, f"{folder}/a.csv", schema="a int, b string", header=False).count() == 2


def test_dated_path_reads_one_month_or_all_and_prunes(spark, rows, folder):
    for month in ("202603", "202604"):
        rows("v int", (int(month),)).write.option("header", "true").csv(f"{folder}/tabela_contrato_{month}.csv")
    template = folder + "/tabela_contrato_{ANO_MES_DATA_REF}.csv"
    one = read_dated(spark, template, "v int", month="202604", file_format="csv", header="true")
    assert [tuple(r) for r in one.collect()] == [(202604, "202604")]
    every = read_dated(spark, template, "v int", file_format="csv", header="true")
    assert {tuple(r) for r in every.collect()} == {(202603, "202603"), (202604, "202604")}
    assert [r["v"] for r in every.where("ano_mes_data_ref = '202603'").collect()] == [202603]
    with pytest.raises(ValueError):
        read_dated(spark, folder, "v int")
    with pytest.raises(ValueError):
        read_dated(spark, template, "v int", month="2026")


def test_landing_needs_existing_paths(spark, rows, folder):
    rows("v int", (1,)).write.parquet(f"{folder}/a")
    assert read_landing(spark, [f"{folder}/a", f"{folder}/a"], "v int").count() == 1
    with pytest.raises(PySparkException):
        read_landing(spark, [f"{folder}/a", f"{folder}/b"], "v int").count()
    with pytest.raises(ValueError):
        read_landing(spark, [], "v int")


def test_schema_policy_on_evolving_files(spark, rows, folder):
    rows("a int", (1,)).write.parquet(f"{folder}/t/p=1")
    rows("a int, b string", (2, "x")).write.parquet(f"{folder}/t/p=2")
    fixed = load_source(spark, SourceSpec("t", path=f"{folder}/t", schema="a int, p string"))
    assert fixed.columns == ["a", "p"]
    merged = load_source(
        spark, SourceSpec("t", path=f"{folder}/t", schema="a int", use_catalog_schema=False)
    )
    assert set(merged.columns) == {"a", "b", "p"}


def test_partition_predicate_prunes_and_pushes_down(spark, rows, folder):
    rows("v int, ingestion_id string", (1, "000008"), (200, "000008"), (300, "000009")).write.partitionBy(
        "ingestion_id"
    ).parquet(f"{folder}/t")
    df = read_parquet(
        spark, f"{folder}/t", "v int, ingestion_id string",
        "ingestion_id = '{INGESTION_ID}' AND v > 100", {"INGESTION_ID": "000008"},
    )
    assert [tuple(r) for r in df.collect()] == [(200, "000008")]
    text = plan(df)
    assert "PartitionFilters: [isnotnull(ingestion_id" in text and "GreaterThan(v,100)" in text


def test_unknown_kind_and_repeated_view(spark, folder):
    with pytest.raises(ValueError, match="kind"):
        load_source(spark, SourceSpec("x", "jdbc"))
    with pytest.raises(ValueError, match="used twice"):
        load_sources(spark, [SourceSpec("x"), SourceSpec("x")])


def test_dedup_choice_is_repeatable(rows):
    df = rows("k int, v string, m map<string,int>", (1, "b", {"z": 1}), (1, "a", {"z": 2}), (2, "c", None), (1, "a", {"z": 1}))
    expected = {(1, "a", 1), (2, "c", None)}
    for n in (1, 2, 4):
        kept = drop_duplicates(df.repartition(n), ["k"]).collect()
        assert {(r["k"], r["v"], r["m"]["z"] if r["m"] else None) for r in kept} == expected
    assert drop_duplicates(rows("a int", (1,), (1,)), ["*"]).count() == 1
    assert {r["v"] for r in drop_duplicates(df.select("k", "v"), ["k"], ["v"]).collect()} == {"a", "c"}
    with pytest.raises(ValueError):
        drop_duplicates(df, [])
    with pytest.raises(ValueError, match="nope"):
        drop_duplicates(df, ["nope"])


def test_group_limits_run_before_the_shuffle(rows):
    df = rows("k int, v int", (1, 1), (1, 2))
    for limited in (drop_duplicates(df, ["k"]), latest_rows(df, ["k"], [F.desc("v")], 3)):
        text = plan(limited)
        assert text.count("WindowGroupLimit") == 2
        assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_staged_sql(spark, rows):
    frames = {"tabela_contrato": rows("n int, v double", (1, 50.0), (2, 150.0), (3, None))}
    df = staged_sql(
        spark,
        frames,
        ["/*um; dois*/ SELECT * FROM tabela_contrato WHERE v > {MIN};", "SELECT n, ';' AS s FROM query_temp_1"],
        {"MIN": "100"},
    )
    assert [tuple(r) for r in df.collect()] == [(2, ";")]
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]
    braces = staged_sql(spark, frames, ["SELECT n FROM tabela_contrato WHERE n rlike '^[0-9]{1}$' AND '{B}' = '{B}'"], {"A": "1"})
    assert braces.count() == 3
    with pytest.raises(ValueError):
        staged_sql(spark, frames, [" ; "])
    frames["tabela_contrato"].createOrReplaceTempView("tabela_contrato")
    with pytest.raises(PySparkException, match="ALREADY_EXISTS"):
        staged_sql(spark, frames, ["SELECT 1"])
    spark.catalog.dropTempView("tabela_contrato")
    with pytest.raises(PySparkException):
        staged_sql(spark, frames, ["SELECT * FROM nao_existe"])
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]


def test_technical_columns_replace(rows):
    df = technical_columns(rows("A int, process_id string", (1, "x")), {"PROCESS_ID": "000008", "b": "1"})
    assert df.columns == ["A", "PROCESS_ID", "b"] and tuple(df.first()) == (1, "000008", "1")
    ids = [r[0] for r in surrogate_row_id(df.union(df).repartition(2)).select("chave_processamento_registro").collect()]
    assert len(set(ids)) == 2


def test_counts_ride_along(rows):
    df, observation = observed(rows("a int", (1,), (2,)))
    df.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 2


def test_schemas_are_resolved_column_by_column():
    ddl = T.StructType.fromDDL
    catalog = ddl("a int, b float, c decimal(10,2), d string")
    files = [ddl("A bigint, b double, c decimal(12,4), e date"), ddl("a smallint, d string, f map<string,int>")]
    assert resolve_schemas(catalog, files).simpleString() == "struct<a:bigint,b:double,c:decimal(12,4),d:string,e:date,f:map<string,int>>"
    assert schema_changes(catalog, files[0]) == {"a": "WIDENED", "b": "WIDENED", "c": "WIDENED", "d": "ABSENT", "e": "ADDED"}
    assert schema_changes(catalog, catalog) == dict.fromkeys("abcd", "SAME")
    for wrong in ("a string", "a double, d int", "d date", "c decimal(38,0)", "b decimal(5,1)"):
        with pytest.raises(ValueError, match="column"):
            resolve_schemas(catalog, [ddl(wrong)])
    with pytest.raises(ValueError, match="a is bigint and double"):
        resolve_schemas(None, [ddl("a bigint"), ddl("a double")])


def test_tables_of_several_generations(spark, rows, folder):
    """With and without partitions; filters on partitions still prune in every generation."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tm_gen LOCATION '{folder}/db'")
    for name, keys in (("parts", "PARTITIONED BY (p)"), ("plain", "")):
        at = f"{folder}/{name}"
        generations = [rows("a int, p string", (1, "x'1"), (2, None)), rows("A bigint, b string, p string", (1 << 40, "n", "y"))]
        for df in generations:
            (df.write.partitionBy("p") if keys else df.coalesce(1).write).mode("append").parquet(at)
        spark.sql(f"CREATE TABLE tm_gen.{name} (a int, p string) USING parquet {keys} LOCATION '{at}'")
        if keys:
            spark.catalog.recoverPartitions(f"tm_gen.{name}")
        whole = read_table(spark, "tm_gen", name, use_catalog_schema=False)
        assert sorted(((r["a"], r["b"], r["p"]) for r in whole.collect()), key=str) == [(1, None, "x'1"), (1 << 40, "n", "y"), (2, None, None)]
        one = read_table(spark, "tm_gen", name, "p = '{P}'", {"P": "y"}, use_catalog_schema=False)
        assert [r["a"] for r in one.collect()] == [1 << 40]
        if keys:
            assert "PartitionFilters: [isnotnull(p" in plan(one)
        spark.sql(f"DROP TABLE tm_gen.{name}")
    spark.sql("DROP DATABASE tm_gen")

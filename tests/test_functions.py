"""Reference dates, names, templates, overrides and checks on small fixtures."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.names import flag_is_true, normalize_name, partition_context, partition_path, sor_name
from tidemark.functions.predicates import (
    override_rows,
    override_scalars,
    parse_override_list,
    predicate_precedence,
)
from tidemark.functions.quality import required_fields, split_valid
from tidemark.functions.refdate import with_reference_context
from tidemark.functions.templates import (
    bind_parameters,
    fill_template,
    unresolved_names,
    uses_placeholder,
)
from tidemark.sources.loading import effective_predicate
from tidemark.sources.tables import database_for, read_grouping, where_text
from tidemark.specs import SourceSpec


def test_reference_dates(rows):
    refs = ("202601", "20260415", "20260230", "202613", "2026", "2026-1", "20240229", None)
    df = with_reference_context(rows("ref string", *[(r,) for r in refs]), "ref", F.to_date(F.lit("2026-05-01")))
    found = {r["ref"]: r for r in df.collect()}
    january = found["202601"]
    assert (january["ano_data_ref"], january["mes_data_ref"]) == ("2026", "01")
    assert (january["ano_mes_anterior"], january["mes_anterior"]) == ("202512", "12")
    april = found["20260415"]
    assert (april["ano_mes_data_ref"], april["ano_mes_anterior"]) == ("202604", "202603")
    assert found["20240229"]["ano_mes_anterior"] == "202401"
    assert april["data_atual"] == "20260501"
    for bad in ("20260230", "202613", "2026", "2026-1", None):
        assert not found[bad]["data_ref_valida"] and found[bad]["ano_mes_anterior"] is None


def test_names_and_flags(rows):
    row = (
        rows("p string, e string, f string", ("data-referencia", "contratos", " TRUE "))
        .select(
            normalize_name(F.col("p")).alias("n"),
            sor_name(F.lit("seguros"), F.col("e")).alias("s"),
            flag_is_true(F.col("f")).alias("f"),
            flag_is_true(F.lit(None).cast("string")).alias("g"),
            partition_path(F.lit("/lake/"), F.col("e"), ["p"]).alias("path"),
        )
        .first()
    )
    assert tuple(row) == ("DATA_REFERENCIA", "seguros_contratos", True, False, "/lake/contratos/p=data-referencia/")


def test_partition_context_names_and_collision(rows):
    df = rows("m map<string,string>", ({"data-referencia": "202604", "dia base": "15"},))
    assert df.select(partition_context(F.col("m")).alias("c")).first()["c"] == {
        "PARTITION_DATA_REFERENCIA": "202604",
        "PARTITION_DIA_BASE": "15",
    }
    clash = rows("m map<string,string>", ({"a-b": "1", "a_b": "2"},))
    assert clash.select(partition_context(F.col("m")).alias("c")).first()["c"] == {"PARTITION_A_B": "2"}
    turned = rows("i int", (1,)).select(F.map_from_arrays(F.array(F.lit("a_b"), F.lit("a-b")), F.array(F.lit("2"), F.lit("1"))).alias("m"))
    assert turned.select(partition_context(F.col("m")).alias("c")).first()["c"] == {"PARTITION_A_B": "2"}


CONTEXT = {"PARTITION_DATA_REFERENCIA": "202604", "PARTITION_DIA_BASE": "15"}


def test_bind_parameters():
    text, args = bind_parameters(
        "data_referencia = '{PARTITION_DATA_REFERENCIA}' AND dia_base = '{PARTITION_DIA_BASE}'", CONTEXT
    )
    assert text == "data_referencia = :PARTITION_DATA_REFERENCIA AND dia_base = :PARTITION_DIA_BASE"
    assert args == CONTEXT
    with pytest.raises(ValueError, match="PARTITION_INEXISTENTE"):
        bind_parameters("x = '{PARTITION_INEXISTENTE}'", CONTEXT)
    assert uses_placeholder("i = '{INGESTION_ID}'", "INGESTION_ID") and not uses_placeholder(None, "X")


@pytest.mark.parametrize(
    ("text", "value", "kept"),
    [
        ("c = '{V}'", "a", {"a"}),
        ("c = '{V}'", "it's", {"it's"}),
        ("c = 'pre_{V}_post'", "it's", {"pre_it's_post"}),
        ("c like '%{V}'", "s", {"it's"}),
        ("c = '{V}' or c rlike '^t{{2}}$'", "' or 1=1 --", set()),
        ("c = '{V}' or c rlike '^[a]{{1}}$'", "' or 1=1 --", {"a"}),
        ("length(c) = {V}", "1", {"a"}),
        ("c /* d'agua */ = '{V}' -- it's", "it's", {"it's"}),
        ('c = "{V}"', "it's", {"it's"}),
        ("c = 'it''s' and 'x' <> '{V}'", "a", {"it's"}),
    ],
)
def test_bound_predicates_filter_by_value(rows, text, value, kept):
    df = rows("c string", ("a",), ("it's",), ("pre_it's_post",))
    assert {r["c"] for r in where_text(df, text, {"V": value}).collect()} == kept


def test_fill_template_fills_once_and_reports(rows):
    df = rows(
        "t string, m map<string,string>",
        ("x = '{A}' and y = '{B}'", {"A": "{B}", "B": "2"}),
        ("{C}-{A}", {"A": "1"}),
        ("plain", {}),
    )
    found = df.select(
        fill_template(F.col("t"), F.col("m")).alias("t"), unresolved_names(F.col("t"), F.col("m")).alias("u")
    ).collect()
    assert [tuple(r) for r in found] == [("x = '{B}' and y = '2'", []), ("{C}-1", ["C"]), ("plain", [])]


def _expected_overrides(text):
    out = {}
    for item in (text or "").split(";"):
        name, mark, predicate = item.partition("::")
        if mark and name.strip() and predicate.strip():
            out[name.strip()] = predicate.strip()
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab:; =\n\t", max_size=25), min_size=40, max_size=60))
def test_parse_override_list_like_a_plain_loop(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r["i"]: r["m"] for r in df.select("i", parse_override_list(F.col("t")).alias("m")).collect()}
    assert found == {i: _expected_overrides(t) for i, t in enumerate(texts)}


def test_override_tables(rows):
    maps = rows(
        "scope string, enabled boolean, predicates map<string,string>",
        ("on", True, {"contrato": "x = 1", "vazio": "", "": "y"}),
        ("off", False, {"contrato": "x = 2"}),
        ("unset", None, {"contrato": "x = 3"}),
        ("none", True, None),
    )
    assert [tuple(r) for r in override_rows(maps, ["scope"]).collect()] == [("on", "contrato", "x = 1")]
    scalars = rows(
        "scope string, source_name string, enabled boolean, predicate string",
        ("a", "s", True, "p = 1"),
        ("b", "s", True, " "),
        ("c", "s", False, "p = 2"),
    )
    assert [r["scope"] for r in override_scalars(scalars, ["scope"]).collect()] == ["a"]


def test_predicate_precedence_on_tables_and_on_the_driver(rows):
    names = "source_name string, predicate string"
    sources = rows(names, ("a", "cfg"), ("b", "cfg"), ("c", "cfg"), ("d", None), ("e", " "))
    argument = rows(names, ("a", "arg"), ("b", " "))
    control = rows(names, ("a", "ctl"), ("b", "ctl"))
    found = {
        r["source_name"]: (r["predicate_final"], r["predicate_source"])
        for r in predicate_precedence(sources, argument, control).collect()
    }
    assert found == {
        "a": ("arg", "ARGUMENT"),
        "b": ("ctl", "CONTROL_TABLE"),
        "c": ("cfg", "CONFIG"),
        "d": (None, "NONE"),
        "e": (None, "NONE"),
    }
    source = SourceSpec("v", table="a", predicate="cfg")
    assert effective_predicate(source, {"a": "arg"}, {"a": "ctl"}) == "arg"
    assert effective_predicate(source, {}, {"a": "ctl"}) == "ctl"
    assert effective_predicate(source, {"a": ""}, None) == "cfg"


INGESTION = (
    "ingestion_id string, process_name string, source_database_name string, source_table_name string, "
    "sor_database_name string, sor_table_name string, partitions map<string,string>, status string"
)


def test_required_fields(rows):
    good = ("ing_100", "seguros", "db_origem", "contrato", "sor_db", "seguros_contratos", {"d": "1"}, "PROCESSING_SOR")
    df = rows(
        INGESTION,
        good,
        (*good[:7], "LOADED_SOR"),
        (*good[:6], {}, "PROCESSING_SOR"),
        ("ing_100", None, "db_origem", None, *good[4:]),
        ("ing_101", *good[1:]),
    )
    checked = required_fields(df, F.lit("ing_100"))
    found = [(r["problems"], r["missing_fields"]) for r in checked.collect()]
    assert found == [
        ([], []),
        (["UNEXPECTED_STATUS"], []),
        (["EMPTY_PARTITIONS"], []),
        (["MISSING_FIELDS"], ["process_name", "source_table_name"]),
        (["ID_MISMATCH"], []),
    ]
    usable, rejected = split_valid(checked)
    assert (usable.count(), rejected.count()) == (1, 4)


def test_database_switch_and_grouping(spark):
    assert database_for("db", "dev", "true") == "dblocal"
    assert database_for("db", "prd", "true") == "db"
    assert database_for("db", "dev", "false") == "db"
    with pytest.raises(ValueError, match="group_size_bytes"):
        read_grouping(spark, {"group_files": "inPartition"})

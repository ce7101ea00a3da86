"""Reference dates: ``YYYYMM`` or ``YYYYMMDD`` strings and what derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_data_ref(ref: Column) -> Column:
    """Date of the reference (first of the month for ``YYYYMM``); null when invalid."""
    digits = ref.rlike("^[0-9]+$")
    return F.when(
        digits & (F.length(ref) == 6), F.try_to_date(F.concat(ref, F.lit("01")), "yyyyMMdd")
    ).when(digits & (F.length(ref) == 8), F.try_to_date(ref, "yyyyMMdd"))


def ano_data_ref(day: Column) -> Column:
    return F.year(day).cast("string")


def mes_data_ref(day: Column) -> Column:
    return F.lpad(F.month(day).cast("string"), 2, "0")


def ano_mes_data_ref(ref: Column) -> Column:
    return F.substring(ref, 1, 6)


def ano_mes_anterior(day: Column) -> Column:
    before = F.add_months(F.trunc(day, "month"), -1)
    return F.concat(ano_data_ref(before), mes_data_ref(before))


def mes_anterior(day: Column) -> Column:
    return mes_data_ref(F.add_months(F.trunc(day, "month"), -1))


def data_atual(run_date: Column | None = None) -> Column:
    """Run day as ``YYYYMMDD``. Pass the run date so that results repeat."""
    return F.date_format(F.current_date() if run_date is None else run_date, "yyyyMMdd")


def with_reference_context(df: DataFrame, ref: str, run_date: Column | None = None) -> DataFrame:
    """All reference-date columns of ``ref``; ``data_ref_valida`` marks unusable ones."""
    day = F.col("_ref_day")
    return (
        df.withColumn("_ref_day", parse_data_ref(F.col(ref)))
        .withColumns(
            {
                "data_ref_valida": day.isNotNull(),
                "ano_data_ref": ano_data_ref(day),
                "mes_data_ref": mes_data_ref(day),
                "ano_mes_data_ref": F.when(day.isNotNull(), ano_mes_data_ref(F.col(ref))),
                "ano_mes_anterior": ano_mes_anterior(day),
                "mes_anterior": mes_anterior(day),
                "data_atual": data_atual(run_date),
            }
        )
        .drop("_ref_day")
    )

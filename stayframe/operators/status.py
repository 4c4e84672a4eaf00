"""History of a categorical status: first, last, ever and switched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import first_match, flag
from stayframe.functions.timeutil import position


def status_label(value: Column, mapping: dict[str, str]) -> Column:
    """Category of a status text, NULL when the text is not mapped."""
    cases = [
        (value.isin([text for text, name in mapping.items() if name == label]), label)
        for label in dict.fromkeys(mapping.values())
    ]
    return first_match(*cases)


def status_history(events: DataFrame, by: str, mapping: dict[str, str], time: str = "charttime",
                   tie: str = "event_id", value: str = "value",
                   ignore: str = "Other/Remarks") -> DataFrame:
    """First and last category and whether each occurred.

    Unmapped texts give a NULL category but still count as first or last.
    Ignored and NULL texts do not, nor rows of unknown time. One hash
    aggregation over small codes, no window.
    """
    rows = events.filter(F.col(value) != ignore).withColumn("_label", status_label(F.col(value), mapping))
    names = list(dict.fromkeys(mapping.values()))
    code = first_match(*[(F.col("_label") == name, i) for i, name in enumerate(names)])
    place = F.expr(position(time, tie))
    rows = rows.withColumns({"_code": code, "_place": place})
    ever = [
        F.max(flag(F.col("_label") == label)).alias(label.lower())
        for label in names
    ]
    found = rows.groupBy(by).agg(
        F.min_by("_code", "_place").alias("_first"), F.max_by("_code", "_place").alias("_last"), *ever)
    return named_history(found, mapping).select(by, "firstcodestatus", "lastcodestatus", *[n.lower() for n in names])


def named_history(rows: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Names of the first and the last category in place of their codes."""
    named = F.array(*map(F.lit, dict.fromkeys(mapping.values())))
    return rows.withColumns({
        "firstcodestatus": F.get(named, F.col("_first")), "lastcodestatus": F.get(named, F.col("_last"))}).drop("_first", "_last")


def switch_flags(history: DataFrame) -> DataFrame:
    """Status on admission and later switches; 0 when the first status is unknown."""
    first = F.col("firstcodestatus")
    to_dnr = (first != "DNR") & (F.col("dnr") == 1)
    to_cmo = (first != "CMO") & (F.col("cmo") == 1)
    return history.withColumns({
        "dnr_adm_flg": flag(first == "DNR"),
        "dnr_switch_flg": flag(to_dnr),
        "cmo_switch_flg": flag(to_cmo),
        "dnr_cmo_switch_flg": flag(to_dnr | to_cmo),
    })

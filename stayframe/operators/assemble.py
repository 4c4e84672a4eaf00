"""Star assembly of per-stay and per-admission views onto the cohort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from stayframe.operators.scale import assert_unique


@dataclass(frozen=True)
class View:
    """A view to attach: its rows, its key and which columns to take under which names.

    ``df`` may be None for an optional input; its columns are then typed NULLs
    (``types``, default double).
    """

    name: str
    df: DataFrame | None
    key: str
    columns: dict[str, str]
    types: dict[str, str] | None = None


def assemble(cohort: DataFrame, views: list[View], keep: list[str], exclude: list[str] = (),
             check: bool = False, unique: str | None = None) -> DataFrame:
    """Cohort rows with the views' columns, without the rows whose exclusion flag is set.

    Views are joined key by key, so the cohort is shuffled at most once per
    key. A missing exclusion flag counts as 0. A view with a repeated key would multiply
    rows: ``check`` looks at each view first, in a job of its own; ``unique`` names the
    cohort's key and fails while the result is made, which costs one window over it.
    """
    joined = cohort
    for view in sorted(views, key=lambda v: v.key):
        if view.df is None:
            nulls = {
                new: F.lit(None).cast((view.types or {}).get(old, "double"))
                for old, new in view.columns.items()
            }
            joined = joined.withColumns(nulls)
            continue
        if check:
            assert_unique(view.df, view.key, view.name)
        taken = view.df.select(view.key, *[F.col(o).alias(n) for o, n in view.columns.items()])
        joined = joined.join(taken, view.key, "left")
    if unique:
        once = F.count("*").over(W.partitionBy(unique)) == 1
        repeated = F.raise_error(F.concat(F.lit(f"a view has more than one row for {unique} "), F.col(unique).cast("string")))
        joined = joined.withColumn("_once", F.when(once, True).otherwise(repeated.cast("boolean")))
        joined = joined.filter("_once").drop("_once")
    for name in exclude:
        joined = joined.filter(F.coalesce(F.col(name), F.lit(0)) == 0)
    return joined.select(*keep)

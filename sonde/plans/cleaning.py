"""The two cleaning chains."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.cluster import staged
from sonde.functions import binary_target, col, composite_id
from sonde.operators import impute, series, tables


@dataclass(frozen=True)
class Layout:
    """Names of the special columns of an observation table."""

    series: str = "Instance"
    order: tuple[str, ...] = ("timestamp",)
    label: str = "label"
    well: str = "well"
    series_id: str = "id"
    klass: str = "class"
    state: str = "state"


def clean_instances(df: DataFrame, empty: Sequence[str], fill: Sequence[str],
                    layout: Layout = Layout(), rows_per_chunk: int | None = None) -> DataFrame:
    """Drop the empty columns and fill gaps inside each instance."""
    return series.ffill_bfill(df.drop(*empty), fill, [layout.series], list(layout.order),
                              rows_per_chunk)


def clean_and_impute(df: DataFrame, empty: Sequence[str], continuous: Sequence[str],
                     categorical: Sequence[str], layout: Layout = Layout(),
                     rows_per_chunk: int | None = None) -> DataFrame:
    """Fill inside instances, add the binary target and missing flags, impute what is left.

    The filled table is written once: two passes for statistics and the result read it.
    """
    fill = [*continuous, *categorical]
    filled = staged(clean_instances(df, empty, fill, layout, rows_per_chunk))
    flagged = tables.missing_flags(
        filled.withColumn("target", binary_target(col(layout.klass))), fill)
    means = impute.fit_continuous(flagged, continuous)
    modes = impute.fit_categorical(flagged, categorical)
    return impute.Imputer({**means.values, **modes.values}).transform(flagged)


def clean_whole_series(parts: Sequence[DataFrame], fill: Sequence[str],
                       layout: Layout = Layout(), min_present: float = 0.5,
                       rows_per_chunk: int | None = None) -> DataFrame:
    """Union the sources, keep only well-covered columns and series, and repair the classes.

    The filled table feeds three later steps, so it is written once.
    """
    every = tables.union_aligned(*parts)
    named = every.withColumn(layout.series_id, composite_id(
        col(layout.well), col(layout.series_id), col(layout.label)))
    key, order = [layout.series_id], list(layout.order)
    filled = staged(series.ffill_bfill(named, fill, key, order, rows_per_chunk))
    dense = tables.drop_sparse_columns(filled, min_present)
    whole = tables.drop_incomplete_instances(
        dense, layout.series_id, [c for c in dense.columns if c not in (layout.klass,
                                                                         layout.state)])
    return impute.class_repair(whole, key, order, layout.klass, layout.state, layout.label,
                               rows_per_chunk).drop(layout.state)

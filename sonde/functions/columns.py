"""Column expressions shared by the operators.  All are Spark built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonde.reference import EVENT_CLASSES


def col(name: str) -> Column:
    """Column by exact name; quoted, so hyphenated sensor tags are safe."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type has NaN (``isnan`` on other types fails under ANSI mode)."""
    value = col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN as null, so that both count as missing."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col(name)), col(name)).alias(name)
    return col(name)


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
           ) -> DataFrame:
    """Join on null-safe equality of ``keys`` and append the other columns of ``right``."""
    a, b = left.alias("l"), right.alias("r")
    on = None
    for key in keys:
        term = F.col(f"l.`{key}`").eqNullSafe(F.col(f"r.`{key}`"))
        on = term if on is None else on & term
    joined = a.join(b, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("l.*", *[F.col(f"r.`{c}`") for c in right.columns if c not in keys])


def key_or_unknown(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit("Unknown"))


def md5_of(keys: Sequence[str], seed: int = 42) -> Column:
    """Repeatable random order: md5 of the key text and a seed."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def binary_target(klass: Column) -> Column:
    """1 for event classes, 0 for every other class and for null."""
    return F.when(klass.isin(EVENT_CLASSES), F.lit(1)).otherwise(F.lit(0))


def multiclass_target(klass: Column) -> Column:
    """The class where it is an event class, else 0 (also for null)."""
    return F.when(klass.isin(EVENT_CLASSES), klass).otherwise(F.lit(0)).cast("int")


def normal_flag(klass: Column) -> Column:
    return F.when(klass == 0, F.lit(1)).otherwise(F.lit(0))


def composite_id(well: Column, series_id: Column, label: Column) -> Column:
    """Simulated and drawn ids repeat across labels; make them unique with a prefix and the label."""
    text = series_id.cast("string")
    return F.when(
        well.isin("SIMULATED", "DRAWN"), F.concat_ws(" - ", well, text, label.cast("string"))
    ).otherwise(text)


def value_type(unique_count: Column, tag: Column) -> Column:
    """Kind of a column from its distinct count and its name; the first rule that fits wins."""
    return (
        F.when(unique_count == 0, "Empty")
        .when(unique_count <= 3, "Categorical")
        .when(tag.isin("label", "class", "state"), "Classifier")
        .when(F.lower(tag).isin("well", "id", "instance"), "Identifier")
        .when(tag.isin("DataType", "data_type"), "Dataset")
        .when(tag.isin("timestamp", "ts"), "Timestamp")
        .otherwise("Continuous")
    )

"""Profiles of a table: distinct and missing values, cross-tabulations, histograms, duplicates.

Results are long (one row per group and column) unless a function says otherwise; wide forms
take an explicit list of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.cluster import BROADCAST_ROWS, checkpointed, small_side, staged
from sonde.functions import col, is_missing, key_or_unknown, lookup, present, value_type
from sonde.operators.quantiles import exact_quantiles
from sonde.operators.series import position
from sonde.operators.tables import numeric_columns

DISTINCT_PER_PASS = 10
HOT_ROWS = 1_000_000


def _long(df: DataFrame, keys: Sequence[str], cols: Sequence[str], value: str) -> DataFrame:
    return df.unpivot([col(k) for k in keys], [col(c) for c in cols], "Tag", value)


def missing_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
               digits: int | None = 1, name: str = "missing_pct") -> DataFrame:
    """Percent of null or NaN per group and column: one aggregate for all columns."""
    def share(c: str) -> Column:
        pct = F.try_divide(F.count(F.when(is_missing(df, c), 1)) * F.lit(100.0), F.count("*"))
        return (pct if digits is None else F.round(pct, digits)).alias(c)

    one = df.groupBy(*[col(k) for k in keys]).agg(*[share(c) for c in cols])
    # Without keys an empty table still gives one row; its shares are null.
    return _long(one, keys, cols, name)


def distinct_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                name: str = "unique_values", approximate: bool = False) -> DataFrame:
    """Distinct non-null values per group and column.

    Each exact distinct count multiplies the rows of its aggregate, so columns go in passes of
    ten; passes read disjoint columns of a columnar file.
    """
    count = F.approx_count_distinct if approximate else F.countDistinct
    step = len(cols) if approximate else DISTINCT_PER_PASS
    out = None
    for start in range(0, len(cols), step):
        batch = list(cols[start:start + step])
        one = df.groupBy(*[col(k) for k in keys]).agg(*[count(col(c)).alias(c) for c in batch])
        part = _long(one, keys, batch, name)
        out = part if out is None else out.unionByName(part)
    return out


def tag_table(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: a reference table without names and units."""
    return df.sparkSession.createDataFrame([(c,) for c in df.columns], "Tag string")


def unique_values_table(ref: DataFrame, df: DataFrame, name: str,
                        absent: int | None = None) -> DataFrame:
    """Reference table plus the distinct count of every tag; ``absent`` for unknown tags."""
    counts = distinct_by(df, [], df.columns, name)
    out = ref.join(F.broadcast(counts), "Tag", "left")  # one row per column
    return out if absent is None else out.withColumn(name, F.coalesce(col(name), F.lit(absent)))


def missing_values_table(ref: DataFrame, df: DataFrame, name: str, digits: int | None = 1,
                         absent: float | None = None) -> DataFrame:
    """Reference table plus the percent missing of every tag; ``absent`` for unknown tags."""
    shares = missing_by(df, [], df.columns, digits, name)
    out = ref.join(F.broadcast(shares), "Tag", "left")  # one row per column
    return out if absent is None else out.withColumn(name, F.coalesce(col(name), F.lit(absent)))


def value_type_table(df: DataFrame, name: str = "unique_values") -> DataFrame:
    """Distinct count and kind of every column."""
    return distinct_by(df, [], df.columns, name).withColumn(
        "value_type", value_type(col(name), F.col("Tag")))


def spread(long: DataFrame, row: Sequence[str], across: str, values: Sequence, value: str,
           prefix: str = "", fill=None) -> DataFrame:
    """Pivot a long profile over a given list of values of ``across``."""
    def cell(v) -> Column:
        picked = F.first(F.when(col(across) == F.lit(v), col(value)), ignorenulls=True)
        return (picked if fill is None else F.coalesce(picked, F.lit(fill))).alias(f"{prefix}{v}")

    return long.groupBy(*[col(r) for r in row]).agg(*[cell(v) for v in values])


def compare_identifiers(df: DataFrame, label: str, identifiers: Sequence[str]) -> DataFrame:
    """Distinct count of several identifiers per label, in one aggregate."""
    return df.groupBy(col(label)).agg(*[F.countDistinct(col(i)).alias(i) for i in identifiers])


def identifier_delta(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """Two distinct counts per label, their difference, and the totals of the three."""
    counts = df.groupBy(key_or_unknown(label).alias("key")).agg(
        F.countDistinct(col(first)).alias("a"), F.countDistinct(col(second)).alias("b"))
    return counts.rollup("key").agg(
        F.grouping("key").alias("_g"), F.sum("a").alias(first), F.sum("b").alias(second),
        F.sum(F.col("a") - F.col("b")).alias("Delta"),
    ).select(F.when(F.col("_g") == 1, "Grand Total").otherwise(F.col("key")).alias(label),
             col(first), col(second), "Delta")


def distinct_cells(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Distinct ``count`` per combination of keys; null keys are 'Unknown'."""
    return df.groupBy(*[key_or_unknown(k).alias(k) for k in keys]).agg(
        F.countDistinct(col(count)).alias("n"))


def found_values(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The keys of a column in order, 'Unknown' for null; an error when there are over ``most``."""
    rows = df.select(key_or_unknown(column).alias("v")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values: list those to show")
    return sorted(r["v"] for r in rows)


def crosstab_distinct(df: DataFrame, row: str, column: str, count: str,
                      values: Sequence[str] | None = None, totals: bool = False,
                      within: Sequence[str] = (), other: str | None = None) -> DataFrame:
    """Distinct ``count`` by row and column, 0 where empty.

    Without ``values`` there is a column for every value found.  With a list, ``other`` names a
    column that adds up the values which are not listed; rows and totals hold them in any case.

    ``totals`` adds a Row Total and a Grand Total row.  Both add up the cells; they are not
    distinct counts of the union.
    """
    values = found_values(df, column) if values is None else list(values)
    cells = distinct_cells(df, [*within, row, column], count)
    sums = [F.coalesce(F.sum(F.when(col(column) == v, F.col("n"))), F.lit(0)).alias(v)
            for v in values]
    if other is not None:
        sums.append(F.coalesce(F.sum(F.when(~col(column).isin(values), F.col("n"))), F.lit(0))
                    .alias(other))
    if not totals:
        return cells.groupBy(*[col(w) for w in within], col(row)).agg(*sums)
    return cells.rollup(col(row)).agg(
        F.grouping(col(row)).alias("_g"), *sums, F.sum("n").alias("Row Total")
    ).select(F.when(F.col("_g") == 1, "Grand Total").otherwise(col(row)).alias(row),
             *[col(v) for v in [*values, *([other] if other is not None else [])]], "Row Total")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(col(column)).agg(F.count("*").alias("n"))


def share_of(counts: DataFrame, value: str, total: DataFrame, name: str,
             digits: int | None = None, scale: float = 1.0) -> DataFrame:
    """Add ``value`` as a share of ``total``, a table of one row and column."""
    share = F.try_divide(col(value) * F.lit(scale), total.scalar())
    return counts.withColumn(name, share if digits is None else F.round(share, digits))


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    counts = checkpointed(value_counts(df, column))
    return share_of(counts, "n", counts.agg(F.sum("n")), "share")


def value_counts_by_source(df: DataFrame, column: str, source: str, values: Sequence[str]
                           ) -> DataFrame:
    """Rows per value and source, 0 where absent; the total counts rows of other sources too."""
    cells = [F.count(F.when(col(source) == v, 1)).alias(v) for v in values]
    return df.groupBy(col(column)).agg(*cells, F.count("*").alias("Total"))


def source_share(df: DataFrame, source: str, series: str) -> DataFrame:
    """Share of rows and of series by source, in whole percent."""
    counts = checkpointed(df.groupBy(col(source)).agg(
        F.count("*").alias("n_rows"), F.countDistinct(col(series)).alias("n_ids")))
    with_rows = share_of(counts, "n_rows", counts.agg(F.sum("n_rows")), "row_pct", 0, 100.0)
    return share_of(with_rows, "n_ids", counts.agg(F.sum("n_ids")), "id_pct", 0, 100.0)


def data_overview(df: DataFrame, series: str) -> DataFrame:
    """Rows, columns by kind, and distinct series, as one row."""
    numeric = len(numeric_columns(df))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(len(df.columns) - numeric).cast("bigint").alias("n_other"),
        F.lit(numeric).cast("bigint").alias("n_numeric"),
        F.countDistinct(col(series)).alias("n_ids"))


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int = 6,
                     rows_per_chunk: int | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max: one row per column.

    Exact quartiles count every distinct value; approximate ones ride on the same aggregate.
    Null and NaN are missing values, and are left out of every statistic.
    """
    df = df.select(*[present(df, c) for c in cols])
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if not exact:
        stats |= {f"q{i}": (lambda c, p=p: F.percentile_approx(c, p, 10_000))
                  for i, p in enumerate((0.25, 0.5, 0.75))}
    packed = df.agg(*[
        F.struct(*[f(col(c)).cast("double").alias(s) for s, f in stats.items()]).alias(c)
        for c in cols
    ])
    rows = _long(packed, [], cols, "s").select("Tag", "s.*")
    if exact:
        quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], rows_per_chunk)
        rows = rows.join(F.broadcast(quartiles), "Tag", "left")  # one row per column
    return rows.select("Tag", F.col("count").cast("bigint").alias("n"), *[
        F.round(F.col(c), digits).alias(o) for c, o in (
            ("mean", "mean"), ("std", "std"), ("min", "min"), ("q0", "p25"), ("q1", "p50"),
            ("q2", "p75"), ("max", "max"))])


def histogram_bins(df: DataFrame, cols: Sequence[str], group: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram of every column per group; the last bin is closed.

    Null and NaN are left out.  A column with a single value gets a range of width 1 around it.
    """
    df = df.select(col(group), *[present(df, c) for c in cols])
    ranges = df.groupBy(col(group)).agg(*[
        F.struct(F.min(col(c)).cast("double").alias("lo"),
                 F.max(col(c)).cast("double").alias("hi")).alias(c) for c in cols])
    ranges = small_side(_long(ranges, [group], cols, "r").select(col(group), "Tag", "r.*"))
    values = _long(df.select(col(group), *[col(c).cast("double").alias(c) for c in cols]),
                   [group], cols, "v").filter("v IS NOT NULL")
    flat = F.col("lo") == F.col("hi")
    lo = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / F.lit(float(bins))
    slot = F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).cast("bigint")
    return (lookup(values, ranges, [group, "Tag"])
            .groupBy(col(group), "Tag", slot.alias("bin")).agg(F.count("*").alias("n")))


def duplicate_count(df: DataFrame, exclude: Sequence[str] = (), by: Sequence[str] = ()
                    ) -> DataFrame:
    """Rows beyond the first of each set of equal rows (nulls are equal)."""
    cols = [c for c in df.columns if c not in set(exclude)]
    groups = df.groupBy(*[col(c) for c in cols]).agg(F.count("*").alias("_n"))
    return groups.groupBy(*[col(b) for b in by]).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_rows(df: DataFrame, exclude: Sequence[str] = (), hot_rows: int = HOT_ROWS
                   ) -> DataFrame:
    """Every row that has an equal twin outside ``exclude``.

    Repeated keys are found by an aggregate and joined back.  A key with more than ``hot_rows``
    copies would put them all into one task of that join, so such keys (at most one per
    ``hot_rows`` rows of the table) are matched by broadcast instead.
    """
    cols = [c for c in df.columns if c not in set(exclude)]
    groups = df.groupBy(*[col(c) for c in cols]).agg(F.count("*").alias("_n"))
    hot = checkpointed(groups.filter(F.col("_n") > hot_rows).drop("_n"))
    n_hot = hot.count()
    some = groups.filter((F.col("_n") > 1) & (F.col("_n") <= hot_rows)).drop("_n")
    if n_hot == 0:
        return lookup(df, some, cols, "left_semi")
    hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    rest = lookup(lookup(df, hot, cols, "left_anti"), some, cols, "left_semi")
    return rest.unionByName(lookup(df, hot, cols, "left_semi"))


def null_audit(df: DataFrame, cols: Sequence[str], label: str, well: str) -> DataFrame:
    """Per column with nulls: how many, and in which labels and wells."""
    empty = F.filter(F.array(*[F.when(is_missing(df, c), F.lit(c)) for c in cols]),
                     lambda t: t.isNotNull())
    cells = (df.select(col(label), col(well), F.explode(empty).alias("Tag"))
             .groupBy("Tag", col(label), col(well)).agg(F.count("*").alias("n")))
    return cells.groupBy("Tag").agg(
        F.sum("n").alias("n_null"),
        F.array_join(F.sort_array(F.collect_set(col(label))).cast("array<string>"), ",")
        .alias("labels"),
        F.array_join(F.sort_array(F.collect_set(col(well))), ",").alias("wells"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.count(F.when(is_missing(df, c), 1)).alias(c) for c in cols])
    return _long(one, [], cols, "n_null")


def label_hist_by_id(df: DataFrame, source: str, series: str, label: str, by_id_only: str
                     ) -> DataFrame:
    """Number of series by mean label: per id in one source, per (id, label) in the others."""
    extra = F.when(col(source) != by_id_only, col(label))
    per = df.groupBy(col(source), col(series), extra.alias("_x")).agg(
        F.round(F.avg(col(label)), 6).alias("mean_label"))
    return per.groupBy(col(source), "mean_label").agg(F.count("*").alias("n"))


def instance_intervals(df: DataFrame, series: str, ts: str) -> DataFrame:
    """First and last instant of each series, its length in hours and its first year."""
    spans = df.groupBy(col(series)).agg(F.min(col(ts)).alias("start_ts"),
                                        F.max(col(ts)).alias("end_ts"))
    return spans.withColumns({
        "hours": F.timestamp_diff("MICROSECOND", F.col("start_ts"), F.col("end_ts"))
        / F.lit(3.6e9),
        "year": F.year("start_ts").cast("bigint")})


def instance_positions(df: DataFrame, series: str, ts: str, name: str = "position") -> DataFrame:
    """Place of every series by its first instant, counted from 0."""
    spans = df.groupBy(col(series)).agg(F.min(col(ts)).alias("start_ts"))
    return position(staged(spans), [], ["start_ts", series], name)


def retention_report(before: DataFrame, after: DataFrame, series: str, klass: str) -> DataFrame:
    """Distinct series before and after cleaning, and those left with a null class."""
    sides = before.select(F.lit("before").alias("stage"), col(series), col(klass)).unionByName(
        after.select(F.lit("after").alias("stage"), col(series), col(klass)))
    return sides.groupBy("stage").agg(
        F.countDistinct(col(series)).alias("n_ids"),
        F.countDistinct(F.when(col(klass).isNull(), col(series))).alias("n_null_class"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-null value; the smallest one on a tie."""
    counts = value_counts(df.filter(col(column).isNotNull()), column)
    return counts.orderBy(F.col("n").desc(), col(column)).limit(1)

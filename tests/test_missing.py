"""NaN counts as missing wherever null does; splits and tables keep every row."""

import math

import pytest

from sonde.operators import impute, profile, series, split, tables

NAN = float("nan")


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, 1, 1.0), (1, 2, NAN), (1, 3, None), (1, 4, 3.0), (2, 1, NAN), (2, 2, 2.0)]
    return spark.createDataFrame(rows, "k int, t int, v double")


def test_imputed_values_ignore_nan(gaps):
    for fitted, want in ((impute.fit_continuous(gaps, ["v"]), 2.0),
                         (impute.fit_continuous(gaps, ["v"], "median"), 2.0),
                         (impute.fit_categorical(gaps, ["v"]), 1.0)):
        assert fitted.values["v"] == want
        out = [r["v"] for r in fitted.transform(gaps).collect()]
        assert None not in out and not any(map(math.isnan, out))


def test_fills_and_flags_treat_nan_as_null(gaps):
    got = series.ffill_bfill(gaps, ["v"], ["k"], ["t"]).orderBy("k", "t").collect()
    assert [r["v"] for r in got] == [1.0, 1.0, 1.0, 3.0, 2.0, 2.0]
    flags = tables.missing_flags(gaps, ["v"]).orderBy("k", "t").collect()
    assert [r["v_missing"] for r in flags] == [0, 1, 1, 0, 1, 0]


def test_statistics_ignore_nan(gaps):
    row = profile.describe_numeric(gaps, ["v"]).first()
    assert (row["n"], row["mean"], row["min"], row["max"]) == (3, 2.0, 1.0, 3.0)
    bins = profile.histogram_bins(gaps, ["v"], "k", 2).collect()
    assert sum(r["n"] for r in bins) == 3 and {r["bin"] for r in bins if r["k"] == 1} == {0, 1}


def test_hash_shares_are_not_rounded(spark):
    df = spark.range(200_000)
    assert 2 <= split.hash_sample(df, ["id"], 0.00004).count() <= 20
    test = split.hash_split(df, ["id"], 0.996).filter("split = 'test'").count()
    assert 650 <= test <= 950


def test_crosstab_keeps_values_that_are_not_listed(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", None, 3), ("c", "z", 4)],
                               "r string, c string, n int")
    got = {r["r"]: r for r in
           profile.crosstab_distinct(df, "r", "c", "n", ["x"], True, other="Other").collect()}
    assert set(got) == {"a", "b", "c", "Grand Total"}
    assert (got["Grand Total"]["x"], got["Grand Total"]["Other"],
            got["Grand Total"]["Row Total"]) == (1, 3, 4)
    found = profile.crosstab_distinct(df, "r", "c", "n")
    assert found.columns == ["r", "Unknown", "x", "y", "z"]
    with pytest.raises(ValueError):
        profile.found_values(df, "c", 2)
    total = profile.value_counts_by_source(df, "r", "c", ["x"]).agg({"Total": "sum"}).first()[0]
    assert total == 4

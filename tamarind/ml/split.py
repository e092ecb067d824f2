"""Date splits and cohort slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date

TEST_AGE = 5  # months


def split_by_date(
    df: DataFrame, date_col: str, end_train: DateLike, end_dev: DateLike, end_test: DateLike,
    activation_col: str = "activation_date", age_col: str = "age_month", by_activation: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train up to the first date, dev up to the second, test up to the third.

    ``by_activation`` tests merchants activated in the test window at an age of
    five months instead; these may overlap the training rows. Rows without a
    date are in no part.
    """
    d1, d2, d3 = (F.lit(as_date(d)) for d in (end_train, end_dev, end_test))
    day = F.col(date_col).cast("date")
    if by_activation:
        act = F.col(activation_col).cast("date")
        test = (act > d2) & (act <= d3) & (F.col(age_col) == TEST_AGE)
    else:
        test = (day > d2) & (day <= d3)
    return df.where(day <= d1), df.where((day > d1) & (day <= d2)), df.where(test)


def local_rows(df: DataFrame, cohort: str = "cohort") -> DataFrame:
    return df.where(F.col(cohort).eqNullSafe(F.lit(0)))


def enterprise_rows(df: DataFrame, cohort: str = "cohort") -> DataFrame:
    """All other rows, those without a cohort included."""
    return df.where(~F.col(cohort).eqNullSafe(F.lit(0)))


COHORT_SLICES = {"_local": local_rows, "_ent": enterprise_rows}

"""Reading and writing tables, and dated backfills."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tamarind.functions.exprs import DateLike, as_date, checked_name
from tamarind.plans import enterprise, geography, scoring_features, search
from tamarind.plans.labels import HISTORY_FROM
from tamarind.plans.population import SNAPSHOTS_AFTER
from tamarind.sources.dated import DatedTable
from tamarind.sources.tables import Tables, normalise

BATCH_ROWS = 1_000_000


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def run_query(spark: SparkSession, text: str, test_date: DateLike | None = None, **args) -> DataFrame:
    """Run a query with named parameters (``:test_date`` and others).

    Values are bound, never pasted into the text.
    """
    if test_date is not None:
        args["test_date"] = as_date(test_date)
    return lower_names(spark.sql(text, args=args or None))


def write_table(
    df: DataFrame, name: str, mode: str = "append", partition_by: Sequence[str] = (), path: str | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Append to, or overwrite, a catalog table; ``path`` makes it external."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.saveAsTable(checked_name(name))


def upload(
    df: DataFrame, name: str, schema: StructType | str | None = None, mode: str = "overwrite", path: str | None = None
) -> None:
    """Write with a declared schema; names and types are brought to it first."""
    if schema is not None:
        df = normalise(df, StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    write_table(df, name, mode, path=path)


def batch_upload(
    df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, mode: str = "append", path: str | None = None
) -> None:
    """One distributed write whose files hold at most ``batch_rows`` rows."""
    write_table(df, name, mode, path=path, rows_per_file=batch_rows)


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a table from a query."""
    write_table(df, name, "overwrite", path=path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {checked_name(name)}")


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str] = ("create_date",), clear: Iterable[str] = ()
) -> None:
    """Replace exactly the partitions that ``df`` holds, and empty those of
    ``clear``; all of it or, where the job fails, nothing.

    Running the same job again leaves the same rows.
    """
    DatedTable(df.sparkSession, path, by).replace(df, clear, 5 * BATCH_ROWS)


def read_dated(spark: SparkSession, path: str, like: DataFrame, by: Sequence[str] = ("create_date",)) -> DataFrame:
    """Read a dated table with the types it was written with."""
    return DatedTable(spark, path, by).read(like.schema)


# Feature backfills -----------------------------------------------------------

Builder = Callable[[Tables, Sequence[DateLike]], DataFrame]


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("created_date", "create_date")


def search_backfill(features: DataFrame) -> Builder:
    """Search features for the merchants of a daily feature table."""
    return lambda tables, dates: search.daily_table(
        tables, features.where(F.col("create_date").isin([as_date(d) for d in dates])), dates
    )


def adjustment_backfill(predictions: DataFrame) -> Builder:
    """Enterprise-adjusted predictions of the dates."""

    def build(tables: Tables, dates: Sequence[DateLike]) -> DataFrame:
        rows = predictions.where(F.col("create_date").isin([as_date(d) for d in dates]))
        sales = [enterprise.chain_sales(tables, dates, g) for g in ("starting_point", "submarket", "global")]
        return enterprise.adjust_predictions(tables, rows, *sales)

    return build


def feature_builders(
    history_from: DateLike = HISTORY_FROM, snapshots_after: DateLike = SNAPSHOTS_AFTER
) -> Mapping[str, Builder]:
    """The dated feature tables by name."""
    since, after = as_date(history_from), as_date(snapshots_after)

    def danp(aov: bool) -> Builder:
        return lambda t, d: scoring_features.danp_features(t, d, aov, since, after)

    return {
        "submarket_week": lambda t, d: geography.week_stats(t, d, "submarket"),
        "starting_point_week": lambda t, d: geography.week_stats(t, d, "starting_point"),
        "enterprise_starting_point": lambda t, d: _dated(enterprise.chain_sales(t, d, "starting_point")),
        "enterprise_submarket": lambda t, d: _dated(enterprise.chain_sales(t, d, "submarket")),
        "enterprise_global": lambda t, d: _dated(enterprise.chain_sales(t, d, "global")),
        "danp": danp(False),
        "nn": lambda t, d: scoring_features.nn_features(t, d),
        "aov_danp": danp(True),
        "aov_nn": lambda t, d: scoring_features.nn_features(t, d, aov=True),
    }


def backfill(
    tables: Tables, feature: str | Builder, dates: Iterable[DateLike], path: str
) -> DataFrame:
    """Build a feature for all dates in one job and replace those partitions."""
    wanted = sorted({as_date(d) for d in dates})
    build = feature_builders()[feature] if isinstance(feature, str) else feature
    rows = build(tables, wanted)
    # A date that has no rows any more must not keep its old ones.
    replace_partitions(rows, path, clear=[f"create_date={d.isoformat()}" for d in wanted])
    return read_dated(rows.sparkSession, path, rows)

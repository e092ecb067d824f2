"""Jobs that write label, prediction and metric tables."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date
from tamarind.plans import labels, ranking
from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables
from tamarind.sources.warehouse import read_dated, replace_partitions

LOOKBACK_DAYS = 30 + 1


def generate_labels(
    tables: Tables, start: DateLike, end: DateLike, nn_path: str, danp_path: str,
    activated_from: DateLike = labels.ACTIVATED_FROM,
) -> tuple[DataFrame, DataFrame]:
    """Write both monthly label tables for a range of sales dates; the load is
    dated by the end of the range."""
    spark = tables.deliveries.sparkSession
    out = []
    for build, path in ((labels.nn_monthly_label, nn_path), (labels.danp_monthly_label, danp_path)):
        rows = build(tables, start, end, activated_from)
        replace_partitions(rows, path)
        out.append(read_dated(spark, path, rows))
    return out[0], out[1]


def publish_predictions(
    score: Callable[[dt.date], DataFrame | None], dates: Iterable[DateLike], raw_path: str, deduped_path: str
) -> tuple[DataFrame, DataFrame] | None:
    """Score each date and write the raw and the deduplicated predictions.

    Dates the scorer has nothing for are left out.
    """
    scored = []
    for d in sorted({as_date(d) for d in dates}):
        rows = score(d)
        if rows is not None:
            scored.append(rows.withColumn("create_date", F.lit(d)))
    if not scored:
        return None
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scored)
    replace_partitions(raw, raw_path)
    written = read_dated(raw.sparkSession, raw_path, raw)
    deduped = ranking.dedupe_predictions(written)
    replace_partitions(deduped, deduped_path)
    return written, read_dated(raw.sparkSession, deduped_path, deduped)


def metric_table_names(table: str, model_version: str, factor: float = 1, suffix: str = "") -> dict[str, str]:
    """Names of the three metric tables; only v1 tables carry the version."""
    head = f"{table}_{model_version}" if model_version == "v1" else table
    tail = f"5thmonth_projected_factor_{str(factor).replace('.', '_')}{suffix}"
    return {
        "predicted": f"{head}_decile_df_{tail}",
        "actual": f"{head}_decile_actual_df_{tail}",
        "combined": f"{head}_decile_data_for_metrics_{tail}",
    }


def publish_metrics(
    tables: Tables,
    predictions: DataFrame,
    danp_labels: DataFrame,
    nn_labels: DataFrame,
    current_dates: Iterable[DateLike],
    root: str,
    table: str = "performance",
    model_version: str = "v2",
    pred: str = "pred",
    actual: str = "actual",
    factor: float = 1,
    suffix: str = "",
    lookback_days: int = LOOKBACK_DAYS,
    include_partner: bool = True,
    status_as_of: str = "table_max",
) -> dict[str, DataFrame]:
    """Rank predicted and actual market sizes of each evaluation date's
    prediction date, and write the ranks and their combination.

    All dates are one plan and one write for each of the three tables; a date
    without market sizes leaves no rows.
    """
    currents = sorted({as_date(d) for d in current_dates})
    days = {d: d for d in (c - dt.timedelta(days=lookback_days) for c in currents)}
    full = cut_lineage(
        ranking.predictions_with_actuals(
            tables, predictions, days, danp_labels, nn_labels, actual=actual, pred=pred, factor=factor
        ),
        "predictions-full",
    )
    ranks = {}
    for kind, value in (("predicted", pred), ("actual", "actual")):
        size = ranking.market_size_on(tables, full, days, value, status_as_of).withColumnRenamed(ranking.ON, "pred_date")
        ranks[kind] = ranking.decile_rank(size, include_partner=include_partner)
    both = ranking.combine_ranks(ranks["actual"], ranks["predicted"], full, dated=True)
    current = F.date_add("pred_date", lookback_days).alias("create_date")
    out = {}
    for kind, name in metric_table_names(table, model_version, factor, suffix).items():
        rows = {**ranks, "combined": both}[kind].select("*", current)
        path = os.path.join(root, name)
        replace_partitions(rows, path, clear=[f"create_date={c.isoformat()}" for c in currents])
        out[kind] = read_dated(rows.sparkSession, path, rows)
    return out

"""Category distribution report and statistics text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatio import defaults as D


def category_counts(df: DataFrame, group_col: str) -> DataFrame:
    """A4/G1: rows per category (map-side combined)."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias("count"))


def distribution(df: DataFrame, group_col: str, tie_col: str | None = None,
                 top_n: int = D.TOP_SLICES, precision: int = 6) -> DataFrame:
    """``group, count, percentage, rank, is_top``; rank by count
    descending, ties by ``tie_col`` (or the group value). The windows run
    over the per-category aggregate (one row per category), never over rows.
    An empty corpus gives an empty report; percentage is null when the total
    is 0 (no division by zero)."""
    counts = category_counts(df, group_col)
    if tie_col is not None:
        ties = df.groupBy(group_col).agg(F.min(tie_col).alias("_tie"))
        counts = counts.join(ties, group_col)
    else:
        counts = counts.withColumn("_tie", F.col(group_col))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    rank = F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("_tie").asc()))
    out = counts.select(group_col, "count",
                        F.round(F.try_divide(F.col("count") * 100.0, total), precision)
                        .alias("percentage"),
                        rank.cast("long").alias("rank"))
    return out.withColumn("is_top", F.col("rank") <= top_n)


def stats_lines(df: DataFrame, group_col: str, fmt: str = D.STATS_LINE_FORMAT) -> DataFrame:
    """W5 text: one ``"{category}: {count}条"`` line per category."""
    return category_counts(df, group_col).select(_stats_line(group_col, fmt))


def _stats_line(group_col: str, fmt: str):
    return F.format_string(fmt, F.col(group_col), F.col("count")).alias("value")


def stats_text(df: DataFrame, group_col: str, order_col, fmt: str = D.STATS_LINE_FORMAT,
               header: str = D.STATS_HEADER) -> DataFrame:
    """The whole statistics text as rows in one sorted partition: the header,
    then the categories in the order of their first rows by ``order_col`` (a
    name or an expression). One row a category is sorted, after a map-side
    combined aggregate."""
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    lines = (df.groupBy(group_col).agg(F.count(F.lit(1)).alias("count"), F.min(order).alias("_first"))
             .select(_stats_line(group_col, fmt), F.lit(1).alias("_part"), "_first"))
    top = df.sparkSession.range(1).select(F.lit(header).alias("value"), F.lit(0).alias("_part"))
    return (top.unionByName(lines, allowMissingColumns=True).coalesce(1)
            .sortWithinPartitions("_part", "_first", "value").select("value"))

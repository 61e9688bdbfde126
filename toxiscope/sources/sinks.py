"""Sinks: metrics and scores as columnar files; the reference's text rendering on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_frame(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a result frame. The default refuses an existing folder, like the reference."""
    df.write.mode(mode).format(fmt).save(path)


def render_metrics(metrics: DataFrame, digits: int | None = None) -> DataFrame:
    """Metrics frame → text lines ``(label, metric, "v0 | v1")``, class 0 then class 1.

    Accuracy has a single value (stored for both classes) and is rendered once.
    ``digits`` fixes the decimals. Missing values (a class absent from the true labels) render as ``NaN``.
    """
    shown = F.col("value").cast("string") if digits is None else F.format_string(f"%.{digits}f", "value")
    val = F.when(F.col("value").isNull(), F.lit("NaN")).otherwise(shown)
    grouped = metrics.groupBy("label", "metric").agg(
        F.array_sort(F.collect_list(F.struct("class", val.alias("v")))).alias("vals")
    )
    joined = F.array_join(F.transform("vals", lambda s: s["v"]), " | ")
    text = F.when(F.col("metric") == "acc", F.element_at("vals", 1)["v"]).otherwise(joined)
    return grouped.select("label", "metric", text.alias("text"))


def write_metrics_text(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text sink in the reference's ``(key,v0 | v1)`` line shape."""
    lines = render_metrics(metrics).select(
        F.format_string("(%s,%s)", F.col("metric"), F.col("text")).alias("value")
    )
    lines.write.mode(mode).text(path)

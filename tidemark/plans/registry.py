"""Analysis tools by name: functions of a regular panel (series_id, t, value), for callers that pick by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import arima, diagnostics, generators, kernels, panel, profiles, relations, stl

Tool = Callable[..., DataFrame]


def _filled(tool: Tool) -> Tool:
    return lambda grid, **options: tool(panel.interpolated(grid).drop("was_missing"), **options)


def _columns(data: DataFrame) -> DataFrame:
    """A row for each column: name, type, rows, nulls and (as text) least and greatest value; an empty table has none."""
    counts = data.agg(F.count("*").alias("rows"), *[f(F.col(f"`{c}`")).cast("string").alias(f"{n}_{i}") for i, c in enumerate(data.columns) for n, f in (("present", F.count), ("least", F.min), ("greatest", F.max))])
    each = [F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.col("rows"), (F.col("rows") - F.col(f"present_{i}").cast("long")).alias("nulls"), F.col(f"least_{i}").alias("least"), F.col(f"greatest_{i}").alias("greatest")) for i, (c, t) in enumerate(data.dtypes)]
    return counts.select(F.inline(F.array(*each))).where("rows > 0")


def report_export(result: DataFrame, path: str) -> DataFrame:
    """Write ``result`` as JSON lines below ``path`` and give one row: where, how many rows, which columns."""
    result.write.mode("overwrite").json(path)
    return _artifact(result, path, "report")


def register_artifact(result: DataFrame, path: str, registry: str, kind: str = "table") -> DataFrame:
    """Append a row about what stands at ``path`` to the table of artifacts at ``registry``, and give that row."""
    row = _artifact(result, path, kind)
    row.write.mode("append").parquet(registry)
    return row


def _artifact(result: DataFrame, path: str, kind: str) -> DataFrame:
    return result.agg(F.count("*").alias("rows")).select(F.lit(path).alias("path"), F.lit(kind).alias("kind"), "rows", F.array(*map(F.lit, result.columns)).alias("columns"))


TOOLS: dict[str, Tool] = {
    "data_scan": lambda grid, limit=20: grid.limit(limit),
    "report_export": report_export,
    "register_artifact": register_artifact,
    "data_profile": _columns,
    "data_quality_check": lambda points: panel.index_quality(points, "series_id", "t"),
    "data_convert": lambda points, order=("t",): panel.to_wide(points, list(order)),
    "list_channels": lambda grid: grid.select("series_id").distinct(),
    "channel_stats": lambda grid: panel.summary(grid),
    "channel_values": lambda grid, series, limit=100: grid.where(F.col("series_id") == series).orderBy("t").limit(limit),
    "series_overview": _filled(diagnostics.local_trends),
    "summary_stats": lambda grid: panel.summary(grid).drop("n", "min", "max").join(profiles.channel_profile(grid), "series_id"),
    "shape_distri": lambda grid: diagnostics.shape(grid),
    "plot": lambda grid: diagnostics.zscores(grid),
    "plot_univariate_distribution": lambda grid, bins=35: diagnostics.histogram(grid, bins),
    "box": profiles.channel_profile,
    "Trend_linear": _filled(diagnostics.local_trends),
    "adf_test": _filled(kernels.unit_root),
    "white_noise_test": _filled(lambda filled, lags=10: profiles.white_noise(diagnostics.autocorrelation(filled), lags)),
    "compute_acf": _filled(diagnostics.autocorrelation),
    "detect_periodicity": _filled(kernels.estimate_period),
    "seasonality_detector": _filled(lambda filled, period=24: kernels.seasonal_strength(kernels.decompose(filled, period))),
    "FFT": _filled(kernels.power_spectrum),
    "STL": _filled(lambda filled, period=24, robust=True: stl.robust_components(filled, period, robust=robust)),
    "find_peaks": _filled(diagnostics.peaks),
    "outlier_clipper": _filled(diagnostics.clipped),
    "cpt_detector": lambda grid, of="mean": _filled(profiles.variance_change if of == "variance" else diagnostics.change_point)(grid),
    "ts_imputation": lambda grid, method="linear": panel.interpolated(grid) if method == "linear" else profiles.gap_fills(grid).select("series_id", "t", method),
    "pear_cross_correlation": lambda grid: relations.correlations(grid),
    "spear_cross_correlation": lambda grid: relations.spearman(grid),
    "dtw_distance": _filled(kernels.dtw_pairs),
    "causal": _filled(kernels.granger_f),
    "feature_generate": _filled(diagnostics.lag_features),
    "tsfresh_extractor": lambda grid: panel.summary(grid).join(diagnostics.shape(grid), "series_id"),
    "arima_forecast": _filled(lambda filled, order=(1, 1, 1), horizon=12: arima.arima_forecast(filled, [tuple(order)], horizon)),
    "inject_defects": _filled(generators.inject_defects),
}


def run_tool(name: str, grid: DataFrame, **options) -> DataFrame:
    """The result of a tool; an unknown name is an error that lists the known ones."""
    if name not in TOOLS:
        raise KeyError(f"no tool {name!r}; there are {', '.join(sorted(TOOLS))}")
    return TOOLS[name](grid, **options)

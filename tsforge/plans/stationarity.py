"""Stationarity workflow (the reference's tester flow): ADF + KPSS verdict per
variable, the automatic transform policy, the transformation ledger, the
before/after report, and the export of data plus ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import fill, stationarity, transform, unitroot
from tsforge.plans.materialize import cut
from tsforge.sources import sinks


def verdicts(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    return unitroot.stationarity_verdict(unitroot.adf(df, alpha=alpha), stationarity.kpss(df), alpha)


def run(df: DataFrame, period: int = 12, order: int = 1, alpha: float = 0.05) -> dict[str, DataFrame]:
    """Test every variable once, transform by the policy, re-test the result."""
    d = cut(df)
    before = cut(verdicts(d, alpha))
    data, ledger = transform.auto(d, before, stationarity.seasonality(d, period), period, order)
    data = cut(data)
    after = verdicts(fill.linear(data), alpha)
    report = (ledger.join(before.select("series_id", "var", F.col("conclusion").alias("before")), on=["series_id", "var"])
              .join(after.select("series_id", "var", F.col("conclusion").alias("after")), on=["series_id", "var"])
              .withColumn("success", F.col("after") == "strictly_stationary"))
    return {"verdicts": before, "transformed": data, "ledger": ledger, "report": report}


def export(result: dict[str, DataFrame], path: str, fmt: str = "csv", **kw) -> None:
    """Write the transformed data and ``<stem>_transformations``."""
    sinks.export_transformed(result["transformed"], result["ledger"], path, fmt, **kw)

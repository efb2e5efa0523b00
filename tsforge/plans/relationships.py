"""Relationship-analysis workflow (the reference's analyzer flow): correlation,
cross-correlation, Granger, cointegration and PCA on one multivariate series
collection, then collinearity handling and the processing record.

Every entry of the returned dict is a lazy DataFrame; the canonical input is
materialised once (lineage cut) because every analysis reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tsforge.operators import collinear, relations, unitroot
from tsforge.plans.materialize import cut
from tsforge.sources.sinks import processing_log


def analyze(df: DataFrame, ccf_pair: tuple[str, str] | None = None, granger_pair: tuple[str, str] | None = None,
            coint_pair: tuple[str, str] | None = None, threshold: float = 0.7, ccf_lags: int = 20,
            granger_lags: int = 4, method: str = "auto", importance: DataFrame | None = None) -> dict[str, DataFrame]:
    """Run the analyses and the collinearity handling; returns named tables
    (``correlation, strong_pairs, ccf, granger, cointegration, johansen,
    pca_components, pca_loadings, choice, handled, effect, processing_log``)."""
    d = cut(df)
    corr = cut(relations.correlation(d))
    pairs = relations.strong_pairs(corr, threshold)
    comps, loads = relations.pca(d)
    out: dict[str, DataFrame] = {"correlation": corr, "strong_pairs": pairs, "pca_components": comps,
                                 "pca_loadings": loads, "johansen": unitroot.johansen(d)}
    if ccf_pair:
        out["ccf"] = relations.ccf(d, *ccf_pair, nlags=ccf_lags)
    if granger_pair:
        out["granger"] = unitroot.granger(d, *granger_pair, maxlag=granger_lags)
    if coint_pair:
        out["cointegration"] = unitroot.engle_granger(d, *coint_pair)
    weights, choice, record = collinear.handling(d, method, threshold, imp=importance)
    handled = relations.linear_map(d, weights)
    out["choice"] = choice
    out["handled"] = handled
    out["effect"] = collinear.effect(corr, relations.correlation(handled))
    out["processing_log"] = processing_log(record, comps, threshold)
    return out

"""The dashboard's data, as one set of lazy DataFrames.

Same sequence as the original dashboard: newest rows of the metrics table →
tickers on offer → the selected ticker's rows → KPIs with labels → the two
chart series with the overlay scaling → correlation with its label → the
last rows for the table. Nothing is collected here; a UI collects the small
results it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..operators import dashboard as D


def dashboard_view(metrics: DataFrame, ticker: str | None = None, cfg: Config = DEFAULT) -> dict[str, DataFrame]:
    """Frames for one refresh. ``ticker=None`` keeps every ticker (KPIs per ticker);
    otherwise the selection is an equality filter on the newest rows."""
    newest = D.latest(metrics, cfg)
    selected = newest if ticker is None else D.select_ticker(newest, ticker)
    kpis = D.kpis(selected)
    return {
        "latest": newest,
        "tickers": D.distinct_tickers(newest).orderBy("ticker"),
        "selected": selected.orderBy("ticker", "window_start"),
        "kpis": kpis,
        "kpis_display": D.kpis_display(kpis),
        "series": D.series(selected),
        "overlay": D.overlay(selected).orderBy("ticker", "window_start"),
        "correlation": D.correlation(selected),
        "recent": D.recent(selected, cfg).orderBy("ticker", F.col("window_start").desc()),
    }

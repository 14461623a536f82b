"""Entry points A and B: bars -> indicator panel -> trend panel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from pricetrend.operators.indicators import DEFAULT, IndicatorParams, indicator_panel
from pricetrend.operators.labels import with_movement
from pricetrend.operators.sequence import number_bars
from pricetrend.operators.trend import trend_panel
from pricetrend.session import cut_lineage
from pricetrend.sources.bars import events_bars, lineitem_bars


def indicators_from_bars(bars: DataFrame, grain: str, p: IndicatorParams = DEFAULT,
                         materialize: bool = True, indicators: Iterable[str] | None = None) -> DataFrame:
    """Bars -> ``bar_no`` -> the named indicators (default: all) + lags -> movement label.

    ``materialize`` writes the bar table once (shared checkpoint folder):
    numbering reads it twice (chunk counts and rows), and without the cut
    the optimiser prunes each branch differently and re-aggregates the ticks.
    Without it nothing is written at all.
    """
    if materialize:
        bars = cut_lineage(bars, "bars")
    return with_movement(indicator_panel(number_bars(bars, grain=grain), p, materialize, indicators))


def trends_from_bars(bars: DataFrame, grain: str, p: IndicatorParams = DEFAULT,
                     materialize: bool = True, indicators: Iterable[str] | None = None) -> DataFrame:
    return trend_panel(indicators_from_bars(bars, grain, p, materialize, indicators))


def fixture_bars(spark: SparkSession, sf_dir: str, fixture: str) -> tuple[DataFrame, str]:
    """Named bar fixtures: events_{hour,6 hours,day}, lineitem_day."""
    src, grain = fixture.split("_", 1)
    grain = grain.replace("6h", "6 hours")
    if src == "events":
        return events_bars(spark, sf_dir, grain), grain
    if src == "lineitem":
        return lineitem_bars(spark, sf_dir, grain), grain
    raise ValueError(fixture)


def fixture_indicators(spark: SparkSession, sf_dir: str, fixture: str = "events_hour",
                       indicators: Iterable[str] | None = None) -> DataFrame:
    bars, grain = fixture_bars(spark, sf_dir, fixture)
    return indicators_from_bars(bars, grain, indicators=indicators)


def fixture_trends(spark: SparkSession, sf_dir: str, fixture: str = "events_hour",
                   indicators: Iterable[str] | None = None) -> DataFrame:
    bars, grain = fixture_bars(spark, sf_dir, fixture)
    return trends_from_bars(bars, grain, indicators=indicators)

"""pricetrend: Spark-native price-movement analytics.

OHLC bars -> technical indicators -> rule-based trend signals -> feature
preparation -> classifier grids -> score roll-ups, all keyed by ``symbol``
and expressed as DataFrame operations.
"""

__version__ = "0.1.0"

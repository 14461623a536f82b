from pricetrend.sources.bars import (  # noqa: F401
    BAR_COLUMNS, GRAIN_SECONDS, ohlc_bars, events_bars, lineitem_bars,
    multi_source_bars, read_table,
)
from pricetrend.sources.csv import read_ohlc_csv, write_ohlc_csv  # noqa: F401
from pricetrend.sources.symbols import symbol_dim, with_symbol_names  # noqa: F401
from pricetrend.sources.sinks import write_panel  # noqa: F401

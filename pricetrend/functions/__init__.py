from pricetrend.functions.columns import (  # noqa: F401
    safe_div, full_window, rounded, sign_label,
)

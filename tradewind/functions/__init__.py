from tradewind.functions.dates import date_key, days_between, month_index, month_start
from tradewind.functions.numeric import (
    cents,
    from_cents,
    mean_2dp,
    mean_cents,
    percent_2dp,
    share_where,
)
from tradewind.functions.text import blank_to_null, title_words, truth_value

__all__ = [
    "blank_to_null",
    "cents",
    "date_key",
    "days_between",
    "from_cents",
    "mean_2dp",
    "mean_cents",
    "month_index",
    "month_start",
    "percent_2dp",
    "share_where",
    "title_words",
    "truth_value",
]

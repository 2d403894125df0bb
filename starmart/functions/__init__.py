"""Column expressions: bands, rates, dates, text, predicates."""

from starmart.functions.dates import (
    date_key,
    duration_days,
    end_of_year,
    event_date,
    parse_date,
    parse_instant,
    start_of_year,
)
from starmart.functions.measures import (
    PRICE_BANDS,
    REVENUE_BANDS,
    STAGE_RATES,
    Bands,
    band,
    exact_avg,
    exact_sum,
    stage_rate,
)
from starmart.functions.predicates import any_changed, change_window, valid_at
from starmart.functions.text import row_json, scale_price, suffix_once

__all__ = [
    "PRICE_BANDS",
    "REVENUE_BANDS",
    "STAGE_RATES",
    "Bands",
    "any_changed",
    "band",
    "change_window",
    "date_key",
    "duration_days",
    "end_of_year",
    "event_date",
    "exact_avg",
    "exact_sum",
    "parse_date",
    "parse_instant",
    "row_json",
    "scale_price",
    "stage_rate",
    "start_of_year",
    "suffix_once",
    "valid_at",
]

"""Column-level helpers: built-in Spark expressions only, no Python UDFs."""

from martlens.functions.text import mask_phone, match_all, match_any, search_tokens
from martlens.functions.time import (
    age_in_years,
    epoch_minute,
    epoch_ms,
    from_epoch_ms,
    with_create_date_hour,
    with_log_date_hour,
)
from martlens.functions.ratio import half_up_share, remainder_share

__all__ = [
    "age_in_years", "epoch_minute", "epoch_ms", "from_epoch_ms", "half_up_share",
    "mask_phone", "match_all", "match_any", "remainder_share", "search_tokens",
    "with_create_date_hour", "with_log_date_hour",
]

from tripmart.functions.expressions import (
    as_date,
    as_epoch_minute,
    as_ntz,
    epoch_minute,
    initcap_words,
    iso_weekday,
    minute_diff,
    minute_of_day,
    month_label,
    ns_to_ntz,
    percent_of,
    round_to_int,
    speed_mph,
)

__all__ = [
    "as_date",
    "as_epoch_minute",
    "as_ntz",
    "epoch_minute",
    "initcap_words",
    "iso_weekday",
    "minute_diff",
    "minute_of_day",
    "month_label",
    "ns_to_ntz",
    "percent_of",
    "round_to_int",
    "speed_mph",
]

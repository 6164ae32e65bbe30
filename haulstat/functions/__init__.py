from haulstat.functions.columns import (  # noqa: F401
    NULL_TOKENS,
    any_of,
    bad_weather,
    coerce_timestamp,
    flag,
    hours_between,
    is_weekend,
    nan_to_null,
    normalize_hour,
    null_token,
    reading_timestamp,
    strict_timestamp,
    time_bucket,
    value_map,
    weekday_mon0,
)

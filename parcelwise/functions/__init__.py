from parcelwise.functions.scalar import (  # noqa: F401
    delay_days,
    high_value_flag,
    high_value_flag_from_bool,
    lenient_cast,
    lenient_date,
    miss_pct,
    missing_to_null,
    month_start,
    pct,
    risk_band,
    second_precision_now,
    strict_delay_days,
    utc_now_text,
    weight_kg,
)

from goldleaf.functions.columns import (  # noqa: F401
    default_key,
    hour_of_text,
    is_weekend,
    month_label,
    parse_date,
    weekday_name,
    weekday_num,
)

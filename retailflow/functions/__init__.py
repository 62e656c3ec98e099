from retailflow.functions.cleaning import (  # noqa: F401
    DATE_FORMATS,
    as_of_date,
    date_or,
    default_to,
    digits_to_long,
    full_name,
    mean_of,
    money_out,
    normalize_postal,
    num,
    parse_mixed_date,
    ratio_pct,
    segment,
    share_pct,
    whole_number,
)

from pricewatch.functions.columns import (  # noqa: F401
    as_of_col, since, valid_price, listing_key, money, try_money, parse_iso_ts,
    fixed, fmt_money, fmt_percent, fmt_time, to_number, trunc_time, iso_text,
)

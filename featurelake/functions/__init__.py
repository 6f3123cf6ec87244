from featurelake.functions.columns import (  # noqa: F401
    MICROS_PER_DAY,
    as_timestamp,
    clip,
    elapsed_days,
    fill_numeric_zero,
    portable,
    round_half_up,
    safe_div,
    to_double,
    ts_literal,
    ts_text,
)

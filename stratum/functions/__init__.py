from stratum.functions.convert import (  # noqa: F401
    MONEY,
    cdc_struct_sequence,
    days_between,
    epoch_day_to_date,
    epoch_us_to_timestamp,
    flag,
    guarded_pct,
    hex_text,
    money,
    sequence_of,
    uuid_text,
)

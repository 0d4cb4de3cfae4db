from molarflow.functions.text import (  # noqa: F401
    fold_name, phone_digits, strip_accents, truncate,
    fold_text, search_text, parse_list, parse_int_list,
)
from molarflow.functions.phone import phone_key, phone_variants  # noqa: F401
from molarflow.functions.misc import (  # noqa: F401
    epoch_or_iso_to_ts, year_month, month_start, plus_days, lookback_bound, abs_gap_seconds,
    blank_to_null, non_null_ids, with_label, attribute_present, digest,
    origin_label, owner_label, clamp, total_pages,
)

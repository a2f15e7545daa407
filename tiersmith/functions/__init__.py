from tiersmith.functions.casts import safe_cast
from tiersmith.functions.dates import (
    DAY_FIRST_FORMATS,
    date_from_keys,
    months_before,
    parse_date,
    parse_date_or_fail,
    partition_keys,
)
from tiersmith.functions.text import first_name, last_token, rest_name, snake_case, strip_whitespace

__all__ = [
    "DAY_FIRST_FORMATS", "date_from_keys", "first_name", "last_token", "months_before",
    "parse_date", "parse_date_or_fail", "partition_keys", "rest_name", "safe_cast",
    "snake_case", "strip_whitespace",
]

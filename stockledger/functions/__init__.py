from stockledger.functions.columns import (
    long_from_bytes,
    long_to_bytes,
    non_negative,
    or_unknown,
    required,
    signed_case,
    strict_long,
    try_long,
    upper_line,
    zero_fill,
)

__all__ = [
    "long_from_bytes",
    "long_to_bytes",
    "non_negative",
    "or_unknown",
    "required",
    "signed_case",
    "strict_long",
    "try_long",
    "upper_line",
    "zero_fill",
]

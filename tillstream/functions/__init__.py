from .casts import as_double, as_int, as_long, as_timestamp, iso_text
from .money import cents, exact_mean, exact_sum, money_parts, money_text

__all__ = [
    "as_double",
    "as_int",
    "as_long",
    "as_timestamp",
    "cents",
    "exact_mean",
    "exact_sum",
    "iso_text",
    "money_parts",
    "money_text",
]

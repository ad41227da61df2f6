from dumptables.functions.text import (
    instant_seconds,
    instant_sql,
    last_filled,
    number_sql,
    strict_long,
    strict_short,
)

__all__ = [
    "instant_seconds",
    "instant_sql",
    "last_filled",
    "number_sql",
    "strict_long",
    "strict_short",
]

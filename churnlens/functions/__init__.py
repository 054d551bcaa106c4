"""Column expressions: time parts of epoch-millisecond values and row flags."""

from churnlens.functions.flags import gender_flag, page_flag, user_system
from churnlens.functions.time import to_day, to_days, to_hour, to_minutes, to_month

__all__ = [
    "gender_flag", "page_flag", "user_system",
    "to_day", "to_days", "to_hour", "to_minutes", "to_month",
]

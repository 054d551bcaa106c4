"""Row-level flags and the user-system extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.schema import FEMALE, USER_SYSTEM_PATTERN


def user_system(user_agent: Column | str = "userAgent") -> Column:
    """System name in the first parentheses of a user agent.

    No match gives ``''``; a NULL agent gives NULL.
    """
    c = F.col(user_agent) if isinstance(user_agent, str) else user_agent
    return F.regexp_extract(c, USER_SYSTEM_PATTERN, 1)


def page_flag(page_value: str, page: str = "page") -> Column:
    """1 where ``page`` equals ``page_value``, else 0 (NULL page gives 0)."""
    return F.when(F.col(page) == page_value, 1).otherwise(0)


def gender_flag(gender: str = "gender") -> Column:
    """1 for female users, else 0 (NULL gives 0)."""
    return F.when(F.col(gender) == FEMALE, 1).otherwise(0)

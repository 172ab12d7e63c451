"""Calendar and cyclical date terms shared by the weather and storage stages."""

from __future__ import annotations

import math

# Fixed month sets of the season definitions.
WINTER_MONTHS = [12, 1, 2]
SPRING_MONTHS = [3, 4, 5]
SUMMER_MONTHS = [6, 7, 8]
FALL_MONTHS = [9, 10, 11]
INJECTION_MONTHS = [4, 5, 6, 7, 8, 9, 10]
WITHDRAWAL_MONTHS = [11, 12, 1, 2, 3]


def _qn(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_TWO_PI = repr(2 * math.pi) + "D"


def _flag_sql(m: str, months: list[int]) -> str:
    return f"coalesce(cast({m} in ({', '.join(map(str, months))}) as int), 0)"


def weather_calendar_cols(d: str = "date") -> list[str]:
    """P2 as SQL expression text: month, quarter, day_of_year, 2π·m/12 and
    2π·doy/365 terms, season flags (a null month gives 0 flags).

    The day term divides by 365 on leap years too, so day 366 wraps slightly
    past 2π, exactly as the definition it mirrors.
    """
    c = _qn(d)
    m, doy = f"month({c})", f"dayofyear({c})"
    return [
        f"{m} as month",
        f"quarter({c}) as quarter",
        f"{doy} as day_of_year",
        f"sin({_TWO_PI} * {m} / 12.0D) as month_sin",
        f"cos({_TWO_PI} * {m} / 12.0D) as month_cos",
        f"sin({_TWO_PI} * {doy} / 365.0D) as day_sin",
        f"cos({_TWO_PI} * {doy} / 365.0D) as day_cos",
        f"{_flag_sql(m, WINTER_MONTHS)} as is_winter",
        f"{_flag_sql(m, SPRING_MONTHS)} as is_spring",
        f"{_flag_sql(m, SUMMER_MONTHS)} as is_summer",
        f"{_flag_sql(m, FALL_MONTHS)} as is_fall",
    ]


def storage_calendar_cols(d: str = "date") -> list[str]:
    """P3 as SQL expression text: month, quarter, ISO week,
    injection/withdrawal flags, month terms."""
    c = _qn(d)
    m = f"month({c})"
    return [
        f"{m} as month",
        f"quarter({c}) as quarter",
        f"weekofyear({c}) as week_of_year",
        f"{_flag_sql(m, INJECTION_MONTHS)} as is_injection_season",
        f"{_flag_sql(m, WITHDRAWAL_MONTHS)} as is_withdrawal_season",
        f"sin({_TWO_PI} * {m} / 12.0D) as month_sin",
        f"cos({_TWO_PI} * {m} / 12.0D) as month_cos",
    ]

"""Calendar rules as SQL text: date keys, months, the holiday rule."""

from __future__ import annotations

# Fixed values that must equal the reference's: UK-relevant holidays as
# (month, day-of-month) pairs, applied to every year.
UK_HOLIDAYS = (
    (12, 25), (12, 26), (12, 31),
    (1, 1),
    (4, 1), (4, 7), (4, 8), (4, 25),
    (5, 1), (5, 6), (5, 8), (5, 26), (5, 27),
)


def date_key_sql(x: str) -> str:
    """yyyyMMdd as int."""
    return f"CAST(date_format({x}, 'yyyyMMdd') AS INT)"


def year_month_sql(x: str) -> str:
    return f"date_format({x}, 'yyyy-MM')"


def holiday_sql(x: str, holidays=UK_HOLIDAYS) -> str:
    """True when the date's (month, day) is in ``holidays`` (same list every year)."""
    by_month: dict[int, list[int]] = {}
    for m, day in holidays:
        by_month.setdefault(m, []).append(day)
    cond = " OR ".join(f"(month({x}) = {m} AND dayofmonth({x}) IN ({', '.join(map(str, days))}))"
                       for m, days in by_month.items()) or "false"
    return f"coalesce({cond}, false)"


def months_between_e8_sql(later: str, earlier: str) -> str:
    """months_between (already rounded to 8 places) as an exact count of 1e-8 months."""
    return f"CAST(round(months_between({later}, {earlier}) * 1e8) AS BIGINT)"

"""Exact money arithmetic and HALF_UP rounding as SQL text.

Money arrives as doubles with two decimals; capping at q +/- 1.5 x IQR can leave
three. A value is converted once to exact integer units of 1/10000
(``CAST(rint(x * 10000) AS BIGINT)``); sums and products run on those longs,
which Spark aggregates in its fast codegen path (wide DECIMAL buffers would fall
back to BigDecimal objects per row). Units become cents, HALF_UP, only where the
result is rounded: per line for line amounts, once at the end for sums and means.
Amounts that already are rounded (line_*, results of sums) are taken as whole cents.

Rounded means and percentages are the HALF_UP rounding of the exact quotient
of two integers, computed per output row in DECIMAL(38,0) so large sums do not
overflow: ``round(n / d, k) = sign * ((2|n|10^k + |d|) div 2|d|) / 10^k``.

The helpers return SQL text, so a whole projection goes to the JVM in one
``selectExpr`` call.
"""

from __future__ import annotations

UNIT = 10_000  # units in one currency unit


def units_sql(x: str) -> str:
    """Integer units of a money value with at most four decimals."""
    return f"CAST(rint({x} * {UNIT}.0D) AS BIGINT)"


def cents_sql(x: str) -> str:
    """Integer cents of an amount that is already rounded to cents."""
    return f"CAST(rint({x} * 100.0D) AS BIGINT)"


def cents_of_units_sql(u: str) -> str:
    """Units rounded HALF_UP (away from zero) to whole cents, as a long."""
    half = UNIT // 200
    return f"(CASE WHEN ({u}) < 0 THEN -(({half} - ({u})) div {UNIT // 100}) ELSE (({u}) + {half}) div {UNIT // 100} END)"


def from_cents_sql(x: str) -> str:
    return f"(({x}) / 100.0D)"


def round_units_sql(u: str) -> str:
    """Units rounded HALF_UP to cents, as a double."""
    return from_cents_sql(cents_of_units_sql(u))


def half_up_sql(n: str, d: str, places: int) -> str:
    """HALF_UP(n / d, places) as double for integer-valued n, d; NULL if d is 0/NULL."""
    nn = f"CAST({n} AS DECIMAL(38,0))"
    dd = f"CAST({d} AS DECIMAL(38,0))"
    scale = 10 ** places
    num, den = f"(2 * abs({nn}) * {scale} + abs({dd}))", f"(2 * abs({dd}))"
    q = f"(({num} - {num} % {den}) / {den})"  # whole, so the decimal division is exact
    return (f"(CASE WHEN {dd} IS NULL OR {dd} = 0 THEN CAST(NULL AS DOUBLE) "
            f"WHEN ({nn} < 0) <> ({dd} < 0) THEN CAST(-{q} AS DOUBLE) / {scale}.0D "
            f"ELSE CAST({q} AS DOUBLE) / {scale}.0D END)")


def pct_sql(num: str, den: str, guard: str | None = None) -> str:
    """round(num / den * 100, 2), 0.0 unless ``guard`` (default den) > 0.

    ``num`` and ``den`` are exact integers in the same unit (cents, units, counts).
    """
    g = guard if guard is not None else den
    return f"(CASE WHEN ({g}) > 0 THEN {half_up_sql(f'({num}) * 100', den, 2)} ELSE 0.0D END)"


def avg_money_sql(x: str, places: int = 2) -> str:
    """round(avg(money x), places) (aggregate)."""
    return half_up_sql(f"sum({units_sql(x)})", f"count({x}) * {UNIT}", places)


def avg_int_sql(x: str, places: int) -> str:
    """round(avg(integer x), places) (aggregate)."""
    return half_up_sql(f"sum(CAST({x} AS BIGINT))", f"count({x})", places)


def avg_scaled_sql(x: str, decimals: int, places: int) -> str:
    """round(avg(x), places) for x holding at most ``decimals`` decimals (aggregate)."""
    units = f"CAST(rint({x} * {10 ** decimals}.0D) AS BIGINT)"
    return half_up_sql(f"sum({units})", f"count({x}) * {10 ** decimals}", places)


def sum_cents_sql(x: str) -> str:
    """round(sum(money x), 2) in whole cents, summed exactly in units (aggregate)."""
    return cents_of_units_sql(f"sum({units_sql(x)})")


def sum_money_sql(x: str) -> str:
    """round(sum(money x), 2) as double (aggregate)."""
    return from_cents_sql(sum_cents_sql(x))

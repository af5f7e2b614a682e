"""Column types inferred from text.

Types form a lattice from ``null`` to ``string``: a column gets the narrowest type that all its
values are written as. All columns are folded in one aggregate, and the join of
two inferred types is the type of both columns' values together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, _parse_datatype_string

#: Type -> SQL condition on a value ``@`` of text. Numbers with leading zeros are codes, not numbers.
WRITTEN_AS = {
    "boolean": "lower(@) IN ('true', 'false')",
    "bigint": "@ rlike '^[+-]?(0|[1-9][0-9]*)$' AND try_cast(@ AS BIGINT) IS NOT NULL",
    "double": "@ rlike '^[+-]?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'",
    "date": "@ rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' AND try_cast(@ AS DATE) IS NOT NULL",
    "timestamp_ntz": "@ rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$'"
                     " AND try_cast(@ AS TIMESTAMP_NTZ) IS NOT NULL",
    "timestamp": "@ rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$'"
                 " AND try_cast(@ AS TIMESTAMP) IS NOT NULL",
}
#: The types below each type. What has no common type below ``string`` is text.
BELOW = {"boolean": (), "bigint": (), "double": ("bigint",), "date": (), "timestamp_ntz": ("date",), "timestamp": ("timestamp_ntz", "date")}


def join(a: str, b: str) -> str:
    """The least type that holds values of both; ``null`` is below every type."""
    for low, high in ((a, b), (b, a)):
        if low in ("null", high) or low in BELOW.get(high, ()):
            return high
    return "string"


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Column -> type of its text values; ``null`` where it has none.

    One aggregate with one row of flags: whether there is a value, and for each type
    whether all values are written as it.
    """
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return {}

    def flags(i: int):
        x = f"_{i}"
        holds = [F.expr(f"coalesce(bool_and(CASE WHEN {x} IS NOT NULL THEN {cond.replace('@', x)} END), true)").alias(t) for t, cond in WRITTEN_AS.items()]
        return F.struct(F.expr(f"count({x}) > 0").alias("any"), *holds).alias(x)

    # the conditions name columns by number, as names of files may hold any character
    numbered = df.select(*[F.col(f"`{c.replace('`', '``')}`").alias(f"_{i}") for i, c in enumerate(columns)])
    row = numbered.agg(*[flags(i) for i in range(len(columns))]).first()
    found = {}
    for i, c in enumerate(columns):
        flag = row[i]
        found[c] = "null" if not flag["any"] else next((t for t in WRITTEN_AS if flag[t]), "string")
    return found


def schema_of(types: dict[str, str]) -> StructType:
    """Nullable columns of the inferred types; a column without a value is text."""
    def kind(t: str) -> DataType:
        return StringType() if t in ("null", "string") else _parse_datatype_string(t)

    return StructType([StructField(c, kind(t), True) for c, t in types.items()])

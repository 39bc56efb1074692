"""Aggregate helpers with repeatable results.

ANY_VALUE is free to return a value from any row of the group, and several
ANY_VALUEs in one group may come from different rows. Downstream audits
compare picked columns with each other (repayment status vs delinquency), so
here every pick of a group comes from one row: the row with the least
``(order columns..., picked values...)``. Including the picked values in the
ordering makes the choice total and so repeatable even when the order columns
tie. ``min`` over a struct is a plain declarative aggregate, so it is
partially aggregated map-side like ``sum`` (no group is ever collected).

Means are an exact sum divided once by the count, so the answer does not depend
on the order in which rows are added up. A mean of NUMERIC values keeps all
nine places of its inputs and is NUMERIC itself; a mean of integers is DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pick_struct(values: Sequence[str], order: Sequence, when: Column | None = None) -> Column:
    """Struct of the picked values from the least row by (order..., values...)."""
    s = F.struct(
        *[_c(o).alias(f"_o{i}") for i, o in enumerate(order)],
        *[F.col(v).alias(v) for v in values],
    )
    if when is not None:
        s = F.when(when, s)
    return F.min(s)


def unpack(struct_col: str, values: Sequence[str]) -> list[Column]:
    return [F.col(f"{struct_col}.{v}").alias(v) for v in values]


def decimal_mean(c) -> Column:
    """AVG of a NUMERIC column, as NUMERIC: the sum at full scale, divided once."""
    return F.avg(_c(c).cast("decimal(38,9)")).cast("decimal(38,9)")


def integer_mean(c) -> Column:
    """AVG of an INTEGER column: exact bigint sum / count, as DOUBLE."""
    x = _c(c)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))

"""Null-aware building blocks shared by the other modules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def if_else3(cond: Column, yes, no) -> Column:
    """Three-valued choice: an unknown condition gives null, not the else branch."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(cond.isNull(), F.lit(None)).when(cond, lit(yes)).otherwise(lit(no))


def is_known_true(cond: Column) -> Column:
    """A condition as a filter sees it: unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def text_key(*parts: ColumnLike, sep: str = "", missing: str = "NA") -> Column:
    """Glue parts into one text key; a null part becomes the text ``NA`` instead of nulling the key."""
    cells = [F.coalesce(col(p).cast("string"), F.lit(missing)) for p in parts]
    return F.concat_ws(sep, *cells) if sep else F.concat(*cells)


def n_distinct(c: ColumnLike) -> Column:
    """Distinct values where null counts as one more value."""
    return F.count_distinct(col(c)) + F.max(col(c).isNull().cast("int"))


def row_sum(*cols: ColumnLike) -> Column:
    """Row-wise sum that skips nulls."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def recode(c: ColumnLike, groups: dict[str | None, list], keep_other: bool = True) -> Column:
    """Standardise codes: ``{target: [spellings]}``; other values are kept or become null."""
    source = col(c)
    out = None
    for target, spellings in groups.items():
        cond = source.isin(*spellings)
        value = F.lit(target).cast("string")
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        return source if keep_other else F.lit(None).cast("string")
    return out.otherwise(source.cast("string") if keep_other else F.lit(None).cast("string"))


def r6(c: ColumnLike, digits: int = 6) -> Column:
    """Round for reports; adding zero turns a negative zero into zero."""
    return F.round(col(c).cast("double"), digits) + F.lit(0.0)

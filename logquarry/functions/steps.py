"""Cutting long expression chains into steps."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def step(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The ``keep`` columns plus computed ``columns``, each evaluated exactly once per row.

    A plain projection would be inlined: a later filter on a computed column is pushed below it as a
    second copy of the whole expression, and stacked projections multiply the copies until planning or
    code generation fails. Filters are not pushed through the one-row ``inline`` used here.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))

"""Values computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with extra columns, each computed once per row, no shuffle.

    A generator over a one-element array keeps the expressions from being merged into what is
    built on top. Needed before an Arrow function: Spark may fail to recognise two copies of an
    argument that holds lambdas, and merging would also evaluate it once per use.
    """
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    generated = df.select("*", F.explode(F.array(packed)).alias("_computed"))
    return generated.select(*keep, *[F.col("_computed")[n].alias(n) for n in columns])


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once per row, however often the body uses it.

    Without this, a lambda that mentions an outer expression computes it again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)

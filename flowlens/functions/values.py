"""Text, number and default handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def named(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_number(value: Column) -> Column:
    """Text to DOUBLE; anything that is no number becomes 0."""
    return F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def safe_ratio(amount: Column, base: Column) -> Column:
    """``amount / base`` where the base is positive, else 0."""
    return F.when(base > 0, amount / base).otherwise(F.lit(0.0))


def or_default(df: DataFrame, name: str, default) -> Column:
    """The column if the table has it, else the constant; always under ``name``."""
    found = named(name) if name in df.columns else F.lit(default)
    return found.alias(name)


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric`` or ``text`` columns, in table order."""
    wanted = {"numeric": T.NumericType, "text": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]

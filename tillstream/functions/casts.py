"""Casts that give NULL on bad input, whether or not ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.typeName()


def as_double(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("double")


def as_long(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("bigint")


def as_int(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("int")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """ISO text (with or without a fraction) or any timestamp type → timestamp."""
    if _type(df, name) == "string":
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def iso_text(df: DataFrame, name: str) -> Column:
    """A timestamp as ISO text; the fraction is left out where it is zero."""
    c = F.col(name)
    if _type(df, name) == "string":
        return c
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_trunc("second", c) == c, whole).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )

"""JSON messages ⇄ columns. Works the same on a batch and on a stream."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_text
from ..schemas import EVENT

_TIMES = (T.TimestampType, T.TimestampNTZType)
_NUMBERS = ("amount", "balance_after_transaction")


def encode(df: DataFrame, key: str = "account_id", keep: Sequence[str] = ()) -> DataFrame:
    """Rows → ``(key, value)``: the account as key, the row as JSON, NULLs kept.

    Times become naive ISO text with all their digits. Columns in ``keep`` stay
    beside the message instead of going into it.
    """
    payload = [
        iso_text(df, f.name).alias(f.name) if isinstance(f.dataType, _TIMES) else f.name
        for f in df.schema.fields
        if f.name not in keep
    ]
    value = F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"), *keep)


def parsed(rows: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """``rows`` with ``_event``: the object that ``text`` is, NULL if it is anything else.

    The text is parsed as the first of a list of two, whose second element is a mark of
    this plan's own. Both must be there: alone, an object followed by anything else would
    be read as if that were not there.
    """
    mark = uuid.uuid4().hex
    marked = T.StructType([*schema.fields, T.StructField("_mark", T.StringType())])
    listed = F.concat(F.lit("["), F.col(text), F.lit(f',{{"_mark":"{mark}"}}]'))
    options = {"allowSingleQuotes": "false"}
    both = F.from_json(listed, T.ArrayType(marked), options)
    rows = rows.withColumn("_both", both)
    whole = (F.size("_both") == 2) & (F.get("_both", F.lit(1))["_mark"] == mark)
    # A generator rather than an index: Spark would push a later filter on an index
    # below it and parse every message once more for the filter.
    event = F.explode_outer(F.when(whole, F.slice("_both", 1, 1)))
    return rows.select(*[c for c in rows.columns if c != "_both"], event.alias("_event"))


def decode(messages: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Messages with a ``value`` → the schema's fields, plus

    * ``_extra``: fields the schema does not name, as JSON text, NULL if none;
    * ``_bad_value``: the message, where it is not a JSON object.

    All other columns of ``messages`` stay.
    """
    value = F.col("value").cast("string")
    known = schema.fieldNames()
    # Listing the keys is much cheaper than reading all values once more, which only
    # messages with unknown fields need (or with NaN, whose keys are not listed).
    unknown = F.exists(F.json_object_keys(value), lambda name: ~name.isin(*known))
    others = F.when(
        F.coalesce(unknown, F.lit(True)),
        F.map_filter(
            F.from_json(value, "map<string,variant>"), lambda name, _: ~name.isin(*known)
        ),
    )
    kept = [F.col(c) for c in messages.columns if c != "value"]
    fields = [_field(n).alias(n) for n in known]
    rows = parsed(messages.select(*kept, value.alias("_v"), others.alias("_o")), schema, "_v")
    bad = F.col("_event").isNull()
    return rows.select(
        *kept,
        *fields,
        F.when(~bad & (F.size("_o") > 0), F.to_json("_o")).alias("_extra"),
        F.when(bad, F.coalesce("_v", F.lit(""))).alias("_bad_value"),
    )


def _field(name: str) -> Column:
    text = F.col(f"_event.{name}")
    # from_json quotes the bare words NaN and Infinity when it reads them as text.
    return F.btrim(text, F.lit('"')) if name in _NUMBERS else text


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("_bad_value").isNull())


def quarantine(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("_bad_value").isNotNull())

"""Threshold alerts: which events raise which alerts, for which users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_double
from ..settings import ALERT_KINDS, FAILED_TXN, HIGH_VALUE, LOW_BALANCE, Rules
from .lookups import lookup

ALERT_COLUMNS = (
    "transaction_id",
    "account_id",
    "user_name",
    "user_email",
    "alert_type",
    "amount",
    "balance_after_transaction",
    "transaction_status",
    "transaction_type",
    "transaction_timestamp",
    "channel",
    "merchant_name",
    "merchant_category",
    "reference_number",
)


def coerced(df: DataFrame) -> DataFrame:
    """The alert side's own reading of an event: missing numbers count as 0,
    missing words as empty, and ``status`` is upper case."""
    return df.withColumns(
        {
            "amount": F.coalesce(as_double(df, "amount"), F.lit(0.0)),
            "balance_after_transaction": F.coalesce(
                as_double(df, "balance_after_transaction"), F.lit(0.0)
            ),
            "status": F.upper(F.coalesce("transaction_status", F.lit(""))),
            "transaction_type": F.coalesce("transaction_type", F.lit("")),
        }
    )


def is_high_value(rules: Rules) -> Column:
    # Spark holds NaN to be greater than any limit; here it is above none.
    return (F.col("amount") > rules.alert_high_value) & ~F.isnan("amount")


def is_failed(rules: Rules) -> Column:
    return F.col("status") == rules.failed


def is_low_debit(rules: Rules) -> Column:
    return (F.col("transaction_type") == rules.debit) & (
        F.col("balance_after_transaction") < rules.alert_low_balance
    )


def raised(rules: Rules) -> dict[str, Column]:
    """Alert kind → when it is raised, in the order they are sent."""
    return {
        HIGH_VALUE: is_high_value(rules),
        FAILED_TXN: is_failed(rules),
        LOW_BALANCE: is_low_debit(rules) & (F.col("status") == rules.success),
    }


def is_ok(rules: Rules) -> Column:
    """Reported as unremarkable. Not the complement of the alerts: a low-balance
    debit that neither failed nor succeeded is neither."""
    return (
        (F.col("amount") <= rules.alert_high_value) & ~is_failed(rules) & ~is_low_debit(rules)
    )


def fan_out(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per alert an event raises (none, one or two)."""
    kinds = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in raised(rules).items()]))
    return df.withColumn("alert_type", F.explode(kinds))


def alert_events(
    events: DataFrame, master: DataFrame, rules: Rules = Rules(), **lookup_options
) -> DataFrame:
    """Alerts of events whose account is in the master.

    Events that raise nothing are dropped before the join, and the fan-out comes
    after it, so the join sees each alerting event once.
    """
    high, failed, low = raised(rules).values()
    alerting = coerced(events).filter(high | failed | low)
    return fan_out(lookup(alerting, master, "account_id", **lookup_options), rules)


def ok_events(
    events: DataFrame, master: DataFrame, rules: Rules = Rules(), **lookup_options
) -> DataFrame:
    """Unremarkable events whose account is in the master."""
    fine = coerced(events).filter(is_ok(rules))
    return lookup(fine, master, "account_id", **lookup_options)


def unmatched_events(events: DataFrame, master: DataFrame, **lookup_options) -> DataFrame:
    """Events whose account the master does not hold; no rule applies to them."""
    return lookup(coerced(events), master, "account_id", "left_anti", **lookup_options)


def alert_metrics(
    events: DataFrame, alerts: DataFrame, bad: DataFrame | None = None
) -> DataFrame:
    """One row: events seen, alerts raised, and alerts of each kind.

    With ``bad``, also the messages that could not be read; where ``alerts`` say whether
    they were ``delivered``, also how many were.
    """
    nothing = F.lit(None).cast("string")
    told = "delivered" in alerts.columns
    tagged = events.select(F.lit("event").alias("what"), nothing.alias("kind"), F.lit(False).alias("sent")).unionAll(
        alerts.select(F.lit("alert"), "alert_type", F.col("delivered") if told else F.lit(False))
    )
    if bad is not None:
        tagged = tagged.unionAll(bad.select(F.lit("bad"), nothing, F.lit(False)))
    what, kind = F.col("what"), F.col("kind")
    return tagged.agg(
        F.count_if(what == "event").alias("events_total"),
        F.count_if(what == "alert").alias("alerts_sent"),
        *[F.count_if(kind == k).alias(f"{k.lower()}_alerts") for k in ALERT_KINDS],
        *([F.count_if(what == "bad").alias("bad_messages")] if bad is not None else []),
        *([F.count_if("sent").alias("alerts_delivered")] if told else []),
    )

"""Thresholds, message wording and column names, as plain immutable values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """The limits of the pipeline.

    Three of them look alike and are not: a row is "high value" strictly above
    ``high_value``, falls into the top bucket from ``bucket_edges[2]`` on, and
    raises an alert strictly above ``alert_high_value``.
    """

    # fixed values: limits in currency units
    high_value: float = 8000.0
    bucket_edges: tuple[float, float, float] = (500.0, 3000.0, 8000.0)
    bucket_names: tuple[str, str, str, str] = ("LOW", "MEDIUM", "HIGH", "VERY_HIGH")
    alert_high_value: float = 9000.0
    alert_low_balance: float = 100.0

    # fixed values: domain words
    debit: str = "DEBIT"
    success: str = "SUCCESS"
    failed: str = "FAILED"


@dataclass(frozen=True)
class Sender:
    """Who signs the alert messages."""

    bank: str = "Example Bank"
    support_email: str = "support@example.com"
    support_phone: str = "1800-XXX-XXXX"
    currency_sign: str = "₹"


# fixed values: alert kinds, in the order an event raises them
HIGH_VALUE = "HIGH_VALUE"
FAILED_TXN = "FAILED_TXN"
LOW_BALANCE = "LOW_BALANCE"
ALERT_KINDS = (HIGH_VALUE, FAILED_TXN, LOW_BALANCE)

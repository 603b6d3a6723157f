"""Subject and body of alert messages."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iso_text, money_text
from ..settings import FAILED_TXN, HIGH_VALUE, LOW_BALANCE, Rules, Sender

# fixed values: message wording, one string per line; every line after the first
# is indented by the number of blanks given with it
RULER = "━" * 31

SUBJECTS = {
    HIGH_VALUE: "🚨 {bank} Alert: Large Transaction of {amount} on your account",
    FAILED_TXN: "⚠️ {bank} Alert: Transaction of {amount} FAILED",
    LOW_BALANCE: "⚠️ {bank} Alert: Low Balance Warning — {balance} remaining",
}

BODIES = {
    HIGH_VALUE: (
        16,
        [
            "Dear {user},",
            "",
            "A high-value transaction has been detected on your {bank} account.",
            "",
            RULER,
            "  TRANSACTION DETAILS",
            RULER,
            "  Account ID          : {account}",
            "  Transaction ID      : {id}",
            "  Reference Number    : {reference}",
            "  Type                : {type}",
            "  Amount              : {amount}",
            "  Channel             : {channel}",
            "  Merchant            : {merchant}",
            "  Category            : {category}",
            "  Status              : {status}",
            "  Balance After Txn   : {balance}",
            "  Timestamp           : {time} UTC",
            RULER,
            "",
            "If you did not authorize this transaction, please contact {bank} ",
            "support immediately at {support_email} or call {support_phone}.",
            "",
            "Regards,",
            "{bank} Fraud & Alerts Team",
        ],
    ),
    FAILED_TXN: (
        8,
        [
            "Dear {user},",
            "",
            "Your recent transaction has FAILED. Here are the details:",
            "",
            RULER,
            "  FAILED TRANSACTION DETAILS",
            RULER,
            "  Account ID          : {account}",
            "  Transaction ID      : {id}",
            "  Reference Number    : {reference}",
            "  Type                : {type}",
            "  Amount              : {amount}",
            "  Channel             : {channel}",
            "  Merchant            : {merchant}",
            "  Category            : {category}",
            "  Status              : ❌ FAILED",
            "  Balance After Txn   : {balance}",
            "  Timestamp           : {time} UTC",
            RULER,
            "",
            "Your account balance remains unchanged for this transaction.",
            "If you continue to face issues, please retry or contact support.",
            "",
            "Regards,",
            "{bank} Transaction Support Team",
        ],
    ),
    LOW_BALANCE: (
        16,
        [
            "Dear {user},",
            "",
            "Your {bank} account balance has dropped below {low_balance}.",
            "",
            RULER,
            "  BALANCE ALERT",
            RULER,
            "  Account ID          : {account}",
            "  Current Balance     : {balance}",
            "  Last Transaction    : {amount} ({type} via {channel})",
            "  Merchant            : {merchant}",
            "  Timestamp           : {time} UTC",
            RULER,
            "",
            "Please add funds to avoid transaction failures.",
            "",
            "Regards,",
            "{bank} Account Services Team",
        ],
    ),
}


def filled(template: str, values: dict[str, Column | str]) -> Column:
    """A template with ``{name}`` fields → one concatenation of text and columns."""
    parts, text = [], ""
    for literal, name, _, _ in Formatter().parse(template):
        text += literal
        value = values[name] if name else ""
        if isinstance(value, str):
            text += value
        else:
            parts += [F.lit(text), value]
            text = ""
    return F.concat(*parts, F.lit(text))


def body_template(kind: str) -> str:
    indent, lines = BODIES[kind]
    return ("\n" + " " * indent).join(lines)


def with_messages(
    alerts: DataFrame, rules: Rules = Rules(), sender: Sender = Sender()
) -> DataFrame:
    """Add ``subject`` and ``body``; a missing field leaves its place empty."""

    def text(c) -> Column:
        return F.coalesce(c, F.lit(""))

    values: dict[str, Column | str] = {
        "bank": sender.bank,
        "support_email": sender.support_email,
        "support_phone": sender.support_phone,
        "low_balance": f"{sender.currency_sign}{rules.alert_low_balance:,.2f}",
        "amount": text(money_text(F.col("amount"), sender.currency_sign)),
        "balance": text(money_text(F.col("balance_after_transaction"), sender.currency_sign)),
        "time": text(iso_text(alerts, "transaction_timestamp")),
        "user": text("user_name"),
        "account": text("account_id"),
        "id": text("transaction_id"),
        "reference": text("reference_number"),
        "type": text("transaction_type"),
        "channel": text("channel"),
        "merchant": text("merchant_name"),
        "category": text("merchant_category"),
        "status": text("transaction_status"),
    }

    def by_kind(templates: dict[str, str]) -> Column:
        chosen = F
        for kind, template in templates.items():
            chosen = chosen.when(F.col("alert_type") == kind, filled(template, values))
        return chosen

    return alerts.withColumns(
        {
            "subject": by_kind(SUBJECTS),
            "body": by_kind({kind: body_template(kind) for kind in BODIES}),
        }
    )

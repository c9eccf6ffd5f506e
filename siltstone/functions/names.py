"""Decisions taken from column names alone."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

# Parts of a name that mark a column as personal, in the stages.
STAGE_PII = (
    "email", "phone", "mobile", "name", "dob", "birth", "address",
    "zip", "pincode", "ssn", "passport", "pan", "aadhar", "aadhaar",
    "credit_card", "card_number", "account_no", "account_number",
    "ip_address", "ip_addr", "gender", "nationality",
)

# The same for the record toolbox.
RECORD_PII = (
    "email", "phone", "mobile", "ssn", "social_security", "credit_card",
    "card_number", "passport", "national_id", "address", "zip", "postal",
    "dob", "birth", "firstname", "lastname", "full_name", "customer_name",
    "first_name", "last_name", "ip_address", "ip_addr",
)

# Parts of a name that mark a date column.
DATE_WORDS = ("date", "time", "created", "updated", "timestamp", "at")

# Names taken as the row's time stamp, before any look at types.
TIMESTAMP_NAMES = (
    "timestamp", "created_at", "updated_at", "date", "datetime",
    "event_time", "event_timestamp", "time", "dt", "record_date",
)


def _tokens(name: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", name.lower()) if t]


def _has_phrase(name: str, phrase: str) -> bool:
    parts, wanted = _tokens(name), _tokens(phrase)
    return any(parts[i : i + len(wanted)] == wanted for i in range(len(parts) - len(wanted) + 1))


def pii_columns(
    columns: Iterable[str],
    keywords: Sequence[str] = STAGE_PII,
    *,
    match: str = "substring",
    allow: Iterable[str] = (),
    deny: Iterable[str] = (),
) -> list[str]:
    """Columns whose name says personal data.

    `match="token"` compares whole `_`-separated words, so that `product_name`
    can be told apart by listing `name` columns in `allow`. Columns in `allow`
    are never personal, those in `deny` always are.
    """
    if match not in ("substring", "token"):
        raise ValueError("match is 'substring' or 'token'")
    allowed, denied = set(allow), set(deny)
    found = []
    for name in columns:
        low = name.lower().replace(" ", "_")
        hit = any(k in low if match == "substring" else _has_phrase(low, k) for k in keywords)
        if name in denied or (hit and name not in allowed):
            found.append(name)
    return found


def date_like_columns(columns: Iterable[str], *, match: str = "token") -> list[str]:
    """Columns named like dates; `match="substring"` also takes `status` for its `at`."""
    if match == "substring":
        return [c for c in columns if any(w in c.lower() for w in DATE_WORDS)]
    found = []
    for name in columns:
        parts = _tokens(name)
        if any(w in parts for w in DATE_WORDS if w != "at") or parts[-1:] == ["at"]:
            found.append(name)
    return found


def match_columns(wanted: Iterable[str], actual: Sequence[str]) -> list[str]:
    """Actual column for each wanted one: exact, else equal but for case and blanks."""
    folded: dict[str, str] = {}
    for name in actual:
        folded.setdefault(name.lower().replace(" ", "_"), name)
    found = []
    for name in wanted:
        hit = name if name in actual else folded.get(name.lower().replace(" ", "_"))
        if hit is not None and hit not in found:
            found.append(hit)
    return found


def normalise(name: str) -> str:
    return re.sub(r"[^a-z0-9_]", "_", name.strip().lower())

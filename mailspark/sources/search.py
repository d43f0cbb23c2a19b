"""Predicates of a query as search keys of a mail server.

The keys select at least what the predicate selects, so Spark checks every message that comes back; what they leave out
is never fetched. Days are widened, since a server compares dates without time and zone. Texts are searched by their
plain words: quotes, folds and spaces of a header need not be those of the value. Headers whose encoding a server
cannot decode, and quoted characters, are let through. The date a message was sent is not searched: servers differ in
what they make of a malformed one.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

from pyspark.sql.datasource import (
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

# Names of months in IMAP dates.
_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
_FLAGS = {"seen": ("SEEN", "UNSEEN"), "answered": ("ANSWERED", "UNANSWERED"), "draft": ("DRAFT", "UNDRAFT")}
_TEXTS = {"subject": ["SUBJECT"], "fromFirst": ["FROM", "HEADER Sender"], "toFirst": ["TO"]}
_WIDE = timedelta(days=2)
#: Values of a list up to which each is searched for.
MOST_VALUES = 20


def search_keys(f: Filter, columns: Mapping[str, str]) -> str:
    """Keys for one predicate, '' if none apply; ``columns`` gives the metadata key of a column by its name."""
    negated = isinstance(f, Not)
    inner = f.child if negated else f
    attribute = getattr(inner, "attribute", ())
    key = columns.get(attribute[0]) if len(attribute) == 1 else None
    if key in _FLAGS and isinstance(inner, (EqualTo, EqualNullSafe)) and isinstance(inner.value, bool):
        return _FLAGS[key][inner.value == negated]
    if key is None or negated:
        return ""
    if key == "received":
        return _days(inner)
    if key == "sizeInBytes":
        return _sizes(inner)
    if key in _TEXTS:
        return _texts(inner, _TEXTS[key])
    return ""


def _days(f: Filter) -> str:
    value = getattr(f, "value", None)
    if not isinstance(value, date):
        return ""
    if isinstance(value, datetime):
        value = (value.astimezone(timezone.utc) if value.tzinfo else value).date()
    try:
        since, before = f"SINCE {_day(value - _WIDE)}", f"BEFORE {_day(value + _WIDE + timedelta(days=1))}"
    except OverflowError:
        return ""
    if isinstance(f, (EqualTo, EqualNullSafe)):
        return f"{since} {before}"
    return since if isinstance(f, (GreaterThan, GreaterThanOrEqual)) else before if isinstance(f, (LessThan, LessThanOrEqual)) else ""


def _day(value: date) -> str:
    return f"{value.day}-{_MONTHS[value.month - 1]}-{value.year:04d}"


def _sizes(f: Filter) -> str:
    value = getattr(f, "value", None)
    if isinstance(value, bool) or not isinstance(value, int):
        return ""
    more = {GreaterThan: value, GreaterThanOrEqual: value - 1, EqualTo: value - 1, EqualNullSafe: value - 1}.get(type(f))
    less = {LessThan: value, LessThanOrEqual: value + 1, EqualTo: value + 1, EqualNullSafe: value + 1}.get(type(f))
    keys = [f"LARGER {more}"] * (more is not None and 0 <= more < 1 << 32)
    return " ".join(keys + [f"SMALLER {less}"] * (less is not None and 0 <= less < 1 << 32))


def _texts(f: Filter, fields: list[str]) -> str:
    if isinstance(f, (EqualTo, EqualNullSafe, StringContains, StringStartsWith, StringEndsWith)):
        return _words(f.value, fields)
    if isinstance(f, In) and 0 < len(f.value) <= MOST_VALUES:
        each = [_words(v, fields) for v in f.value]
        return _any([f"({k})" for k in each]) if all(each) else ""
    return ""


def _words(value: object, fields: list[str]) -> str:
    """Each word of a text is in one of the fields, or a field has what a server may not have decoded."""
    words = dict.fromkeys(re.findall(r"[A-Za-z0-9]+", value)) if isinstance(value, str) else ()
    return " ".join(_any([f'{field} "{w}"' for field in fields for w in (word, "=?", r"\\")]) for word in words)


def _any(keys: list[str]) -> str:
    return keys[0] if len(keys) == 1 else f"OR {keys[0]} {_any(keys[1:])}"

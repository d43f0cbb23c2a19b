"""Options of the mail sources and sinks: which exist, their types, defaults and checks."""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import timedelta
from typing import Any

_MICROS = {"us": 1, "ms": 10**3, "s": 10**6, "min": 60 * 10**6, "h": 3600 * 10**6, "d": 86400 * 10**6}

# Duration unit spellings.
_UNITS = {
    "us": "us", "µs": "us", "micro": "us", "microsecond": "us",
    "ms": "ms", "milli": "ms", "millisecond": "ms",
    "": "ms",
    "s": "s", "sec": "s", "second": "s",
    "m": "min", "min": "min", "minute": "min",
    "h": "h", "hour": "h",
    "d": "d", "day": "d",
}


def duration(text: str) -> timedelta:
    found = re.fullmatch(r"\s*(\d+)\s*([A-Za-zµ]*)\s*", text)
    if found:
        unit = found[2].lower()
        unit = _UNITS.get(unit) or _UNITS.get(unit.removesuffix("s"))
        if unit:
            return timedelta(microseconds=int(found[1]) * _MICROS[unit])
    raise ValueError(f"not a duration: {text!r}")


def boolean(text: str) -> bool:
    lowered = text.strip().lower()
    if lowered in ("true", "false"):
        return lowered == "true"
    raise ValueError(f"not a boolean: {text!r}")


def at_least(low: int) -> Callable[[str], int]:
    def parse(text: str) -> int:
        value = int(text)
        if value < low:
            raise ValueError(f"must be at least {low}: {text!r}")
        return value

    return parse


def one_of(*names: str) -> Callable[[str], str]:
    def parse(text: str) -> str:
        if text.strip().lower() in names:
            return text.strip().lower()
        raise ValueError(f"must be one of {', '.join(names)}: {text!r}")

    return parse


def names(text: str) -> list[str]:
    return [n.strip() for n in text.split(",") if n.strip()]


@dataclass(frozen=True)
class Option:
    parse: Callable[[str], Any] = str
    default: Any = None


FORMATS = ("raw", "json", "csv", "xml", "avro")
MODES = ("all", "new", "current")

ACCOUNT_SPEC = {
    "host": Option(),
    "port": Option(at_least(1)),
    "user": Option(),
    "password": Option(),
    # name of an environment variable holding the password, so that no table stores it
    "password-env": Option(),
    "ssl": Option(boolean, False),
    "connection.timeout": Option(duration, timedelta(minutes=1)),
}
_CONTENT = {
    "format": Option(one_of(*FORMATS), "raw"),
    "content-columns": Option(names, []),
}

CATALOG_SPEC = {**ACCOUNT_SPEC, "archive": Option()}

IMAP_SPEC = {
    **ACCOUNT_SPEC,
    **_CONTENT,
    "folder": Option(str, "INBOX"),
    "mode": Option(one_of(*MODES), "all"),
    "offset": Option(at_least(1)),
    "batch-size": Option(at_least(1), 50),
    "interval": Option(duration, timedelta(seconds=1)),
    "heartbeat.interval": Option(duration, timedelta(minutes=15)),
    "max-connections": Option(at_least(1), 4),
    # read a folder of this archive instead of a server
    "archive": Option(),
    # let the server search by predicates of the query; false for one whose search cannot be relied on
    "search": Option(boolean, True),
    # files of an archive that a stream takes at once; without it all there are
    "max-files": Option(at_least(1)),
    # "archive" returns undecoded messages in the archive schema
    "layout": Option(one_of("declared", "archive"), "declared"),
}

SMTP_SPEC = {
    **ACCOUNT_SPEC,
    **_CONTENT,
    # append the mail to a folder of this archive instead of sending it
    "spool": Option(),
    "folder": Option(str, "OUTBOX"),
    # folder of notes on what the server took and refused; what it names as taken is not sent again
    "journal": Option(),
    "journal-run": Option(),
    # column whose value names a row; part of its Message-ID
    "message-key": Option(),
    # timestamp column that is the Date of the mail; the time of sending without it or where it is null
    "date-column": Option(),
}

# Keys Spark itself adds to the options of a table or a stream.
_IGNORED = {"path", "serialization.format", "checkpointlocation", "queryname"}


@dataclass(frozen=True)
class MailOptions:
    """Parsed options plus the free-form ``metadata.<column>`` and ``<format>.<name>`` ones."""

    values: dict[str, Any]
    aliases: dict[str, str] = field(default_factory=dict)
    format_options: dict[str, str] = field(default_factory=dict)
    given: frozenset[str] = frozenset()

    def __getitem__(self, key: str) -> Any:
        return self.values[key]

    @property
    def password(self) -> str | None:
        name = self.values.get("password-env")
        if name:
            if name not in os.environ:
                raise ValueError(f"environment variable {name!r} named by password-env is not set")
            return os.environ[name]
        return self.values.get("password")

    @property
    def uses_authentication(self) -> bool:
        """Log in exactly when a password is given."""
        return bool(self.values.get("password-env")) or self.values.get("password") is not None

    @classmethod
    def parse(
        cls, options: Mapping[str, str], spec: Mapping[str, Option], substitute: str | None = None
    ) -> "MailOptions":
        """Check options against a spec; ``substitute`` names the option that can stand in for a host."""
        values = {key: option.default for key, option in spec.items()}
        aliases, format_options, given = {}, {}, set()
        for raw_key, text in options.items():
            key = raw_key.lower()
            head, _, tail = key.partition(".")
            if key in spec:
                try:
                    values[key] = spec[key].parse(str(text))
                except ValueError as e:
                    raise ValueError(f"Invalid value for option '{key}': {e}") from None
                given.add(key)
            elif head == "metadata" and tail and "format" in spec:
                aliases[tail] = str(text)
            elif head in FORMATS and tail and "format" in spec:
                format_options[key] = str(text)
            elif key not in _IGNORED:
                raise ValueError(f"Unsupported option '{raw_key}'; supported options: {', '.join(sorted(spec))}")
        if values.get("host") is None and not (substitute and values.get(substitute)):
            raise ValueError("Missing required option 'host'")
        if "heartbeat.interval" in given:
            warnings.warn("heartbeat.interval has no effect: no connection is kept idle", stacklevel=2)
        wanted = values.get("format")
        prefix = f"{wanted}."
        own = {k[len(prefix):]: v for k, v in format_options.items() if k.startswith(prefix)}
        if len(own) < len(format_options):
            other = next(k for k in format_options if not k.startswith(prefix))
            raise ValueError(f"Option '{other}' does not belong to format '{wanted}'")
        return cls(values, aliases, own, frozenset(given))


def check_mode(options: MailOptions, streaming: bool) -> None:
    """A batch read is bounded and a stream is not; refuse the mode that contradicts the call."""
    mode = options["mode"]
    if streaming and mode == "current":
        raise ValueError(
            "mode 'current' is a bounded read: use spark.read, or mode 'all' with trigger(availableNow=True)"
        )
    if not streaming and mode == "new":
        raise ValueError("mode 'new' reads mail that is yet to arrive: use spark.readStream")
    if mode == "new" and "offset" in options.given:
        raise ValueError("option 'offset' selects existing mail and cannot be combined with mode 'new'")

"""Spark data source ``smtp``: every row written is one mail sent."""

from __future__ import annotations

import base64
import csv
import hashlib
import io
import json
import re
import smtplib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from email.utils import format_datetime
from typing import Any

from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import BinaryType, StructType

from mailspark import metadata as M
from mailspark.functions import patterns as P
from mailspark.functions.formats import check_raw
from mailspark.options import SMTP_SPEC, MailOptions
from mailspark.sources.journal import Journal, message_id
from mailspark.sources.message import format_address, mailboxes, parse_address
from mailspark.sources.transport import SmtpTransport

_EOL = "\r\n"
_COMPOSED_COLUMNS = {"raw", "envelope_from", "envelope_to"}


@dataclass
class Sent(WriterCommitMessage):
    count: int


# -- one row -> one message, as mailspark.operators.outbox does for whole DataFrames ----------------


def _words(text: str) -> str:
    chunks = [text[i:i + 11] for i in range(0, len(text), 11)]
    return f"{_EOL} ".join(f"=?UTF-8?B?{base64.b64encode(c.encode()).decode()}?=" for c in chunks)


def _decode_address(text: str) -> tuple[str | None, str]:
    if not re.search(P.VALID_ADDRESS, text) or re.search(P.LINE_BREAK, text):
        raise ValueError(f"Illegal address: {text}")
    return parse_address(text)


def _header_address(name: str | None, address: str) -> str:
    if name is not None and re.search(r"[^ -~]", name):
        return f"{_words(name)} <{address}>"
    return format_address(name, address)


def _subject_header(subject: str | None) -> str:
    if subject is None:
        return ""
    if re.search(P.LINE_BREAK, subject):
        raise ValueError(f"Line break in subject: {subject}")
    if re.search(P.NEEDS_ENCODING, subject):
        return f"Subject: {_words(subject)}{_EOL}"
    folded = re.sub(r"([^\r\n]{60,}?[^ ])(?= [^ ])", r"\1" + _EOL, subject)
    return f"Subject: {folded}{_EOL}"


def _base64_lines(data: bytes) -> str:
    letters = base64.b64encode(data).decode()
    return _EOL.join(letters[i:i + 76] for i in range(0, len(letters), 76))


def _body_part(content: str | bytes | None) -> str:
    kind = f"Content-Type: text/plain; charset=UTF-8{_EOL}Content-Transfer-Encoding: "
    content = "" if content is None else content
    if isinstance(content, str) and not re.search(P.NEEDS_BASE64, content):
        return f"{kind}7bit{_EOL}{_EOL}{content}"
    data = content.encode() if isinstance(content, str) else bytes(content)
    return f"{kind}base64{_EOL}{_EOL}{_base64_lines(data)}"


def _json(value: Any) -> Any:
    if isinstance(value, Row):
        return {k: _json(v) for k, v in value.asDict().items()}
    if isinstance(value, (list, tuple)):
        return [_json(v) for v in value]
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    raise ValueError(f"{type(value).__name__} values are not encoded by INSERT; use mailspark.send")


class Composer:
    """Row -> (envelope sender, envelope recipients, raw message)."""

    def __init__(self, schema: StructType, options: MailOptions):
        self.options = options
        key = options["message-key"]
        layout = M.Layout.of(schema, options.aliases, options["content-columns"], M.WRITABLE)
        self.by_key = {c.key: c.name for c in layout.metadata}
        self.date = options["date-column"]
        self.content = [c for c in layout.content if c.name not in (key, self.date)]
        self.format = options["format"]
        if self.content:
            if self.format == "raw":
                check_raw(self.content)
            elif self.format not in ("json", "csv") or options.format_options:
                raise ValueError(
                    f"format '{self.format}' with these options is not encoded by INSERT; use mailspark.send"
                )

    def _encode(self, row: Row) -> str | bytes | None:
        values = [row[c.name] for c in self.content]
        if self.format == "raw":
            return values[0]
        if self.format == "json":
            named = {c.name: _json(v) for c, v in zip(self.content, values)}
            return json.dumps(named, separators=(",", ":"), ensure_ascii=False)
        line = io.StringIO()
        cells = ["" if v is None else str(v).lower() if isinstance(v, bool) else v for v in values]
        csv.writer(line, lineterminator="").writerow(cells)
        return line.getvalue()

    def __call__(self, row: Row) -> tuple[str, list[str], bytes]:
        lists = {
            k: [_decode_address(a) for a in row[name] or [] if a is not None]
            for k, name in self.by_key.items()
            if k != "subject"
        }
        head = ""
        for key, title in {"from": "From", "to": "To", "cc": "Cc", "replyTo": "Reply-To"}.items():
            if lists.get(key):
                head += f"{title}: " + f",{_EOL} ".join(_header_address(*a) for a in lists[key]) + _EOL
        head += _subject_header(row[self.by_key["subject"]] if "subject" in self.by_key else None)
        part = _body_part(self._encode(row)) if self.content else ""
        recipients = [m for k in ("to", "cc", "bcc") for _, address in lists.get(k, []) for m in mailboxes(address)]
        key = str(row[self.options["message-key"]]) if self.options["message-key"] else ""
        digest = hashlib.sha256("\n".join([key, ",".join(recipients), head, part]).encode()).hexdigest()
        sent = (row[self.date] if self.date else None) or datetime.now(timezone.utc)
        date = re.sub(r"^(\w+, )0", r"\1", format_datetime(sent.astimezone(timezone.utc)))
        head += f"Date: {date}{_EOL}Message-ID: <{digest}@mailspark.invalid>{_EOL}MIME-Version: 1.0{_EOL}"
        if self.content:
            boundary = f"=_{digest[:32]}"
            raw = (
                f'{head}Content-Type: multipart/mixed;{_EOL} boundary="{boundary}"{_EOL}{_EOL}'
                f"--{boundary}{_EOL}{part}{_EOL}--{boundary}--{_EOL}"
            )
        else:
            raw = f"{head}Content-Type: text/plain; charset=us-ascii{_EOL}{_EOL}"
        if not recipients:
            raise ValueError(f"No recipient addresses: <{digest}@mailspark.invalid>")
        senders = [address for _, address in lists.get("from", [])]
        return (senders or [self.options["user"] or ""])[0], recipients, raw.encode()


def _composed(row: Row) -> tuple[str, list[str], bytes]:
    return row["envelope_from"], list(row["envelope_to"]), bytes(row["raw"])


class _Sender:
    """Sends the rows of one task over one connection."""

    def __init__(self, source: "SmtpDataSource", schema: StructType):
        self.source = source
        names = {f.name for f in schema}
        is_composed = _COMPOSED_COLUMNS <= names and isinstance(schema["raw"].dataType, BinaryType)
        self.message = _composed if is_composed else Composer(schema, source.mail)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        server, count, journal = None, 0, self._journal()
        try:
            for row in iterator:
                sender, recipients, raw = self.message(row)
                if journal and message_id(raw) in journal.known:
                    continue
                server = server or self.source.connect()
                refused = server.send(sender, recipients, raw) or {}
                if journal:
                    journal.note(message_id(raw), recipients, refused)
                elif refused:
                    raise smtplib.SMTPRecipientsRefused(refused)
                count += 1
        finally:
            if journal:
                journal.save()
            if server is not None:
                server.close()
        return Sent(count)

    def _journal(self) -> Journal | None:
        options = self.source.mail
        if not options["journal"]:
            return None
        task = TaskContext.get()
        place = (task.partitionId(), task.attemptNumber()) if task else (0, 0)
        return Journal(options["journal"], options["journal-run"] or uuid.uuid4().hex, *place)


class SmtpWriter(_Sender, DataSourceWriter):
    pass


class SmtpStreamWriter(_Sender, DataSourceStreamWriter):
    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        pass

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        pass


class SmtpDataSource(DataSource):
    """``smtp``: append only; rows of a table declared with writable columns, or composed messages."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.mail = MailOptions.parse(options, SMTP_SPEC)

    @classmethod
    def name(cls) -> str:
        return "smtp"

    def connect(self) -> Any:
        return SmtpTransport(self.mail)

    def schema(self) -> str:
        return "raw binary, envelope_from string, envelope_to array<string>"

    def reader(self, schema: StructType) -> Any:
        raise ValueError("An outbox cannot be read")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("Mail that was sent cannot be overwritten: use mode append")
        return SmtpWriter(self, schema)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return SmtpStreamWriter(self, schema)

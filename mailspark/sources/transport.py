"""Thin access to mail servers and to archives, one interface for the readers.

``status`` gives (uidvalidity, uid_next), ``splits`` cuts a uid range into independently readable
parts, all of it or what search keys select, ``fetch`` yields the messages of one part as dictionaries keyed by archive column.
"""

from __future__ import annotations

import base64
import imaplib
import re
import smtplib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime
from functools import lru_cache
from typing import Any

from mailspark.options import MailOptions


#: Bytes of messages that are fetched at once, unless a single one has more.
PAGE_BYTES = 16 << 20
#: Messages of an archive that are read at once, and bytes of a column.
PAGE_ROWS, _BUFFER = 4096, 1 << 20
#: What a message costs besides its bytes.
_MESSAGE = 1 << 10
#: Messages whose sizes are asked for at once, and characters of a list of uids in one command.
_SIZES, _LETTERS = 2000, 4000


@dataclass(frozen=True)
class Split:
    """Messages start <= uid < end of a folder; ``files`` when they lie in an archive.

    ``pages`` are the uid sets to fetch one after another, when the uids and sizes are known.
    """

    start: int
    end: int
    files: tuple[str, ...] = ()
    pages: tuple[str, ...] = ()


def uid_splits(start: int, end: int, page: int, most: int) -> list[Split]:
    """At most ``most`` ranges of whole pages that cover [start, end); none for an empty range."""
    if start >= end:
        return []
    pages = -(-(end - start) // page)
    width = -(-pages // most) * page
    return [Split(s, min(s + width, end)) for s in range(start, end, width)]


def even_splits(uids: list[int], costs: list[int], page: int, most: int, dense: bool) -> list[Split]:
    """At most ``most`` splits of messages of about equal cost, each in pages; none without messages.

    A page has up to ``page`` messages and ``PAGE_BYTES``; a larger message is a page of its own. ``dense`` says that
    all messages between two uids are meant, so that a page can be named by its ends.
    """
    if not uids:
        return []
    ends, total = [], 0
    for cost in costs:
        total += cost + _MESSAGE
        ends.append(total)
    parts = min(most, -(-len(uids) // page))
    # a message belongs to the split in which its middle lies
    cuts = [bisect_left(ends, 0)]
    for k in range(1, parts):
        at = bisect_left(ends, total * k / parts)
        before = ends[at - 1] if at else 0
        cuts.append(at + (total * k / parts - before > (ends[at] - before) / 2))
    cuts = sorted({*cuts, len(uids)})
    return [Split(uids[a], uids[b - 1] + 1, pages=tuple(_pages(uids[a:b], costs[a:b], page, dense))) for a, b in zip(cuts, cuts[1:])]


def _pages(uids: list[int], costs: list[int], page: int, dense: bool) -> Iterator[str]:
    first, held, letters = 0, 0, 0
    for i, cost in enumerate(costs):
        letters += len(str(uids[i])) + 1
        if i > first and (i - first >= page or held + cost > PAGE_BYTES or not dense and letters > _LETTERS):
            yield uid_set(uids[first:i], dense)
            first, held, letters = i, 0, 0
        held += cost
    yield uid_set(uids[first:], dense)


def uid_set(uids: list[int], dense: bool = False) -> str:
    """Ascending uids as a set of ranges; ``dense`` as one range."""
    if dense:
        return f"{uids[0]}:{uids[-1]}"
    ranges: list[list[int]] = []
    for uid in uids:
        if ranges and uid == ranges[-1][1] + 1:
            ranges[-1][1] = uid
        else:
            ranges.append([uid, uid])
    return ",".join(str(a) if a == b else f"{a}:{b}" for a, b in ranges)


@lru_cache(16)
def _bounds(numbers: str) -> tuple[list[int], list[int]]:
    ranges = [r.split(":") for r in numbers.split(",")]
    return [int(r[0]) for r in ranges], [int(r[-1]) for r in ranges]


def in_set(uid: int, numbers: str) -> bool:
    """Whether a uid is in an ascending set of ranges."""
    firsts, lasts = _bounds(numbers)
    at = bisect_right(firsts, uid) - 1
    return at >= 0 and uid <= lasts[at]


class ImapTransport:
    """One IMAP connection, opened on first use and closed by ``close``."""

    def __init__(self, options: MailOptions):
        self.options = options
        self._connection: imaplib.IMAP4 | None = None

    @property
    def connection(self) -> imaplib.IMAP4:
        if self._connection is None:
            o = self.options
            kind = imaplib.IMAP4_SSL if o["ssl"] else imaplib.IMAP4
            port = o["port"] or (imaplib.IMAP4_SSL_PORT if o["ssl"] else imaplib.IMAP4_PORT)
            connection = kind(o["host"], port, timeout=o["connection.timeout"].total_seconds())
            if o.uses_authentication:
                connection.login(o["user"] or "", o.password)
            elif connection.state == "NONAUTH" and "AUTH=ANONYMOUS" in connection.capabilities:
                connection.authenticate("ANONYMOUS", lambda _: b"mailspark")
            self._connection = connection
        return self._connection

    def close(self) -> None:
        """End the connection; what goes wrong then must not hide what went wrong before."""
        connection, self._connection = self._connection, None
        if connection is not None:
            with suppress(OSError, imaplib.IMAP4.error):
                connection.logout()

    def folders(self) -> list[tuple[str, bool]]:
        """(name, holds messages) of every folder at any depth."""
        _, lines = self.connection.list('""', "*")
        found = []
        for line in lines:
            if not line:
                continue
            text = b" ".join(line) if isinstance(line, tuple) else line
            match = re.match(rb'\(([^)]*)\) (?:"(?:[^"\\]|\\.)*"|NIL) (?:\{\d+\} ?)?(.*)$', text, re.S)
            if match:
                flags = match[1].lower().split()
                holds = b"\\noselect" not in flags and b"\\nonexistent" not in flags
                found.append((folder_name(match[2].strip()), holds))
        return found

    def status(self, folder: str) -> tuple[int, int]:
        quoted = quoted_folder(folder)
        kind, answer = self.connection.select(quoted, readonly=True)
        if kind != "OK":
            raise ValueError(f"Folder '{folder}' not found: {answer}")
        _, lines = self.connection.status(quoted, "(UIDVALIDITY UIDNEXT)")
        text = b" ".join(x for x in lines if x)
        return tuple(int(re.search(rb"%s (\d+)" % item, text)[1]) for item in (b"UIDVALIDITY", b"UIDNEXT"))

    def splits(self, folder: str, start: int, end: int, columns: Iterable[str] = (), keys: str = "") -> list[Split]:
        """Splits of even size: by the messages there are, and by their bytes if bodies are fetched.

        A range that makes one split of one page, without keys to search by, is not looked at before.
        """
        page, most = self.options["batch-size"], self.options["max-connections"]
        if start >= end or not keys and end - start <= page:
            return uid_splits(start, end, page, most)
        self._select(folder)
        uids = self._search(start, end, keys)
        if not uids:
            return []
        costs = self._sizes(uids, not keys) if "body" in columns else [0] * len(uids)
        return even_splits(uids, costs, page, most, not keys)

    def _select(self, folder: str) -> None:
        """Read-only, so that no message becomes seen."""
        kind, answer = self.connection.select(quoted_folder(folder), readonly=True)
        if kind != "OK":
            raise ValueError(f"Folder '{folder}' not found: {answer}")

    def _search(self, start: int, end: int, keys: str) -> list[int]:
        """The uids that match, in order."""
        kind, data = self.connection.uid("SEARCH", f"UID {start}:{end - 1}{' ' * bool(keys)}{keys}")
        if kind != "OK":
            raise OSError(f"SEARCH {keys} failed: {data}")
        found = {int(uid) for line in data if line for uid in line.split()}
        return sorted(uid for uid in found if start <= uid < end)

    def _sizes(self, uids: list[int], dense: bool) -> list[int]:
        sizes: dict[int, int] = {}
        for numbers in _pages(uids, [0] * len(uids), _SIZES, dense):
            kind, data = self.connection.uid("FETCH", numbers, "(UID RFC822.SIZE)")
            if kind != "OK":
                raise OSError(f"FETCH {numbers} failed: {data}")
            sizes.update((m["uid"], m.get("size", 0)) for m in parse_fetch(data))
        return [sizes.get(uid, 0) for uid in uids]

    def fetch(self, folder: str, split: Split, columns: Iterable[str]) -> Iterator[dict[str, Any]]:
        """Page through a split."""
        self._select(folder)
        items = f"({' '.join(fetch_items(columns))})"
        page = self.options["batch-size"]
        ranges = (f"{first}:{min(first + page, split.end) - 1}" for first in range(split.start, split.end, page))
        for numbers in split.pages or ranges:
            kind, data = self.connection.uid("FETCH", numbers, items)
            if kind != "OK":
                raise OSError(f"FETCH {numbers} failed: {data}")
            found: dict[int, dict[str, Any]] = {}
            for message in parse_fetch(data):  # a server may add answers of its own, such as new flags
                found.setdefault(message["uid"], {}).update(message)
            for uid, message in found.items():
                if in_set(uid, numbers) and is_whole(message, columns):
                    yield message


def fetch_items(columns: Iterable[str]) -> list[str]:
    """Items to ask the server for, given the archive columns needed."""
    columns = set(columns)
    items = ["UID"]
    if "internal_date" in columns:
        items.append("INTERNALDATE")
    if "size" in columns:
        items.append("RFC822.SIZE")
    if "flags" in columns:
        items.append("FLAGS")
    if "body" in columns:
        items.append("BODY.PEEK[]")
    elif "head" in columns:
        items.append("BODY.PEEK[HEADER]")
    return items


def is_whole(message: dict[str, Any], columns: Iterable[str]) -> bool:
    """Whether the server has answered what was asked, not only told a change of flags."""
    columns = set(columns)
    if columns & {"head", "body"}:
        return "head" in message
    asked = columns & {"internal_date", "size"}
    return not asked or bool(asked & message.keys())


def parse_fetch(data: Iterable[Any]) -> Iterator[dict[str, Any]]:
    """Answers of one FETCH -> messages; sequence numbers without data are skipped."""
    attributes, literal = b"", None
    for part in data:
        if part is None:
            continue
        if isinstance(part, tuple):
            attributes += part[0]
            literal = part[1]
            continue
        attributes += part
        uid = re.search(rb"\bUID (\d+)", attributes)
        if uid:
            yield _message(int(uid[1]), attributes, literal)
        attributes, literal = b"", None


def _message(uid: int, attributes: bytes, literal: bytes | None) -> dict[str, Any]:
    message: dict[str, Any] = {"uid": uid}
    date = re.search(rb'INTERNALDATE "([^"]+)"', attributes)
    if date:
        message["internal_date"] = datetime.strptime(date[1].decode().strip(), "%d-%b-%Y %H:%M:%S %z")
    size = re.search(rb"RFC822\.SIZE (\d+)", attributes)
    if size:
        message["size"] = int(size[1])
    flags = re.search(rb"FLAGS \(([^)]*)\)", attributes)
    if flags:
        message["flags"] = flags[1].decode().split()
    if literal is not None:
        message["head"], message["body"] = cut(literal)
    return message


def cut(raw: bytes) -> tuple[bytes, bytes]:
    """Raw message -> head with its blank line, body."""
    found = re.match(rb"\r?\n", raw) or re.search(rb"\n\r?\n", raw)
    at = found.end() if found else len(raw)
    return raw[:at], raw[at:]


def folder_name(text: bytes) -> str:
    """Folder name as listed by a server (quoted, modified UTF-7) -> text."""
    if text.startswith(b'"'):
        text = re.sub(rb"\\(.)", rb"\1", text[1:-1])

    def shifted(match: re.Match) -> str:
        letters = match[1].replace(",", "/")
        return base64.b64decode(letters + "=" * (-len(letters) % 4)).decode("utf-16-be") if letters else "&"

    return re.sub(r"&([^-]*)-", shifted, text.decode("ascii", "replace"))


def quoted_folder(name: str) -> str:
    """Text -> quoted folder name in modified UTF-7."""

    def shifted(match: re.Match) -> str:
        letters = base64.b64encode(match[0].encode("utf-16-be")).decode().rstrip("=")
        return f"&{letters.replace('/', ',')}-"

    plain = re.sub(r"[^ -~]+", shifted, name.replace("&", "&-"))
    return '"' + re.sub(r'(["\\])', r"\\\1", plain) + '"'


def _columns(group: Any) -> Iterator[Any]:
    return (group.column(i) for i in range(group.num_columns))


def _may_hold(group: Any, start: int, end: int) -> bool:
    """Whether a row group can have uids in [start, end)."""
    known = [c.statistics for c in _columns(group) if c.path_in_schema == "uid" and c.is_stats_set]
    return all(not s.has_min_max or s.max >= start and s.min < end for s in known)


def _stored_bytes(group: Any, names: Iterable[str]) -> int:
    """Bytes of some columns of a row group before compression."""
    names = set(names)
    return sum(c.total_uncompressed_size for c in _columns(group) if c.path_in_schema.split(".")[0] in names)


class ArchiveTransport:
    """A folder of an archive, read file by file."""

    def __init__(self, options: MailOptions):
        from pyarrow import fs

        self.options = options
        path = options["archive"].rstrip("/")
        if "://" in path or path.startswith("file:"):
            self.filesystem, self.root = fs.FileSystem.from_uri(path)
        else:
            self.filesystem, self.root = fs.LocalFileSystem(), path

    def close(self) -> None:
        pass

    def _state(self) -> Any:
        from pyarrow import fs

        from mailspark.sources.ledger import State, newest

        place = f"{self.root}/ledger"
        listed = self.filesystem.get_file_info(fs.FileSelector(place, allow_not_found=True))
        name = newest([f.base_name for f in listed])
        if name is None:
            return State()
        with self.filesystem.open_input_stream(f"{place}/{name}") as stream:
            return State.of(stream.read().decode())

    def folders(self) -> list[tuple[str, bool]]:
        return [(name, f.holds_messages) for name, f in sorted(self._state().folders.items())]

    def status(self, folder: str) -> tuple[int, int]:
        found = self._state().folders.get(folder)
        if found is None:
            raise ValueError(f"Folder '{folder}' not found in {self.options['archive']}")
        return found.uidvalidity, found.uid_next

    def splits(self, folder: str, start: int, end: int, columns: Iterable[str] = (), keys: str = "") -> list[Split]:
        """One split per file of the folder's parts; row groups are pruned by uid when read."""
        if start >= end:
            return []
        parts = self._state().parts_of(folder, start, end - 1)
        return [Split(max(start, p.first), min(end, p.last + 1), (f,)) for p in parts for f in self._files(p.append, folder)]

    def _files(self, append: str, folder: str) -> list[str]:
        from pyarrow import fs

        from mailspark.sources.archive import directory_name

        place = f"{self.root}/messages/append={append}/folder={directory_name(folder)}"
        return sorted(f.path for f in self.filesystem.get_file_info(fs.FileSelector(place)) if f.path.endswith(".parquet"))

    def _batches(self, files: Iterable[str], start: int, end: int, columns: list[str]) -> Iterator[Any]:
        """Arrow batches of at most ``PAGE_ROWS`` messages and, by the sizes in the footer, ``PAGE_BYTES``, or one message.

        Column chunks are read page by page, so that a task holds no more of a large file than of a small one.
        """
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        for file in files:
            with self.filesystem.open_input_file(file) as opened:
                stored = pq.ParquetFile(opened, buffer_size=_BUFFER, pre_buffer=False)
                for group in range(stored.num_row_groups):
                    found = stored.metadata.row_group(group)
                    if not found.num_rows or not _may_hold(found, start, end):
                        continue
                    names = list(dict.fromkeys(["uid", *columns]))
                    rows = max(1, min(PAGE_ROWS, PAGE_BYTES * found.num_rows // max(1, _stored_bytes(found, names))))
                    for batch in stored.iter_batches(rows, row_groups=[group], columns=names, use_threads=False):
                        uid = batch.column("uid")
                        yield batch.filter(pc.and_(pc.greater_equal(uid, start), pc.less(uid, end))).select(columns)

    def fetch(self, folder: str, split: Split, columns: Iterable[str]) -> Iterator[dict[str, Any]]:
        page = self.options["batch-size"]
        for batch in self._batches(split.files, split.start, split.end, list(dict.fromkeys(["uid", *columns]))):
            for first in range(0, batch.num_rows, page):
                yield from batch.slice(first, page).to_pylist()

    def read_range(self, folder: str, first: int, last: int, columns: list[str]) -> Iterator[Any]:
        """Arrow batches of a uid range that one append has published, wherever its messages lie by now."""
        import pyarrow as pa

        parts = self._state().parts_of(folder, first, last)
        if len(parts) != 1 or parts[0].first > first or parts[0].last < last:
            raise OSError(f"uids {first} to {last} of folder '{folder}' are not in one part: {parts}")
        files = self._files(parts[0].append, folder)
        for batch in self._batches(files, first, last + 1, [c for c in columns if c != "folder"]):
            if batch.num_rows:
                named = pa.array([folder] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([named if c == "folder" else batch.column(c) for c in columns], columns)


class SmtpTransport:
    """One SMTP connection for all messages of a task."""

    def __init__(self, options: MailOptions):
        o = options
        kind = smtplib.SMTP_SSL if o["ssl"] else smtplib.SMTP
        self._connection = kind(o["host"], o["port"] or 0, timeout=o["connection.timeout"].total_seconds())
        if o.uses_authentication:
            self._connection.login(o["user"] or "", o.password)

    def send(self, sender: str, recipients: list[str], raw: bytes) -> dict[str, tuple[int, bytes]]:
        """Recipients that the server refused, with its answer to each."""
        try:
            return self._connection.sendmail(sender, recipients, raw)
        except smtplib.SMTPRecipientsRefused as e:  # all of them
            return e.recipients

    def close(self) -> None:
        """End the connection; all mail has been taken over by then."""
        with suppress(OSError, smtplib.SMTPException):
            self._connection.quit()

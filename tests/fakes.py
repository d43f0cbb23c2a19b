"""Stand-ins for mail servers: a folder on disk, so that driver and Python workers see the same state."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

from mailspark.options import CATALOG_SPEC, MailOptions
from mailspark.sources.imap import FoldersDataSource, ImapDataSource
from mailspark.sources.smtp import SmtpDataSource
from mailspark.sources.transport import cut, even_splits, fetch_items, in_set, uid_splits


class Server:
    """Account state under a directory; ``host`` of the options names it."""

    def __init__(self, place: str):
        self.place = Path(place)
        self.state = self.place / "state.json"

    def read(self) -> dict:
        return json.loads(self.state.read_text())

    def write(self, state: dict) -> None:
        self.place.mkdir(parents=True, exist_ok=True)
        self.state.write_text(json.dumps(state))

    def create(self, *folders: str, holds: bool = True) -> "Server":
        state = self.read() if self.state.exists() else {}
        for folder in folders:
            state[folder] = {"validity": 1, "next": 1, "holds": holds, "mail": {}}
        self.write(state)
        return self

    def deliver(self, folder: str, raw: bytes, flags: tuple[str, ...] = (), uid: int | None = None) -> int:
        state = self.read()
        uid = uid or state[folder]["next"]
        state[folder]["mail"][str(uid)] = [raw.decode("latin-1"), list(flags)]
        state[folder]["next"] = uid + 1
        self.write(state)
        return uid

    def change(self, folder: str, **values) -> None:
        state = self.read()
        state[folder].update(values)
        self.write(state)

    def log(self, line: str) -> None:
        with (self.place / "log").open("a") as out:
            out.write(line + "\n")

    def logged(self, start: str) -> list[str]:
        path = self.place / "log"
        return [x for x in path.read_text().splitlines() if x.startswith(start)] if path.exists() else []


def matches(keys: str, raw: bytes, flags: list[str]) -> bool:
    """Whether a message has what search keys ask for, as the protocol defines them."""
    import email
    import email.policy
    import re

    words = re.findall(r'"(?:[^"\\]|\\.)*"|[()]|[^\s()]+', keys)
    message = email.message_from_bytes(cut(raw)[0], policy=email.policy.default)
    received = datetime(2024, 5, 6)

    def contains(header: str) -> bool:
        text = re.sub(r"\\(.)", r"\1", words.pop(0)[1:-1]).lower()
        return any(text in v.lower() for v in message.get_all(header, []))

    def one() -> bool:
        key = words.pop(0)
        if key == "(":
            found = True
            while words[0] != ")":
                found &= one()
            words.pop(0)
            return found
        if key == "OR":
            a, b = one(), one()
            return a or b
        if key in ("SEEN", "ANSWERED", "DRAFT"):
            return "\\" + key.capitalize() in flags
        if key in ("UNSEEN", "UNANSWERED", "UNDRAFT"):
            return "\\" + key[2:].capitalize() not in flags
        if key in ("SINCE", "BEFORE"):
            day = datetime.strptime(words.pop(0), "%d-%b-%Y")
            return received >= day if key == "SINCE" else received < day
        if key in ("LARGER", "SMALLER"):
            n = int(words.pop(0))
            return len(raw) > n if key == "LARGER" else len(raw) < n
        return contains(words.pop(0) if key == "HEADER" else key)

    found = True
    while words:
        found &= one()
    return found


class FakeImapConnection:
    def __init__(self, options: MailOptions):
        self.options = options
        self.server = Server(options["host"])
        if options.uses_authentication:
            self.server.log(f"login {options['user']} {options.password}")
        else:
            self.server.log("anonymous")

    def close(self):
        self.server.log("close")

    def folders(self):
        return [(name, f["holds"]) for name, f in self.server.read().items()]

    def status(self, folder):
        state = self.server.read()
        if folder not in state:
            raise ValueError(f"Folder '{folder}' not found")
        return state[folder]["validity"], state[folder]["next"]

    def splits(self, folder, start, end, columns=(), keys=""):
        if not keys:
            return uid_splits(start, end, self.options["batch-size"], self.options["max-connections"])
        self.server.log(f"search {start} {end} {keys}")
        mail = {int(u): (raw.encode("latin-1"), flags) for u, (raw, flags) in self.server.read()[folder]["mail"].items()}
        found = [u for u, m in sorted(mail.items()) if start <= u < end and matches(keys, *m)]
        return even_splits(found, [len(mail[u][0]) for u in found], self.options["batch-size"], self.options["max-connections"], False)

    def fetch(self, folder, split, columns):
        self.server.log(f"fetch {split.start} {split.end} {' '.join(fetch_items(columns))}")
        for uid, (raw, flags) in self.server.read()[folder]["mail"].items():
            if split.start <= int(uid) < split.end and (not split.pages or any(in_set(int(uid), p) for p in split.pages)):
                head, body = cut(raw.encode("latin-1"))
                stored = {
                    "uid": int(uid),
                    "internal_date": datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc),
                    "flags": flags,
                    "size": len(raw),
                    "head": head,
                    "body": body,
                }
                yield {k: v for k, v in stored.items() if k == "uid" or k in set(columns)}


class FakeImap(ImapDataSource):
    @classmethod
    def name(cls):
        return "fake_imap"

    def connect(self):
        return FakeImapConnection(self.mail)


class FakeNamedImap(FakeImap):
    """Takes the place of the real one."""

    @classmethod
    def name(cls):
        return "imap"


class FakeFolders(FoldersDataSource):
    @classmethod
    def name(cls):
        return "fake_folders"

    def __init__(self, options):
        super().__init__(options)
        self.mail = MailOptions.parse(options, CATALOG_SPEC)

    def connect(self):
        if not Path(self.mail["host"]).exists():
            raise ConnectionRefusedError(self.mail["host"])
        return FakeImapConnection(self.mail)


class FakeSmtpConnection:
    def __init__(self, options: MailOptions):
        self.server = Server(options["host"])
        self.server.log("connect" + (f" {options['user']} {options.password}" if options.uses_authentication else ""))

    def send(self, sender, recipients, raw):
        import uuid

        limit = self.server.place / "dies-after"
        if limit.exists() and len(list(self.server.place.glob("*.mail"))) >= int(limit.read_text()):
            raise ConnectionResetError("gone")
        refused = {r: (550, b"no such user") for r in recipients if r.startswith("refused")}
        sent = {"from": sender, "to": [r for r in recipients if r not in refused], "raw": raw.decode("latin-1")}
        (self.server.place / f"{uuid.uuid4().hex}.mail").write_text(json.dumps(sent))
        return refused

    def close(self):
        self.server.log("quit")


class FakeSmtp(SmtpDataSource):
    @classmethod
    def name(cls):
        return "fake_smtp"

    def connect(self):
        return FakeSmtpConnection(self.mail)


class FakeNamedSmtp(FakeSmtp):
    @classmethod
    def name(cls):
        return "smtp"


def sent(place) -> list[dict]:
    found = [json.loads(p.read_text()) for p in Path(place).glob("*.mail")]
    return sorted(found, key=lambda m: m["raw"])

"""What a server has made of each mail: notes that tasks leave in a shared folder while they send.

A note says for one Message-ID and recipient whether the server took it, or with which code it refused. A task notes
its mails in small files, ``NOTED`` at a time and at its end, however it ends. A task that is tried again leaves out
what an earlier try has noted; a batch or query that runs again leaves out what any run has noted, by a join before it
sends. What a worker that is killed outright has sent since its last file, ``NOTED`` mails at most, is sent again.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import Any

#: Mails of a task in one file of notes.
NOTED = 50
#: What a mail that a server took is noted with.
TAKEN = 250
NOTES = "message_id string, recipient string, code int, reason string"


class Journal:
    """Notes of one try of a task; ``run`` tells runs of a query apart."""

    def __init__(self, path: str, run: str, partition: int, attempt: int):
        from pyarrow import fs

        if "://" in path or path.startswith("file:"):
            self.files, self.path = fs.FileSystem.from_uri(path)
        else:
            self.files, self.path = fs.LocalFileSystem(), path
        self.task = f"{run}-{partition}-"
        self.notes: list[dict[str, Any]] = []
        self.files.create_dir(self.path, recursive=True)
        self.known = self._earlier() if attempt else set()

    def _earlier(self) -> set[str]:
        from pyarrow import fs

        own = [f.path for f in self.files.get_file_info(fs.FileSelector(self.path)) if f.base_name.startswith(self.task)]
        found = set()
        for path in own:
            with self.files.open_input_stream(path) as stream:
                found.update(json.loads(line)["message_id"] for line in stream.read().splitlines())
        return found

    def note(self, message_id: str, recipients: list[str], refused: dict[str, tuple[int, Any]]) -> None:
        for r in recipients:
            code, reason = refused.get(r, (TAKEN, None))
            reason = reason.decode("utf-8", "replace") if isinstance(reason, bytes) else reason
            self.notes.append({"message_id": message_id, "recipient": r, "code": code, "reason": reason})
        self.known.add(message_id)
        if len({n["message_id"] for n in self.notes}) >= NOTED:
            self.save()

    def save(self) -> None:
        if self.notes:
            text = "\n".join(map(json.dumps, self.notes)) + "\n"
            with self.files.open_output_stream(f"{self.path}/{self.task}{uuid.uuid4().hex}.json") as out:
                out.write(text.encode())
            self.notes = []


def message_id(raw: bytes) -> str:
    return re.search(rb"^Message-ID: (<[^>\r\n]*>)", raw, re.M)[1].decode()

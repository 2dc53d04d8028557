"""Senders that write every call to files (workers are separate processes)."""

from __future__ import annotations

import json
import os
import sys

from pyspark import cloudpickle


class FileRecorder:
    """Test sender: appends every call as one JSON line to a file per partition
    under ``folder`` (workers are separate processes, so memory is not shared)."""

    def __init__(self, folder: str):
        os.makedirs(folder, exist_ok=True)
        self.path = os.path.join(folder, f"part-{os.getpid()}-{id(self)}.jsonl")
        self.fh = open(self.path, "a", encoding="utf-8")  # noqa: SIM115
        self.status = 200

    def _rec(self, **kw) -> None:
        self.fh.write(json.dumps(kw) + "\n")
        self.fh.flush()

    def send(self, *args) -> None:
        if args and isinstance(args[0], (bytes, bytearray)):
            payload, host, port = args
            self._rec(kind="udp", payload=payload.decode("utf-8"), host=host, port=port)
        else:
            frm, to, subject, body = args
            self._rec(kind="mail", sender=frm, to=to, subject=subject, body=body)

    def post(self, url: str, body: bytes, content_type: str = "text/plain") -> int:
        self._rec(kind="http", url=url, body=body.decode("utf-8"), content_type=content_type)
        return self.status

    def close(self) -> None:
        self.fh.close()


class RecorderFactory:
    """Picklable factory of ``FileRecorder`` senders (one per partition)."""

    def __init__(self, folder: str, status: int = 200):
        self.folder, self.status = folder, status

    def __call__(self) -> FileRecorder:
        r = FileRecorder(self.folder)
        r.status = self.status
        return r


def read_recorded(folder: str) -> list[dict]:
    out = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as fh:
            out.extend(json.loads(x) for x in fh if x.strip())
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])

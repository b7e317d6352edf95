"""Small control files and directory moves on whatever file system a path names, through Hadoop."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _of(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._of(path)
        return fs.exists(p)

    def delete(self, path: str) -> bool:
        fs, p = self._of(path)
        return fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        fs, p = self._of(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def modified(self, path: str) -> float:
        fs, p = self._of(path)
        return fs.getFileStatus(p).getModificationTime() / 1000

    def rename(self, source: str, target: str) -> None:
        fs, a = self._of(source)
        _, b = self._of(target)
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise OSError(f"{source} couldn't be renamed to {target}")

    def read_text(self, path: str) -> str:
        fs, p = self._of(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Whole or not at all: written beside, then renamed over what is there, so a reader always finds the old text or the new."""
        fs, p = self._of(path)
        _, beside = self._of(f"{path}.{uuid.uuid4().hex}.tmp")
        local = fs.getUri().getScheme() == "file"
        fs = fs.getRawFileSystem() if local else fs  # without checksum files, whose rename would be a second step
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if local:  # a rename there replaces the target
            if not fs.rename(beside, p):
                raise OSError(f"{path} couldn't be written")
            return
        kind = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        over = self.jvm.java.lang.reflect.Array.newInstance(kind, 1)
        over[0] = next(o for o in kind.getEnumConstants() if o.toString() == "OVERWRITE")
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(fs.makeQualified(beside), fs.makeQualified(p), over)

    def swap(self, fresh: str, path: str) -> None:
        """Put a folder in another's place; the old one stands aside until the new one is there, and comes back if that fails."""
        self.recover(path)
        if self.exists(path):
            self.rename(path, f"{path}__old")
        try:
            self.rename(fresh, path)
        except Exception:
            self.recover(path)
            raise
        self.delete(f"{path}__old")

    def recover(self, path: str) -> None:
        """After a swap that broke off: the old folder is put back if it is the only one, else it goes."""
        old = f"{path}__old"
        if self.exists(old):
            if self.exists(path):
                self.delete(old)
            else:
                self.rename(old, path)

    def read_json(self, path: str, default=None):
        return json.loads(self.read_text(path)) if self.exists(path) else default

    def write_json(self, path: str, value) -> None:
        self.write_text(path, json.dumps(value, sort_keys=True, default=str))


class Outbox:
    """A write-ahead folder of JSON-line files: written before a risky step, deleted after it, replayed at start."""

    def __init__(self, storage: Storage, root: str):
        self.storage, self.root = storage, root.rstrip("/")

    def put(self, kind: str, rows: list[dict]) -> str:
        path = f"{self.root}/{kind}/{uuid.uuid4().hex}.jsonl"
        self.storage.write_text(path, "\n".join(json.dumps(r, sort_keys=True, default=str) for r in rows))
        return path

    def done(self, path: str) -> None:
        self.storage.delete(path)

    def replay(self, kind: str, take) -> int:
        """Hand each file's rows to ``take`` and delete the file after it; how many rows there were."""
        total = 0
        for name in self.storage.names(f"{self.root}/{kind}"):
            if name.endswith(".jsonl"):
                path = f"{self.root}/{kind}/{name}"
                rows = [json.loads(line) for line in self.storage.read_text(path).splitlines() if line]
                take(rows)
                self.done(path)
                total += len(rows)
        return total

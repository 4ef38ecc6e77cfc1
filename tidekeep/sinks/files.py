"""The few file operations a safe table write needs, on whatever file system the path names."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


# Moves that run at the same time; each is one metadata call.
MOVERS = 16


@dataclass(frozen=True)
class DataFile:
    """A data file of a table. folder: its partition folders as they are spelled on disk, "" for none."""

    folder: str
    name: str
    bytes: int
    changed: int

    @property
    def place(self) -> str:
        return f"{self.folder}/{self.name}" if self.folder else self.name


def plain_uri(uri: str) -> str:
    """One spelling for `file:/x` and `file:///x`."""
    return re.sub(r"^file:/+", "file:///", uri)


class FileTree:
    """Renames and listings through Hadoop's file system; driver-side metadata only."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._settings = spark._jsc.hadoopConfiguration()
        self._systems: dict[str, object] = {}

    def _at(self, path: str):
        target = self._path(path)
        scheme, _, rest = path.partition("://")
        root = f"{scheme}://{rest.split('/')[0]}" if rest else path.split("/")[0]
        if root not in self._systems:
            self._systems[root] = target.getFileSystem(self._settings)
        return self._systems[root], target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        fs, target = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def is_partitioned(self, path: str, column: str) -> bool:
        return any(n.startswith(f"{column}=") for n in self.names(path))

    def move(self, old: str, new: str) -> None:
        fs, source = self._at(old)
        _, target = self._at(new)
        if not fs.exists(source):
            raise FileNotFoundError(old)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not move {old} to {new}")

    def remove(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def make(self, path: str) -> None:
        fs, target = self._at(path)
        fs.mkdirs(target)

    def sizes(self, path: str) -> list[int]:
        """Bytes of the data files of a folder."""
        fs, target = self._at(path)
        found = fs.listStatus(target) if fs.exists(target) else []
        return [s.getLen() for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]

    def data_files(self, path: str) -> list[DataFile]:
        """All data files of a table, the partition folders below it included, without hidden ones. Folders of a level are listed
        side by side."""
        fs, root = self._at(path)
        if not fs.exists(root):
            return []

        def listed(folder) -> tuple[list[DataFile], list]:
            found, below, (where, place) = [], [], folder
            for s in fs.listStatus(where):
                name = s.getPath().getName()
                if name.startswith((".", "_")) and "=" not in name:
                    continue
                if s.isFile():
                    found.append(DataFile(place, name, s.getLen(), s.getModificationTime()))
                else:
                    below.append((s.getPath(), f"{place}/{name}" if place else name))
            return found, below

        files, level = [], [(root, "")]
        with ThreadPoolExecutor(MOVERS) as pool:
            while level:
                parts = list(pool.map(listed, level))
                files += [f for found, _ in parts for f in found]
                level = [folder for _, below in parts for folder in below]
        return files

    def uri(self, path: str) -> str:
        """The path with its scheme, escaped as addresses are: what Spark calls a file in `_metadata`."""
        fs, target = self._at(path)
        return plain_uri(fs.makeQualified(target).toUri().toString())

    def write_text(self, path: str, text: str) -> None:
        """A small file, complete when it is there: written under another name first."""
        fs, target = self._at(path)
        _, part = self._at(f"{path}.part")
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(part, target):
            raise OSError(f"could not write {path}")

    def read_text(self, path: str) -> str:
        fs, target = self._at(path)
        source = fs.open(target)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def in_parallel(self, act: Callable[..., None], calls: Sequence[tuple]) -> None:
        """Calls that do not depend on each other, at most MOVERS at a time; all are tried, the first error is raised."""
        if len(calls) < 2:
            for call in calls:
                act(*call)
            return
        with ThreadPoolExecutor(MOVERS) as pool:
            done = [pool.submit(act, *call) for call in calls]
        for call in done:
            call.result()


# Marks in the names of folders beside a table that is being written, and of what is inside them.
STAGED, REPLACED, FINISHED, WHOLE = ".staged-", ".replaced-", ".finished-", "whole"
PLAN, OLD, UNDONE = "plan-", "old", "undone"


def staging_path(table: str) -> str:
    return f"{table.rstrip('/')}{STAGED}{uuid.uuid4().hex}"


@contextmanager
def staging(tree: FileTree, table: str) -> Iterator[str]:
    """A folder beside the table to write into; whatever was not moved out of it is removed."""
    path = staging_path(table)
    try:
        yield path
    finally:
        tree.remove(path)


def recover(tree: FileTree, table: str) -> None:
    """Undo, as a whole, what a run left behind that died while writing; drop what a finished one left.

    Until a switch is finished its folder holds the old data and the plan of what moves where, so all of it is taken back. Dying
    in here is harmless: the next call goes on.
    """
    parent, _, name = table.rstrip("/").rpartition("/")
    entries = tree.names(parent)
    for entry in entries:
        if entry.startswith(f"{name}{REPLACED}"):
            Swap(tree, table, f"{parent}/{entry}").undo()
    for entry in entries:
        if entry.startswith((f"{name}{STAGED}", f"{name}{FINISHED}")):
            tree.remove(f"{parent}/{entry}")


class Swap:
    """Moves new data into place and keeps the old aside until all of it has moved.

    What is to move is written down before the first move, so moves of one switch run side by side. Leaving the block normally
    drops the old data; leaving it by an error puts it back. If the driver itself dies, `recover` does so on the next run.
    """

    def __init__(self, tree: FileTree, table: str, aside: str | None = None):
        self.tree, self.table = tree, table.rstrip("/")
        self.aside = aside or f"{self.table}{REPLACED}{uuid.uuid4().hex}"
        self.steps = 0

    def __enter__(self) -> Swap:
        return self

    def _name(self, path: str) -> str:
        return path.rstrip("/")[len(self.table) + 1 :] or WHOLE

    def _live(self, name: str) -> str:
        return self.table if name == WHOLE else f"{self.table}/{name}"

    def take_out(self, path: str) -> None:
        self.switch([path], [])

    def put_in(self, staged: str, path: str) -> None:
        self.switch([], [(staged, path)])

    def switch(self, out: Iterable[str], into: Sequence[tuple[str, str]]) -> None:
        """Folders or files that go, where they are there, and (staged, live) ones that come. First all go, then all come."""
        missing = [staged for staged, _ in into if not self.tree.exists(staged)]
        if missing:
            raise FileNotFoundError(missing[0])
        out = [path for path in out if self.tree.exists(path)]
        if not out and not into:
            return
        step, self.steps = self.steps, self.steps + 1
        plan = {"out": [self._name(p) for p in out], "in": [[staged, self._name(p)] for staged, p in into]}
        self.tree.make(self.aside)
        self.tree.write_text(f"{self.aside}/{PLAN}{step:06d}", json.dumps(plan))
        self.tree.in_parallel(self.tree.move, [(p, f"{self.aside}/{OLD}/{step}-{i}") for i, p in enumerate(out)])
        self.tree.in_parallel(self.tree.move, list(into))

    def undo(self) -> None:
        """Everything back where it was, the last step first; what came is set aside before what went returns."""

        def withdraw(staged: str, name: str, kept: str) -> None:
            live = self._live(name)
            if not self.tree.exists(staged) and not self.tree.exists(kept) and self.tree.exists(live):
                self.tree.move(live, kept)

        def bring_back(name: str, old: str) -> None:
            live = self._live(name)
            if self.tree.exists(old):
                self.tree.remove(live)
                self.tree.move(old, live)

        plans = sorted((n for n in self.tree.names(self.aside) if n.startswith(PLAN) and n[len(PLAN) :].isdigit()), reverse=True)
        for entry in plans:
            step = int(entry[len(PLAN) :])
            plan = json.loads(self.tree.read_text(f"{self.aside}/{entry}"))
            come = [(staged, name, f"{self.aside}/{UNDONE}/{step}-{i}") for i, (staged, name) in enumerate(plan["in"])]
            self.tree.in_parallel(withdraw, come)
            self.tree.in_parallel(bring_back, [(n, f"{self.aside}/{OLD}/{step}-{i}") for i, n in enumerate(plan["out"])])
        self.tree.remove(self.aside)

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self.undo()
        elif self.tree.exists(self.aside):
            # One rename says that the swap is finished; from here on nothing is taken back.
            finished = self.aside.replace(f"{self.table}{REPLACED}", f"{self.table}{FINISHED}")
            self.tree.move(self.aside, finished)
            self.tree.remove(finished)

"""Copying files byte by byte, as Spark tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

CHUNK = 8 << 20


def reachable(uri: str) -> bool:
    """Whether tasks can open this store themselves."""
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False
    return True


def _copy(source: str, target: str) -> int:
    """Stream one file; it gets its name when it is complete, so a repeated attempt replaces it whole."""
    (here, old), (there, new) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
    folder, _, name = new.rpartition("/")
    there.create_dir(folder, recursive=True)
    # Task attempts may overlap; each writes under a name of its own.
    part = f"{folder}/.{name}.{uuid.uuid4().hex}.part"
    done = 0
    with here.open_input_stream(old) as reader, there.open_output_stream(part) as writer:
        while chunk := reader.read(CHUNK):
            writer.write(chunk)
            done += len(chunk)
    there.move(part, new)
    return done


def copy_files(spark: SparkSession, pairs: Sequence[tuple[str, str, int]], per_task: int) -> None:
    """Copy (source, target, bytes) in tasks of about `per_task` bytes; a large file is one task. Sizes are compared."""
    if not pairs:
        return
    ordered, task, room = [], 0, per_task
    for source, target, size in sorted(pairs, key=lambda p: (-p[2], p[0])):
        if ordered and size > room:
            task, room = task + 1, per_task
        ordered.append((source, target, size, task))
        room -= size
    rows = spark.createDataFrame(ordered, "source string, target string, bytes long, task int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong = []
            for row in batch.to_pylist():
                if _copy(row["source"], row["target"]) != row["bytes"]:
                    wrong.append(row["source"])
            yield pa.record_batch([pa.array(wrong, pa.string())], ["source"])

    wrong = rows.repartitionByRange(task + 1, "task").mapInArrow(run, "source string").collect()
    if wrong:
        raise OSError(f"{wrong[0]['source']} changed while it was copied")

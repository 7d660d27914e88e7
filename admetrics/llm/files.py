"""Whole files in the shared folder, written and read by tasks through Arrow's file systems.

A task writes under a name of its own attempt and renames at the end, so a task that runs again, or twice at once,
leaves one complete file with the same name.
"""

import contextlib
import os
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

#: Tasks that read files at most; beyond, a task reads several.
_MOST_TASKS = 20_000


def _open(uri):
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(uri):
    """A binary output stream whose file appears under `uri` only when all is written."""
    system, path = _open(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    unfinished = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(unfinished) as out:
        yield out
    system.move(unfinished, path)


def reading(uri):
    """A binary input file with random access."""
    system, path = _open(uri)
    return system.open_input_file(path)


def one_per_task(listed: DataFrame) -> DataFrame:
    """The rows of a stored list of files, each in a task of its own, whatever the size of the list in bytes."""
    tasks = max(1, min(listed.count(), _MOST_TASKS))
    # One row per file.
    place = F.row_number().over(Window.orderBy("path")) - 1
    numbered = listed.withColumn("_task", F.pmod(place, F.lit(tasks)).cast("int"))
    return numbered.repartitionById(tasks, F.col("_task")).drop("_task")

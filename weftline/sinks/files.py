"""One small file per row, and moves of many files, as Spark tasks that report per file.

Both are idempotent, so a repeated or speculative task does no harm: writes go to a
temporary name and are renamed, a target that already holds the same bytes counts as
written, and a move whose work is already done counts as done. Nothing is overwritten: a
target with other content is left as it is and reported as not done.
The status rows are written once to the shared folder; reading them never repeats the work.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.sources.files import open_store
from weftline.workspace import batch_bytes, materialize

#: Bytes of rows that a task's Python process is handed at a time; a longer row comes alone.
BATCH_BYTES = 4 << 20
#: Tasks that file work is dealt to, so that a slow one does not keep the others waiting.
TASKS_PER_CORE = 4
#: Folders that a task remembers having made.
_FOLDERS_KNOWN = 10_000


def _spread(rows: DataFrame, tasks: int | None, key: str) -> DataFrame:
    """``rows`` dealt out by ``key``, so that all rows of a path meet in one task.

    How rows lie says little about the work: a part may be one row group or one listed
    folder, and the parts beside it empty.
    """
    return rows.repartition(tasks or TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism, key)


def _make_folder(store, inner: str, made: set[str]) -> None:
    """Create the folder of a file, once for the many files of it."""
    folder = inner.rpartition("/")[0]
    if folder in made:
        return
    store.create_dir(folder, recursive=True)
    if len(made) >= _FOLDERS_KNOWN:
        made.clear()
    made.add(folder)


def write_file_per_row(df: DataFrame, path: str, content: str, tasks: int | None = None) -> DataFrame:
    """Write ``content`` to the file named by ``path`` for each row: ``(path, byte_count, ok)``.

    A NULL path or content makes no file and is not ok; nor is a target that exists with
    other content.
    """
    import pyarrow as pa
    from pyarrow.fs import FileType

    def write(target: str | None, text: str | None, made: set[str]) -> tuple[int, bool]:
        if target is None or text is None:
            return 0, False
        data = text.encode("utf-8")
        try:
            store, inner = open_store(target)
            if store.get_file_info(inner).type != FileType.NotFound:
                with store.open_input_stream(inner) as there:
                    same = there.read() == data
                return (len(data) if same else 0), same
            _make_folder(store, inner, made)
            partial = f"{inner}.{uuid.uuid4().hex}.partial"
            with store.open_output_stream(partial) as out:
                out.write(data)
            store.move(partial, inner)
            return len(data), True
        except OSError:
            return 0, False

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            paths, contents = batch.columns
            # One text at a time becomes a Python string.
            done = [write(t.as_py(), c.as_py(), made) for t, c in zip(paths, contents)]
            counts, oks = pa.array([n for n, _ in done], pa.int64()), pa.array([ok for _, ok in done], pa.bool_())
            yield pa.RecordBatch.from_arrays([paths, counts, oks], ["path", "byte_count", "ok"])

    rows = df.select(F.col(path).cast("string").alias("path"), F.col(content).cast("string").alias("content"))
    with batch_bytes(df.sparkSession, BATCH_BYTES):
        written = _spread(rows, tasks, "path").mapInArrow(work, "path string, byte_count bigint, ok boolean")
        return materialize(written, "written")


def move_files(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Move each row's ``path`` to ``destination``: ``(path, destination, move_result)``."""
    import pyarrow as pa
    from pyarrow.fs import FileType

    def move(source: str, target: str, made: set[str]) -> bool:
        try:
            store, src = open_store(source)
            _, dst = open_store(target)
            if store.get_file_info(src).type == FileType.NotFound:
                return store.get_file_info(dst).type == FileType.File
            if store.get_file_info(dst).type != FileType.NotFound:
                return False
            _make_folder(store, dst, made)
            store.move(src, dst)
            return True
        except OSError:
            return False

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            sources, targets = batch.columns
            done = [move(s.as_py(), t.as_py(), made) for s, t in zip(sources, targets)]
            yield pa.RecordBatch.from_arrays([sources, targets, pa.array(done, pa.bool_())], ["path", "destination", "move_result"])

    rows = df.select("path", "destination")
    moved = _spread(rows, tasks, "path").mapInArrow(work, "path string, destination string, move_result boolean")
    return materialize(moved, "moved")

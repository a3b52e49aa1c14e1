"""Files that tasks write to the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder) if ":" in folder else f"file://{folder}")


def put(folder: str, name: str, data: bytes) -> None:
    """Write one file under its final name, whole or not at all.

    A task that runs twice writes the same bytes under the same name, and a task that dies
    leaves a hidden file that readers skip.
    """
    store, path = _opened(folder)
    store.create_dir(path, recursive=True)
    hidden = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(data)
    store.move(hidden, f"{path}/{name}")


def rows_of(folder: str, part: int, parts: int, batch_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of a Parquet table in the shared folder, from every ``parts``-th of its files."""
    store, path = _opened(folder)
    names = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.base_name.endswith(".parquet") and f.base_name[0] not in "._")
    for name in names[part::parts]:
        with store.open_input_file(name) as file:
            yield from pq.ParquetFile(file).iter_batches(batch_size=batch_rows)

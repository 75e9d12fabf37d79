"""What the operators share: the cluster's shared folder, written tables and shipping the package to executors."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession

from ..sources import shared
from ..sources.shared import delete, scratch, tidied, written

__all__ = ["delete", "fresh", "map_array", "put_array", "scratch", "ship", "tidied", "trim", "written"]

#: Files that a worker keeps mapped.
MAPPED_FILES = 512


def ship(spark: SparkSession) -> None:
    """Give executors this package, and keep Arrow batches small."""
    shared.ship(spark)


def trim() -> None:
    """Give freed memory of a Python worker back to the machine: workers live on, and the next task's peak may be elsewhere."""
    import ctypes
    import gc

    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that do not clash with those of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def put_array(root: str, name: str, values) -> None:
    """Write a numpy array's bytes as a file below root, whole or not at all; runs on executors, also more than once."""
    from pyarrow import fs as arrow_fs

    fs, path = arrow_fs.FileSystem.from_uri(root)
    fs.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(memoryview(values).cast("B") if len(values) else b"")
    fs.move(draft, f"{path}/{name}")


_mapped: OrderedDict[tuple[str, str], tuple] = OrderedDict()


def map_array(root: str, name: str, dtype: str):
    """The array of a file below root, memory-mapped; from a store without local paths a copy is mapped.

    A worker keeps the MAPPED_FILES last used; older mappings (and copies) go.
    """
    import numpy as np
    from pyarrow import fs as arrow_fs

    if (root, name) in _mapped:
        _mapped.move_to_end((root, name))
        return _mapped[root, name][0]
    fs, path = arrow_fs.FileSystem.from_uri(root)
    path, copy = f"{path}/{name}", None
    if not fs.get_file_info(path).size:
        return np.empty(0, dtype)
    if not isinstance(fs, arrow_fs.LocalFileSystem):
        copy = tempfile.NamedTemporaryFile(prefix="quern-")  # goes with its mapping
        with fs.open_input_stream(path) as source:
            shutil.copyfileobj(source, copy)
        copy.flush()
        path = copy.name
    while len(_mapped) >= MAPPED_FILES:
        _mapped.popitem(last=False)
    _mapped[root, name] = np.memmap(path, dtype, "r"), copy
    return _mapped[root, name][0]

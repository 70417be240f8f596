"""Files by byte ranges, in any store that Arrow knows: local paths, HDFS, S3 and others by their URI."""

from __future__ import annotations

import io
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that a small read fetches ahead, so that a header is one request.
AHEAD = 1 << 16


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    local = re.sub(r"^file:/+", "/", path)
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", local):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", local))


def opened(path: str) -> io.BufferedReader:
    """A file to read and seek in; nothing but what is asked for, and AHEAD bytes, is fetched."""
    store, at = store_of(path)
    return io.BufferedReader(store.open_input_file(at), AHEAD)


def seekable(files: DataFrame) -> bool:
    """Can all files of a listing with `path` be opened by ranges?

    One look at each scheme; a store that is unknown, or whose client library is missing, says no.
    """
    roots = files.select(F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*:/+)?[^/]*/", 0).alias("root")).distinct().collect()  # a row a store
    try:
        for (root,) in roots:
            store_of(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False
    return True

"""Filesystem handles for code running inside tasks (writers, copies).

Spark hands out paths as ``file:/x``, ``file:///x``, plain ``/x`` or ``scheme://...``; Arrow's
filesystem layer needs the local forms normalised.
"""

from __future__ import annotations

import os


def arrow_fs(uri: str):
    """``(pyarrow filesystem, path)`` for a URI or local path."""
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


def reads_ranges(uri: str) -> bool:
    """Whether Arrow reaches the place, so that objects there can be read in ranges.  Spark's readers
    reach more stores, but give an object's bytes only as a whole."""
    import pyarrow as pa
    import pyarrow.fs as pafs

    try:
        fs, path = arrow_fs(uri)
        return fs.get_file_info(path).type != pafs.FileType.NotFound
    except (pa.ArrowException, OSError):
        return False

"""Open files of local disks and of object stores from Spark's tasks.

Local paths and ``file:`` use the disk; the stores below are reached through Arrow's file systems, which
stream and seek, so that a file of any size is read in parts. Files elsewhere can be read through
Spark (``binaryFile``), a row for each file, but not written.
"""

from __future__ import annotations

import re

from pyarrow import fs as arrow_fs

#: Schemes of paths and what Arrow calls them.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}


def scheme_of(path: str) -> str:
    """The scheme of a path in lower case, with ``file`` for local ones."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else "file"


def local(path: str) -> str:
    return re.sub(r"^file:(//)?(?=/)", "", path)


def streams(path: str) -> bool:
    """Whether tasks can open a path themselves."""
    return scheme_of(path) == "file" or scheme_of(path) in SCHEMES


#: Compressed files by their endings; such a file is read from its start to its end by one task.
CODECS = {".gz": "gzip", ".zst": "zstd"}


def codec_of(path: str) -> str | None:
    return next((codec for end, codec in CODECS.items() if path.lower().endswith(end)), None)


def opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    scheme = scheme_of(path)
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), local(path)
    if scheme not in SCHEMES:
        raise ValueError(f"no file system for '{scheme}:' in {path}: use a local path or one of {', '.join(sorted(SCHEMES))}")
    return arrow_fs.FileSystem.from_uri(SCHEMES[scheme] + path[path.index(":") :])

"""Files by path or URI: local ones directly, others through pyarrow's file systems. Credentials are the environment's."""

from __future__ import annotations

import fnmatch
import glob
import io
import os
from datetime import UTC, datetime

from pyarrow import fs

#: Schemes that are read, and the names by which pyarrow knows them.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}
BUFFER = 1 << 20


def local(path: str) -> str | None:
    """The path in the local file system, or None."""
    if path.startswith("dbfs:/"):
        return "/dbfs/" + path[6:].lstrip("/")
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else path


def remote(path: str) -> tuple[fs.FileSystem, str]:
    scheme, _, rest = path.partition("://")
    if scheme.lower() not in SCHEMES:
        raise ValueError(f"cannot read {scheme}:// paths: {path}")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme.lower()]}://{rest}")


def info(path: str) -> tuple[str, int, datetime | None]:
    """'file', 'folder' or 'none'; size; time of the last change."""
    own = local(path)
    if own is not None:
        if not os.path.exists(own):
            return "none", 0, None
        st = os.stat(own)
        return ("folder" if os.path.isdir(own) else "file"), st.st_size, datetime.fromtimestamp(st.st_mtime, UTC)
    system, inner = remote(path)
    got = system.get_file_info(inner)
    kind = {fs.FileType.File: "file", fs.FileType.Directory: "folder"}.get(got.type, "none")
    return kind, got.size or 0, got.mtime


def is_file(path: str) -> bool:
    return info(path)[0] == "file"


def size(path: str) -> int:
    return info(path)[1]


def opened(path: str):
    """A binary file that can seek."""
    own = local(path)
    if own is not None:
        return open(own, "rb")
    system, inner = remote(path)
    return io.BufferedReader(system.open_input_file(inner), BUFFER)


def children(path: str) -> list[str]:
    """Files right in a folder, sorted."""
    own = local(path)
    if own is not None:
        return sorted(f for x in os.listdir(own) if os.path.isfile(f := os.path.join(own, x)))
    system, inner = remote(path)
    head = path.rstrip("/")
    return sorted(f"{head}/{x.base_name}" for x in system.get_file_info(fs.FileSelector(inner)) if x.type == fs.FileType.File)


def matching(path: str) -> list[str]:
    """Files that a pattern matches, sorted; in stores a pattern may stand in the last part only."""
    own = local(path)
    if own is not None:
        return sorted(f for f in glob.glob(own) if os.path.isfile(f))
    folder, _, name = path.rpartition("/")
    if not any(c in name for c in "*?["):
        return []
    return [f for f in children(folder) if fnmatch.fnmatchcase(f.rpartition("/")[2], name)]

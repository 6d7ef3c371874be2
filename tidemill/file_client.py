"""Files as tasks open them: a client by the path's scheme."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def open_file_system(path: str):
    """File system and local name of a path as Spark lists it (``file:/x``, ``hdfs://…``, ``s3a://…``)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    authority = rest.split("/", 1)[0]
    system, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, rest if scheme in ("s3", "gs") else "/" + rest.split("/", 1)[1]


def has_client(path: str) -> bool:
    try:
        open_file_system(path)
    except Exception:  # whatever the client's library says: there is none
        return False
    return True


# Task functions travel by value, so the executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Opening stored objects from inside a task."""

from __future__ import annotations

from urllib.parse import quote, urlsplit

from pyarrow import fs


def open_filesystem(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system of a URI, the path on it, and what to put before such a path to make a URI."""
    scheme, colon, rest = uri.partition(":/")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else uri).lstrip("/"), "file://"
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    system, path = fs.FileSystem.from_uri(quote(f"{scheme}:/{rest}", safe=":/@"))
    authority = f"/{urlsplit(uri).netloc}" if scheme in ("hdfs", "viewfs") else "/"
    return system, path, f"{scheme}:/{authority}"

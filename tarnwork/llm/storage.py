"""Byte ranges of files in the folder that the cluster shares, read and written inside tasks."""

from __future__ import annotations

import re

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a bare path or ``file:`` is a mounted folder, ``s3a`` and ``s3n`` are S3."""
    if "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:", "", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))

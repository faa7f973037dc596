"""Files for the Python data sources, which open them in tasks rather than in the JVM."""

from __future__ import annotations

from pyarrow import fs

# Schemes of Hadoop connectors and the ones they are known under here.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "file": "file"}


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it of a local path or a ``file``, ``s3a``, ``gs`` or ``hdfs`` one."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme not in _SCHEMES.values() and scheme not in _SCHEMES:
        known = ", ".join(sorted(_SCHEMES))
        raise ValueError(f"{path}: files of this kind are read from {known} paths only")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def data_files(path: str, endings: tuple[str, ...]) -> list[tuple[str, int]]:
    """Path and size of the file, or of every file with one of the endings below the folder.

    Names that begin with ``_`` or ``.`` are left out, as Spark does.
    """
    system, inside = resolve(path)
    info = system.get_file_info(inside.rstrip("/"))
    prefix = path.rstrip("/").removesuffix(inside.rstrip("/"))
    if info.type == fs.FileType.File:
        return [(prefix + info.path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"input path not found: {path}")
    found = []
    for one in system.get_file_info(fs.FileSelector(info.path, recursive=True)):
        below = one.path[len(info.path) :].split("/")
        hidden = any(part.startswith(("_", ".")) for part in below)
        if one.type == fs.FileType.File and not hidden and one.path.lower().endswith(endings):
            found.append((prefix + one.path, one.size))
    return sorted(found)

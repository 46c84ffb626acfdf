"""Files by URI, for Python tasks: local ones and those of the stores that Arrow knows."""

from __future__ import annotations

import hashlib
import re

import pyarrow.fs

_CHUNK = 1 << 20


_LOCAL = pyarrow.fs.LocalFileSystem()


def store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a file or folder, and its path there."""
    if not re.match(r"[a-z][a-z0-9+.-]*:/", uri):
        return _LOCAL, uri
    if plain := re.match(r"file:/+([\w./-]*)$", uri, re.ASCII):  # nothing to decode
        return _LOCAL, "/" + plain[1]
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", uri)))


def size(uri: str) -> int | None:
    """Bytes of a file; None where there is none."""
    fs, path = store(uri)
    info = fs.get_file_info(path)
    return info.size if info.type == pyarrow.fs.FileType.File else None


def sha256(uri: str) -> str:
    """The hash of a file, read in pieces."""
    fs, path = store(uri)
    h = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while piece := f.read(_CHUNK):
            h.update(piece)
    return h.hexdigest()


def put(uri: str, body: bytes, made: set[str] | None = None) -> None:
    """Write a file; `made` remembers folders from call to call, so that each is made once."""
    fs, path = store(uri)
    above = path.rpartition("/")[0]
    if made is None or above not in made:
        fs.create_dir(above, recursive=True)
        if made is not None:
            made.add(above)
    with fs.open_output_stream(path) as f:
        f.write(body)


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def is_folder(uri: str) -> bool:
    """Whether it is a folder of a store that Arrow opens."""
    try:
        fs, path = store(uri)
        return fs.get_file_info(path).type == pyarrow.fs.FileType.Directory
    except (pyarrow.ArrowException, OSError):
        return False


def listed(uri: str, below: str = "") -> list[tuple[str, int | None]]:
    """What lies in a folder below uri: paths below uri and bytes, None for folders; hidden ones are left out."""
    fs, path = store(uri.rstrip("/"))
    kinds = pyarrow.fs.FileType
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{path}/{below}" if below else path or "/"))
    return [(f"{below}/{i.base_name}" if below else i.base_name, None if i.type == kinds.Directory else i.size) for i in found if i.type in (kinds.File, kinds.Directory) and not hidden(i.base_name)]

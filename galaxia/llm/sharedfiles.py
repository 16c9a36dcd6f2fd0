"""Arrays that workers write to, and memory-map from, the shared folder."""

from __future__ import annotations

import io
import mmap
import os
import sys
import uuid
from collections import OrderedDict

import numpy as np

# A map that holds no file open counts only towards the kernel's limit of maps
# (65,530 by default), not towards the much lower one of open files.
_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}
#: Maps a worker keeps open, and bytes it keeps of arrays that cannot be mapped.
MAPS = 16384 if _UNTRACKED else 512
BYTES = 256 << 20
_MAPPED: OrderedDict[str, np.ndarray] = OrderedDict()


def _filesystem(path: str):
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def write_array(folder: str, name: str, values: np.ndarray) -> str:
    """Write under a name no other attempt uses; the path counts only once a
    committed row carries it, so a retried task leaves no half-read file."""
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}.npy"
    files, local = _filesystem(path)
    files.create_dir(os.path.dirname(local), recursive=True)
    out = io.BytesIO()
    np.save(out, values, allow_pickle=False)
    with files.open_output_stream(local) as f:
        f.write(out.getbuffer())
    return path


def read_array(path: str) -> np.ndarray:
    """The array, read from front to end."""
    files, local = _filesystem(path)
    with files.open_input_stream(local) as f:
        return np.load(io.BytesIO(f.read()), allow_pickle=False)


def delete_file(path: str) -> None:
    files, local = _filesystem(path)
    files.delete_file(local)


def _map(local: str) -> np.ndarray:
    with open(local, "rb") as f:
        np.lib.format.read_magic(f)
        shape, by_column, kind = np.lib.format.read_array_header_1_0(f)
        size, start = int(np.prod(shape)), f.tell()
        if not size:
            return np.empty(shape, kind)
        held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED)
    return np.frombuffer(held, kind, size, start).reshape(shape, order="F" if by_column else "C")


def map_array(path: str) -> np.ndarray:
    """The array, memory-mapped: the shared folder is to be one that workers have
    mounted.  Of another store the array is read into memory; nothing is copied to a
    local folder.  The maps longest unused are closed beyond ``MAPS``, or ``BYTES`` in
    memory."""
    if path in _MAPPED:
        _MAPPED.move_to_end(path)
        return _MAPPED[path]
    from pyarrow import fs
    files, local = _filesystem(path)
    mounted = isinstance(files, fs.LocalFileSystem)
    _MAPPED[path] = _map(local) if mounted else read_array(path)
    while len(_MAPPED) > MAPS or (not mounted and len(_MAPPED) > 1 and sum(a.nbytes for a in _MAPPED.values()) > BYTES):
        _MAPPED.popitem(last=False)
    return _MAPPED[path]

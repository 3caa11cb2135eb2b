"""Arrays in files of a shared folder, memory-mapped by the tasks that read them."""

from __future__ import annotations

import contextlib
import ctypes
import io
import json
import mmap
import os
import tempfile
import uuid

import numpy as np


def open_folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def layout(arrays: dict[str, np.ndarray]) -> tuple[bytes, dict[str, int], int]:
    """The head of a file of these arrays, the byte at which each begins (a multiple of 8), and the file's size."""
    head, at = {}, 0
    for name, values in arrays.items():
        head[name] = [values.dtype.str, len(values), at]
        at += -(-values.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    begin = 8 + len(text)
    return len(text).to_bytes(8, "little") + text, {name: begin + x[2] for name, x in head.items()}, begin + at


def write_arrays(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Store arrays in one new file; returns its name.

    The name belongs to this task attempt alone, and counts only once it is in a
    table that Spark has committed.
    """
    store, base = open_folder(folder)
    store.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}.bin"
    with store.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(layout(arrays)[0])
        for values in arrays.values():
            data = np.ascontiguousarray(values).tobytes()
            out.write(data + bytes(-len(data) % 8))
    return name


@contextlib.contextmanager
def local_copy(store, path: str):
    """A local path of a file; that of one in a remote store is a copy, unlinked at the end."""
    if store.type_name == "local":
        yield path
        return
    with tempfile.NamedTemporaryFile(delete=False) as copy, store.open_input_stream(path) as source:
        while piece := source.read(io.DEFAULT_BUFFER_SIZE * 128):
            copy.write(piece)
    try:
        yield copy.name
    finally:
        os.unlink(copy.name)


def map_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """Memory-map a file's arrays; one in a remote store is copied and unlinked first."""
    store, base = open_folder(folder)
    with local_copy(store, f"{base}/{name}") as path:
        raw = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8 : 8 + size].tobytes())
    body = raw[8 + size :]
    return {k: body[at : at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, n, at) in head.items()}


def map_space(folder: str, names: list[str], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Memory-map files of known sizes behind one another: their 64-bit words, and the byte at which each file begins.

    One array spans all files, so that a look-up in many of them is one indexing.
    """
    store, base = open_folder(folder)
    ends = np.cumsum([0] + [-(-n // mmap.ALLOCATIONGRANULARITY) * mmap.ALLOCATIONGRANULARITY for n in sizes])
    private, fixed, no_reserve = mmap.MAP_PRIVATE, 0x10, getattr(mmap, "MAP_NORESERVE", 0x4000)
    space = mmap.mmap(-1, max(int(ends[-1]), mmap.ALLOCATIONGRANULARITY), flags=private | mmap.MAP_ANONYMOUS | no_reserve)
    begin = ctypes.addressof(ctypes.c_char.from_buffer(space))
    call = ctypes.CDLL(None, use_errno=True).mmap
    call.restype, call.argtypes = ctypes.c_void_p, [ctypes.c_void_p, ctypes.c_size_t, ctypes.c_int, ctypes.c_int, ctypes.c_int, ctypes.c_long]
    for name, at, size in zip(names, ends.tolist(), sizes, strict=False):
        with local_copy(store, f"{base}/{name}") as path, open(path, "rb") as file:
            if os.fstat(file.fileno()).st_size != size:
                raise OSError(f"{base}/{name} does not have {size} bytes")
            if call(begin + at, size, mmap.PROT_READ, private | fixed, file.fileno(), 0) != begin + at:
                raise OSError(ctypes.get_errno(), f"{base}/{name} cannot be mapped")
    words = np.frombuffer(space, np.uint64)
    words.flags.writeable = False
    return words, ends[:-1]

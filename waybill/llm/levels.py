"""Files of a shared folder that hold number arrays and Elias-Fano sequences, written once and memory-mapped."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs

from waybill.llm.elias_fano import EliasFano


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write(uri: str, sequences: dict[str, tuple[np.ndarray, int, str]], plain: dict[str, np.ndarray], numbers: dict[str, float]) -> None:
    """Sorted sequences with their universes and uses, plain arrays, single numbers. A file appears whole or not at all."""
    head, parts, at = {"sequences": {}, "plain": {}, "numbers": numbers}, [], 0

    def put(array: np.ndarray) -> list:
        nonlocal at
        raw = np.ascontiguousarray(array).tobytes()
        raw += b"\0" * (-len(raw) % 8)
        place = [at, len(array), str(array.dtype)]
        parts.append(raw)
        at += len(raw)
        return place

    for name, (values, universe, use) in sequences.items():
        header, arrays = EliasFano.arrays(values, universe, use)
        head["sequences"][name] = [header, [put(a) for a in arrays]]
    for name, array in plain.items():
        head["plain"][name] = put(array)
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    system, path = filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for raw in parts:
            out.write(raw)
    system.move(draft, path)


class Level:
    """A mapped file. ``level.name`` is a sequence, an array or a number."""

    def __init__(self, uri: str):
        system, path = filesystem(uri)
        if isinstance(system, fs.LocalFileSystem):
            data = np.memmap(path, np.uint8, "r")
        else:
            # A file without a name: it is gone when the worker ends.
            with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as source:
                while block := source.read(1 << 24):
                    copy.write(block)
                copy.flush()
                data = np.memmap(copy, np.uint8, "r")
        size = int(data[:8].view(np.uint64)[0])
        head = json.loads(bytes(data[8 : 8 + size]))
        base = 8 + size

        def view(place: list) -> np.ndarray:
            at, n, kind = place
            kind = np.dtype(kind)
            return data[base + at : base + at + n * kind.itemsize].view(kind).view(np.ndarray)

        for name, (header, places) in head["sequences"].items():
            setattr(self, name, EliasFano(*header, *[view(p) for p in places]))
        for name, place in head["plain"].items():
            setattr(self, name, view(place))
        for name, number in head["numbers"].items():
            setattr(self, name, number)

"""Helpers shared by the training-data operators: the shared folder, staged tables, Arrow text access and hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage, unstage  # noqa: F401

#: Bytes of text handled at once by the numpy kernels; bounds their temporary arrays.
CHUNK_BYTES = 2 << 20

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def batch_count(docs: DataFrame, text_col: str, mb_each: int = 8, least: int = 12) -> int:
    """Number of batches so that each holds about ``mb_each`` MB of input, however large that is: by the size of its files
    as the optimizer estimates it, or of its texts where there are no files to go by."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 55:
        size = docs.select(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0
    return int(max(least, size // (mb_each << 20)))


def free_name(taken: list[str], name: str) -> str:
    """``name``, with marks before it until no other column has it (names differ by more than case)."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name = f"_{name}"
    return name


def row_struct(df: DataFrame, columns: list[str]):
    """The named columns as one, so that no name of theirs can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer over unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def byte_view(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string or binary column; nulls count as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if len(array) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def text_runs(array: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, past row, offsets, bytes) over consecutive rows of at most ``limit`` bytes (a longer row stands alone)."""
    offsets, data = byte_view(array)
    n, row = len(offsets) - 1, 0
    while row < n:
        past = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        past = min(n, max(past, row + 1))
        yield row, past, offsets[row : past + 1] - offsets[row], data[offsets[row] : offsets[past]]
        row = past


def column(table: pa.Table, name: str) -> pa.Array:
    """A column of a table in one piece."""
    found = table.column(name)
    return found.combine_chunks() if found.num_chunks != 1 else found.chunk(0)


def crc_bucket(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class RollingHash:
    """Polynomial hashes, modulo 2^64, of any stretch of a byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(_POWERS[0]) <= n:
            size = max(n + 1, CHUNK_BYTES + 1024)
            for k, base in enumerate((_BASE, _BASE_INVERSE)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                _POWERS[k] = np.cumprod(powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * _POWERS[0][:n], out=self.sums[1:])

    def fixed(self, length: int, start: int = 0, size: int | None = None) -> np.ndarray:
        """Hash of the ``length`` bytes from each position in [start, start + size) on, as far as there are so many."""
        past = len(self.sums) - length
        past = past if size is None else min(past, start + size)
        return mix64((self.sums[start + length : past + length] - self.sums[start:past]) * _POWERS[1][start:past]) if past > start else np.zeros(0, np.uint64)

    def spans(self, start: np.ndarray, past: np.ndarray) -> np.ndarray:
        """Hash of each stretch [start, past), its length mixed in."""
        raw = (self.sums[past] - self.sums[start]) * _POWERS[1][start]
        return mix64(raw + (past - start).astype(np.uint64) * GOLDEN)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one message. Wide values are laid out by byte planes, whose high ones are mostly zero, and compressed where
    that helps."""
    parts = []
    for a in arrays:
        raw = np.ascontiguousarray(a)
        if raw.itemsize > 1 and raw.size > 1:
            raw = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, raw.itemsize).T)
        raw = raw.tobytes()
        data = pa.compress(raw, "zstd", asbytes=True) if len(raw) > 64 else raw
        data = data if len(data) < len(raw) else raw
        parts.append(a.dtype.str.encode().ljust(4) + len(raw).to_bytes(8, "little") + len(data).to_bytes(8, "little") + data)
    return b"".join(parts)


def unpack(message: bytes) -> list[np.ndarray]:
    """The arrays of :func:`pack`."""
    out, at = [], 0
    while at < len(message):
        dtype = np.dtype(message[at : at + 4].decode().strip())
        raw, size = (int.from_bytes(message[at + x : at + x + 8], "little") for x in (4, 12))
        at += 20
        data = message[at : at + size]
        data = np.frombuffer(pa.decompress(data, raw, "zstd", asbytes=True) if size < raw else data, np.uint8)
        if dtype.itemsize > 1 and raw > dtype.itemsize:
            data = np.ascontiguousarray(data.reshape(dtype.itemsize, -1).T).ravel()
        out.append(data.view(dtype))
        at += size
    return out


def range_split(values: np.ndarray, buckets: int, bits: int = 64):
    """(bucket, slice) of sorted unsigned values below 2**bits, dealt to buckets by equal ranges; empty ones are left out."""
    edges = np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << bits) // buckets)
    cut = np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])
    for b in np.flatnonzero(np.diff(cut)).tolist():
        yield b, slice(int(cut[b]), int(cut[b + 1]))


def deltas(values: np.ndarray) -> np.ndarray:
    """Sorted unsigned values as differences, which compress well."""
    return np.diff(values, prepend=values.dtype.type(0))


def take_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes of all stretches, one after the other."""
    total = int(length.sum())
    if not total:
        return data[:0]
    before = np.cumsum(length) - length
    return data[np.arange(total) + np.repeat(start - before, length)]


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def message_rows(rows: list[tuple[int, int, bytes]], names=("bucket", "pid", "message")) -> pa.Table:
    pa.default_memory_pool().release_unused()  # what this group's columns took
    return pa.table({names[0]: pa.array([r[0] for r in rows], pa.int32()), names[1]: pa.array([r[1] for r in rows], pa.int32()), names[2]: pa.array([r[2] for r in rows], pa.binary())})

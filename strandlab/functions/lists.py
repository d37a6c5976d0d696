"""Arithmetic within list columns: small Arrow functions over whole batches, so that sums along a record need no shuffle.

A null list counts as empty unless it is said otherwise. The functions are declared nondeterministic, though they are not, so
that the optimizer does not copy their inputs into filters on what is built from them, once for every use.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

_LONGS = T.ArrayType(T.LongType())

#: Room for places within one row when rows of a batch are searched together.
_ROW = 1 << 40


def _kept(function):
    return function.asNondeterministic()


def _flat(array: pa.Array, missing=0) -> tuple[np.ndarray, np.ndarray]:
    """(length of each list, all elements one after the other); null elements become ``missing``."""
    size = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = array.flatten()
    return size, (values.fill_null(missing) if values.null_count else values).to_numpy(zero_copy_only=False)


def nested_list(size: np.ndarray, values: pa.Array) -> pa.Array:
    """Lists of the given sizes over values that follow one another."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), values)


@_kept
@arrow_udf(_LONGS)
def running_before(values: pa.Array) -> pa.Array:
    """For each element the sum of those before it in its list."""
    size, flat = _flat(values)
    sums = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
    first = np.cumsum(size) - size
    return nested_list(size, pa.array(sums[:-1] - np.repeat(sums[first], size), pa.int64()))


@_kept
@arrow_udf(_LONGS)
def places_of(text: pa.Array, letter: pa.Array) -> pa.Array:
    """1-based places of a row's letter in its ASCII text, ascending; of any letter where that is null."""
    text = text.fill_null("") if text.null_count else text
    size = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer("".join(text.to_pylist()).encode("latin-1", "replace"), np.uint8)
    wanted = np.array([ord(c[0]) if c else 0 for c in letter.to_pylist()], np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    hit = np.flatnonzero((data == wanted[row]) | (wanted[row] == 0))
    first = np.cumsum(size) - size
    return nested_list(np.bincount(row[hit], minlength=len(size)), pa.array(hit - first[row[hit]] + 1, pa.int64()))


@_kept
@arrow_udf(T.ArrayType(T.IntegerType()))
def spread(size: pa.Array, places: pa.Array, values: pa.Array, default: pa.Array) -> pa.Array:
    """Lists of the given sizes that hold ``values`` at their 1-based ``places`` and the row's default elsewhere; places past the
    end and null values are left out."""
    wide = size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    rest = default.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.repeat(rest, wide)
    n, at = _flat(places)
    given = _flat(values, -1)[1]
    row = np.repeat(np.arange(len(wide)), n)
    keep = (at >= 1) & (at <= wide[row]) & (given >= 0)
    out[(np.cumsum(wide) - wide)[row[keep]] + at[keep] - 1] = given[keep]
    return nested_list(wide, pa.array(out, pa.int32(), mask=out < 0))


def _last_at(row: np.ndarray, at: np.ndarray, size: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of each row's last start that is not after ``at``, or -1; starts ascend within rows."""
    owner = np.repeat(np.arange(len(size)), size)
    found = np.searchsorted(owner * _ROW + starts, row * _ROW + at, side="right") - 1
    return np.where((found >= 0) & (owner[np.maximum(found, 0)] == row), found, -1) if len(starts) else np.full(len(at), -1)


@_kept
@arrow_udf(_LONGS)
def moved(places: pa.Array, starts: pa.Array, lengths: pa.Array, targets: pa.Array) -> pa.Array:
    """Places carried over by blocks, which lead [start, start + length) to [target, ...): null outside of all blocks."""
    n, at = _flat(places)
    size, start = _flat(starts)
    length, target = _flat(lengths)[1], _flat(targets)[1]
    k = _last_at(np.repeat(np.arange(len(n)), n), at, size, start)
    safe = np.maximum(k, 0)
    if not len(start):
        return nested_list(n, pa.nulls(len(at), pa.int64()))
    inside = (k >= 0) & (at < start[safe] + length[safe])
    return nested_list(n, pa.array(target[safe] + at - start[safe], pa.int64(), mask=~inside))


@_kept
@arrow_udf(T.LongType())
def shared_length(a_start: pa.Array, a_end: pa.Array, b_start: pa.Array, b_end: pa.Array) -> pa.Array:
    """Length of what two lists of half-open intervals share; each is sorted and disjoint. Null if either list is."""
    n, low = _flat(a_start)
    high = _flat(a_end)[1]
    size, start = _flat(b_start)
    length = _flat(b_end)[1] - start
    row = np.repeat(np.arange(len(n)), n)
    if len(start) and len(low):
        before = np.cumsum(length) - length

        def covered(at):  # by the b intervals up to a place
            k = _last_at(row, at, size, start)
            safe = np.maximum(k, 0)
            first = (np.cumsum(size) - size)[row]
            return np.where(k >= 0, before[safe] - before[np.minimum(first, len(before) - 1)] + np.minimum(at - start[safe], length[safe]), 0)

        total = np.bincount(row, covered(high) - covered(low), len(n)).astype(np.int64)
    else:
        total = np.zeros(len(n), np.int64)
    none = np.asarray(a_start.is_null()) | np.asarray(b_start.is_null())
    return pa.array(total, pa.int64(), mask=none)

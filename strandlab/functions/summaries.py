"""Summaries of a mapping's signal within its row: bins, their means in either float mode, and both medians.

Works on a batch at once: positions are sorted within their rows, runs of one bin are summed, medians of codes are read off a
histogram of 256 places for each row. Nothing is exploded and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .lists import nested_list
from .numerics import SHIFT

#: Values of the codes, and these times 2 ** SHIFT, which are whole numbers, in two halves whose sums fit in 64 bits.
_PROBABILITY = np.arange(256) / 255.0
_WHOLE = [int(p * 2.0**SHIFT) for p in _PROBABILITY]
_HIGH, _LOW = np.array([w >> 30 for w in _WHOLE]), np.array([w & ((1 << 30) - 1) for w in _WHOLE])


def sequential_sums(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of stretches in 64-bit floats, each from its first value to its last, all stretches side by side."""
    total = np.zeros(len(start))
    order = np.argsort(-count, kind="stable")
    left = np.searchsorted(-count[order], -np.arange(1, (int(count.max()) if len(count) else 0) + 1), side="right")
    for k, n in enumerate(left.tolist()):
        at = order[:n]
        total[at] += values[start[at] + k]
    return total


def two_pass_means(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """R's mean of each stretch, in 64-bit floats."""
    first = sequential_sums(values, start, count) / count
    rest = sequential_sums(values - np.repeat(first, count), start, count)
    return first + rest / count


def exact_means(codes: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mean of code / 255 of each stretch, correctly rounded: a whole sum, divided once."""
    if not len(start):
        return np.zeros(0)
    high, low = np.add.reduceat(_HIGH[codes], start), np.add.reduceat(_LOW[codes], start)
    return np.array([((h << 30) + x) / (n << SHIFT) for h, x, n in zip(high.tolist(), low.tolist(), count.tolist())])


class Signal:
    """One modification's signal of a batch: codes in the order of row and position."""

    def __init__(self, column: pa.Array):
        self.size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten()
        place, code = flat.field("r").to_numpy(zero_copy_only=False), flat.field("code").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(self.size)), self.size)
        order = np.lexsort((place, row))
        self.row, self.place, self.code = row, place[order], code[order].astype(np.int64)

    def bins(self, bin_size: int, binarise: float | None, float_mode: str):
        """(row, position, mean) of the occupied bins, in order."""
        position = (self.place - 1) // bin_size * bin_size + 1
        edge = np.ones(len(position), bool)
        edge[1:] = (position[1:] != position[:-1]) | (self.row[1:] != self.row[:-1])
        start = np.flatnonzero(edge)
        count = np.diff(start, append=len(position))
        value = _PROBABILITY if binarise is None else (_PROBABILITY >= binarise).astype(float)
        if float_mode == "f64":
            mean = two_pass_means(value[self.code], start, count)
        elif binarise is None:
            mean = exact_means(self.code, start, count)
        else:
            mean = np.add.reduceat(value[self.code], start) / count if len(start) else np.zeros(0)
        return self.row[start], position[start], mean

    def middle_codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the lower and the upper middle of each row's values, from a histogram; any for rows without values."""
        n = len(self.size)
        counts = np.bincount(self.row * 256 + self.code, minlength=256 * n).reshape(n, 256).cumsum(1)
        middle = lambda k: (counts > k[:, None]).argmax(1)
        return middle((self.size - 1) // 2), middle(self.size // 2)


def _median(low: np.ndarray, high: np.ndarray, size: np.ndarray, float_mode: str) -> pa.Array:
    """R's median from the middle two; null without values."""
    mean = (low + high) / 2.0
    if float_mode == "f64":
        mean = mean + ((low - mean) + (high - mean)) / 2.0
    return pa.array(np.where(low == high, low, mean), mask=size == 0)


def _middle_means(row: np.ndarray, mean: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower and upper middle of each row's bin means, and how many there are."""
    ranked = mean[np.lexsort((mean, row))]
    size = np.bincount(row, minlength=n)
    first = np.cumsum(size) - size
    at = lambda k: ranked[np.minimum(first + k, len(ranked) - 1)] if len(ranked) else np.zeros(n)
    return at(np.maximum(size - 1, 0) // 2), at(size // 2), size


def summary_type(codes: list[str]) -> T.StructType:
    cell = T.StructType().add("positions", T.LongType())
    for c in codes:
        cell = cell.add(f"signal{c}", T.DoubleType())
    out = T.StructType().add("signalbin", T.ArrayType(cell))
    for c in codes if len(codes) > 1 else [""]:
        out = out.add(f"med_signal{c}", T.DoubleType()).add(f"med_signalbin{c}", T.DoubleType())
    return out


def signal_summary(codes: list[str], bin_size: int, binarise: float | None, float_mode: str):
    """Arrow function of one signal column (array of r and code) for each modification: signalbin, the cells (positions,
    signal<code>...) of all bins that any of them has, with nulls where one has none, and the medians of each, whose names carry
    the code where there are several."""
    names = [f"signal{c}" for c in codes]

    def summarise(*columns: pa.Array) -> pa.Array:
        n = len(columns[0])
        found, medians = [], []
        for column in columns:
            signal = Signal(column)
            row, position, mean = signal.bins(bin_size, binarise, float_mode)
            low, high = signal.middle_codes()
            medians.append(_median(_PROBABILITY[low], _PROBABILITY[high], signal.size, float_mode))
            medians.append(_median(*_middle_means(row, mean, n), float_mode))
            found.append((row, position, mean))
        row, position = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.lexsort((position, row))
        row, position = row[order], position[order]
        cell = np.ones(len(row), bool)
        cell[1:] = (row[1:] != row[:-1]) | (position[1:] != position[:-1])
        place = np.empty(len(row), np.int64)
        place[order] = np.cumsum(cell) - 1
        row, position = row[cell], position[cell]
        fields, at = [pa.array(position, pa.int64())], 0
        for own, _, mean in found:
            value, has = np.zeros(len(row)), np.zeros(len(row), bool)
            value[place[at : at + len(own)]], has[place[at : at + len(own)]] = mean, True
            fields.append(pa.array(value, mask=~has))
            at += len(own)
        cells = nested_list(np.bincount(row, minlength=n), pa.StructArray.from_arrays(fields, ["positions", *names]))
        return pa.StructArray.from_arrays([cells, *medians], summary_type(codes).names)

    summarise.__annotations__ = {"columns": pa.Array, "return": pa.Array}
    return arrow_udf(summarise, summary_type(codes)).asNondeterministic()

"""CIGAR walks over whole batches: the operations of all records as two flat arrays, sums along a record by differences.

A null or empty CIGAR has no operations. It is a list of operations or its text, which is then parsed in the same task's function: a
second function over what the first gives would be a second Python process. Like the functions of :mod:`lists`, these are declared nondeterministic so that the optimizer
does not copy them into each use of what they give.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .lists import nested_list

#: Letters of the operations, in the order of their codes (fixed values of the format).
OPERATIONS = "MIDNSHP=X"
_LETTERS = pa.array(list(OPERATIONS))


def _set(letters: str) -> np.ndarray:
    """Which codes are among ``letters``; the last place is for unknown ones."""
    return np.array([c in letters for c in OPERATIONS] + [False])


#: What advances the read and the reference in the dialect of the signal, and the reference in that of the coverage, where only
#: the last kind counts (fixed values of the two dialects).
_READ, _REFERENCE, _COVERING, _COVERED = _set("MIS"), _set("MDN"), _set("M=XDN"), _set("M=X")
_SPANNED = _set("MD")
_M, _S = OPERATIONS.index("M"), OPERATIONS.index("S")

_LONG = T.LongType()
WALK = T.StructType().add("blocks", T.ArrayType(T.StructType().add("ix", T.IntegerType()).add("q", _LONG).add("len", _LONG).add("r", _LONG))).add("read_length", _LONG).add("span", _LONG)
SPANS = T.ArrayType(T.StructType().add("s", _LONG).add("e", _LONG))


_DIGIT = np.full(256, -1)
_DIGIT[48:58] = np.arange(10)
_CODE = np.full(256, -1)
_CODE[list(OPERATIONS.encode())] = np.arange(len(OPERATIONS))


def _read(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many operations each text has, and their codes and lengths one after the other."""
    data = np.frombuffer("".join(text.fill_null("").to_pylist()).encode("latin-1", "replace"), np.uint8)
    size = pc.utf8_length(text.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(_DIGIT[data] < 0)
    digit = np.flatnonzero(_DIGIT[data] >= 0)
    # the letter that each digit stands before, in the same text
    owner = np.searchsorted(at, digit)
    row = np.repeat(np.arange(len(size)), size)
    known = owner < len(at)
    known[known] = row[digit[known]] == row[at[owner[known]]]
    digit, owner = digit[known], owner[known]
    value = np.zeros(len(at), np.int64)
    np.add.at(value, owner, _DIGIT[data[digit]] * 10 ** np.minimum(at[owner] - digit - 1, 18))
    has = (np.bincount(owner, minlength=len(at)) > 0) & (_CODE[data[at]] >= 0)
    return np.bincount(row[at[has]], minlength=len(size)), _CODE[data[at[has]]], value[has]


class Operations:
    """Operations of a batch: how many each record has, and code, length, record and place in it of each."""

    def __init__(self, cigar: pa.Array):
        if pa.types.is_string(cigar.type) or pa.types.is_large_string(cigar.type):
            self.size, self.code, self.length = _read(cigar)
        else:
            self.size = cigar.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = cigar.flatten()
            self.code = pc.fill_null(pc.index_in(flat.field("op"), _LETTERS), len(OPERATIONS)).to_numpy(zero_copy_only=False)
            self.length = flat.field("len").fill_null(0).to_numpy(zero_copy_only=False)
        self.first = np.cumsum(self.size) - self.size
        self.record = np.repeat(np.arange(len(self.size)), self.size)

    def before(self, advances: np.ndarray) -> np.ndarray:
        """For each operation what those before it in its record advance."""
        sums = np.concatenate([[0], np.cumsum(np.where(advances[self.code], self.length, 0))])
        return sums[:-1] - sums[self.first[self.record]]


@arrow_udf(WALK)
def _walk(pos: pa.Array, cigar: pa.Array) -> pa.Array:
    ops = Operations(cigar)
    n, start = len(ops.size), pos.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(ops.code == _M)
    record, length = ops.record[at], ops.length[at]
    read, reference = ops.before(_READ), ops.before(_REFERENCE)
    fields = [pa.array(at - ops.first[record], pa.int32()), pa.array(read[at] + 1), pa.array(length), pa.array(start[record] + 1 + reference[at])]
    blocks = nested_list(np.bincount(record, minlength=n), pa.StructArray.from_arrays(fields, ["ix", "q", "len", "r"]))
    # with a last S of some length all that was walked, otherwise up to the end of the last M
    walked, some = np.zeros(n, np.int64), np.zeros(n, bool)
    walked[record], some[record] = read[at] + length, True
    last = (ops.first + ops.size - 1)[ops.size > 0]
    clip = last[(ops.code[last] == _S) & (ops.length[last] > 0)]
    walked[ops.record[clip]], some[ops.record[clip]] = read[clip] + ops.length[clip], True
    sums = np.concatenate([[0], np.cumsum(np.where(_SPANNED[ops.code], ops.length, 0))])
    none = np.asarray(cigar.is_null()) & pa.types.is_list(cigar.type)  # a null text is parsed to an empty list, which spans 0
    span = pa.array(sums[ops.first + ops.size] - sums[ops.first], pa.int64(), mask=none)
    fields = [pa.field("blocks", blocks.type), pa.field("read_length", pa.int64()), pa.field("span", pa.int64())]
    return pa.StructArray.from_arrays([blocks, pa.array(walked, mask=~some), span], fields=fields)


walk = _walk.asNondeterministic()


@arrow_udf(SPANS)
def _bin_spans(pos: pa.Array, cigar: pa.Array, size: pa.Array, bins: pa.Array) -> pa.Array:
    ops = Operations(cigar)
    wide = size.to_numpy(zero_copy_only=False)[ops.record]
    room = bins.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    start = pos.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[ops.record] + ops.before(_COVERING)
    use = np.flatnonzero(_COVERED[ops.code] & (ops.length > 0))
    record, low = ops.record[use], start[use]
    first, past = np.maximum(low // wide[use], 0), -(-(low + ops.length[use]) // wide[use])
    past = np.minimum(past, room[record])
    # ends ascend within a record, so a block begins where the one before it ended, at the earliest
    follows = np.concatenate([[False], record[1:] == record[:-1]]) if len(record) else np.zeros(0, bool)
    first = np.where(follows, np.maximum(first, np.concatenate([[0], past[:-1]])[: len(past)]), first)
    keep = first < past
    # spans that touch are one
    r, s, e = record[keep], first[keep], past[keep]
    joins = np.concatenate([[False], (r[1:] == r[:-1]) & (s[1:] == e[:-1])]) if len(r) else np.zeros(0, bool)
    head = np.flatnonzero(~joins)
    tail = np.concatenate([head[1:] - 1, [len(r) - 1]]) if len(head) else head
    return nested_list(np.bincount(r[head], minlength=len(ops.size)), pa.StructArray.from_arrays([pa.array(s[head]), pa.array(e[tail])], ["s", "e"]))


bin_spans = _bin_spans.asNondeterministic()


@arrow_udf(T.ArrayType(T.StructType().add("op", T.StringType()).add("len", _LONG)))
def parsed(text: pa.Array) -> pa.Array:
    """Operations of CIGAR texts; ``*`` has none, and a letter without a number before it is none."""
    size, code, length = _read(text)
    letters = pa.DictionaryArray.from_arrays(pa.array(code, pa.int32()), _LETTERS).cast(pa.string())
    return nested_list(size, pa.StructArray.from_arrays([letters, pa.array(length)], ["op", "len"]))

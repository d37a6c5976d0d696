"""BAM as a Python data source: ``spark.read.format("bam").load(path)``, split by compressed blocks.

A partition owns the records that start in its stretch of blocks. A stretch rarely begins at a record, so the reader
looks for the first place from which several records in a row are sound, as the format's splitting readers do. Records are
decoded by columns, some thousand at a time, and only the fields that the engine uses. A stream kept in pieces is split by these. Files are opened through Arrow's file systems, so any store they reach will do.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.lists import nested_list
from .files import PIECES, FormatError, block_size, open_file, piece_starts
from .pushdown import allow_pushdown, compares, holds

SCHEMA = (
    "ordinal long, ref_id int, chrom string, pos int, flag int, read_id string, l_seq int, seq string, "
    "cigar array<struct<op:string,len:bigint>>, mm string, ml array<int>, sa string"
)
#: Letters of packed bases and of CIGAR operations (fixed values of the format).
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_PAIRS = np.array([list((a + b).encode()) for a in BASES for b in BASES], np.uint8)
#: Bytes of each type of tag value (fixed values of the format).
_WIDTH = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_WIDTHS = np.zeros(256, np.int64)
_WIDTHS[[ord(k) for k in _WIDTH]] = list(_WIDTH.values())
#: Records in a row that must be sound for a place to count as a boundary.
SOUND = 6
#: Records, and bytes of them, that are decoded together.
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20


def read_block(stream) -> bytes | None:
    """Contents of the compressed block at the stream's place, checked; None at the end of the file."""
    head = stream.read(12)
    if len(head) < 12:
        return None
    if head[:2] != b"\x1f\x8b" or not head[3] & 4:
        raise FormatError("not a block-compressed file")
    extra = stream.read(struct.unpack_from("<H", head, 10)[0])
    size = block_size(head + extra)
    rest = stream.read(size - 12 - len(extra))
    if len(rest) < size - 12 - len(extra) or len(rest) < 8:
        raise FormatError("file ends within a block")
    data = zlib.decompressobj(-15).decompress(rest[:-8])
    crc, plain = struct.unpack("<II", rest[-8:])
    if len(data) != plain or zlib.crc32(data) != crc:
        raise FormatError("block does not match its checksum")
    return data


class Blocks:
    """Inflated bytes from a block on, with the virtual offset of each byte's block."""

    def __init__(self, path: str, offset: int = 0):
        self.stream = open_file(path)
        self.stream.seek(offset)
        self.buffer, self.starts, self.base = b"", [], 0

    def grow(self) -> bool:
        offset = self.stream.tell()
        data = read_block(self.stream)
        if data is None:
            return False
        self.starts.append((self.base + len(self.buffer), offset))
        self.buffer += data
        return True

    def need(self, at: int, size: int) -> bytes:
        """``size`` bytes from the absolute place ``at``; fewer only at the end of the file."""
        while self.base + len(self.buffer) < at + size and self.grow():
            pass
        return self.buffer[at - self.base : at - self.base + size]

    def forget(self, at: int) -> None:
        """Drop what lies before ``at``."""
        if at - self.base > 1 << 20:
            self.buffer, self.base = self.buffer[at - self.base :], at
            while len(self.starts) > 1 and self.starts[1][0] <= at:
                self.starts.pop(0)

    def offset(self, at: int) -> tuple[int, int]:
        """File offset of the block that holds ``at``, and the place in it."""
        start, offset = next((s, o) for s, o in reversed(self.starts) if s <= at)
        return offset, at - start


def read_header(blocks: Blocks) -> tuple[list[tuple[str, int]], int]:
    """(name, length) of the references in order, and where the records begin."""
    if blocks.need(0, 4) != b"BAM\1":
        raise FormatError("not a BAM file")
    at = 8 + struct.unpack("<i", blocks.need(4, 4))[0]
    count = struct.unpack("<i", blocks.need(at, 4))[0]
    at += 4
    refs = []
    for _ in range(count):
        size = struct.unpack("<i", blocks.need(at, 4))[0]
        name = blocks.need(at + 4, size).rstrip(b"\0").decode()
        refs.append((name, struct.unpack("<I", blocks.need(at + 4 + size, 4))[0]))
        at += 8 + size
    return refs, at


def _gather(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    """Little-endian numbers that stand at the places ``at``."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(data[at[:, None] + np.arange(width)]).view(kind).ravel()


def _spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What stands in all stretches, one after the other."""
    before = np.cumsum(length) - length
    return data[np.arange(int(length.sum())) + np.repeat(start - before, length)]


def _texts(data: np.ndarray, start: np.ndarray, length: np.ndarray, has: np.ndarray | None = None, encoding: str = "latin-1") -> pa.Array:
    """Strings of stretches, null where ``has`` is false; other than ASCII letters are decoded one text at a time."""
    flat = _spans(data, start, length)
    edges = np.concatenate([[0], np.cumsum(length)])
    if len(flat) and flat.max() > 127:
        texts = [flat[a:b].tobytes().decode(encoding, "replace") for a, b in zip(edges, edges[1:])]
        return pa.array(texts, pa.string(), mask=None if has is None else ~has)
    nulls = None if has is None else pa.py_buffer(np.packbits(has, bitorder="little").tobytes())
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat)), nulls)


class Tags:
    """Where the wanted tags of all records stand: the first of each name, found by walking all records' tags side by side.

    A damaged field ends a record's walk."""

    def __init__(self, data: np.ndarray, at: np.ndarray, end: np.ndarray, wanted=("MM", "ML", "Mm", "Ml", "SA", "CG")):
        n = len(at)
        self.names = {name: k for k, name in enumerate(wanted)}
        keys = np.array([name.encode()[0] << 8 | name.encode()[1] for name in wanted])
        self.kind, self.letter = np.zeros((n, len(wanted)), np.uint8), np.zeros((n, len(wanted)), np.uint8)
        self.start, self.count = np.zeros((n, len(wanted)), np.int64), np.zeros((n, len(wanted)), np.int64)
        zeros = np.flatnonzero(data == 0)
        row, at = np.arange(n), at.astype(np.int64)
        while len(row):
            going = at + 3 <= end[row]
            row, at = row[going], at[going]
            name, kind = data[at].astype(np.int64) << 8 | data[at + 1], data[at + 2]
            at = at + 3
            start, count, letter, past = at.copy(), np.zeros(len(at), np.int64), np.zeros(len(at), np.uint8), at + _WIDTHS[kind]
            good = _WIDTHS[kind] > 0
            text = np.flatnonzero((kind == ord("Z")) | (kind == ord("H")))
            if len(text):
                k = np.searchsorted(zeros, at[text])
                close = np.where(k < len(zeros), zeros[np.minimum(k, len(zeros) - 1)] if len(zeros) else 0, len(data))
                good[text] = close < end[row[text]]
                count[text], past[text] = close - at[text], close + 1
            array = np.flatnonzero((kind == ord("B")) & (at + 5 <= end[row]))
            if len(array):
                letter[array] = data[at[array]]
                width = np.where(letter[array] == ord("A"), 0, _WIDTHS[letter[array]])
                count[array] = _gather(data, at[array] + 1, "<u4")
                start[array] = at[array] + 5
                past[array] = start[array] + count[array] * width
                good[array] = (width > 0) & (past[array] <= end[row[array]])
            row, at, name, kind, start, count, letter, past = (x[good] for x in (row, at, name, kind, start, count, letter, past))
            for k, key in enumerate(keys.tolist()):
                hit = np.flatnonzero((name == key) & (self.kind[row, k] == 0))
                r = row[hit]
                self.kind[r, k], self.letter[r, k], self.start[r, k], self.count[r, k] = kind[hit], letter[hit], start[hit], count[hit]
            at = past

    def texts(self, name: str) -> np.ndarray:
        return np.isin(self.kind[:, self.names[name]], (ord("Z"), ord("H")))

    def arrays(self, name: str, letter: str) -> np.ndarray:
        k = self.names[name]
        return (self.kind[:, k] == ord("B")) & (self.letter[:, k] == ord(letter))

    def span(self, name: str, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = self.names[name]
        return np.where(where, self.start[:, k], 0), np.where(where, self.count[:, k], 0)


def decode_records(data: np.ndarray, start: np.ndarray, size: np.ndarray, ordinals: np.ndarray, names: list[str], fits=None) -> pa.RecordBatch:
    """Rows of SCHEMA from records whose bodies stand at ``start`` and take ``size`` bytes each.

    Fixed fields are gathered from all records at once; ``fits`` (ref_id, pos, flag, l_seq arrays to a mask) leaves records out
    before anything else of them is looked at."""
    if len(size) and size.min() < 32:
        raise FormatError("record too short")
    ref_id, pos, flag, l_seq = _gather(data, start, "<i4"), _gather(data, start + 4, "<i4"), _gather(data, start + 14, "<u2"), _gather(data, start + 16, "<i4")
    if fits is not None and len(start):
        keep = fits({"ref_id": ref_id, "pos": pos, "flag": flag.astype(np.int32), "l_seq": l_seq})
        start, size, ordinals, ref_id, pos, flag, l_seq = (x[keep] for x in (start, size, ordinals, ref_id, pos, flag, l_seq))
    l_name, n_ops, l_seq = data[start + 8].astype(np.int64), _gather(data, start + 12, "<u2").astype(np.int64), l_seq.astype(np.int64)
    ops_at = start + 32 + l_name
    seq_at = ops_at + 4 * n_ops
    aux = seq_at + (l_seq + 1) // 2 + l_seq
    if (l_seq < 0).any() or (aux > start + size).any():
        raise FormatError("record ends early")
    tags = Tags(data, aux, start + size)
    # an alignment with more operations than its field can count has them in a tag, and two that stand for them
    head = np.zeros((len(start), 2), np.uint32)
    two = n_ops == 2
    if two.any():
        head[two] = _gather(data, np.repeat(ops_at[two], 2) + np.tile([0, 4], int(two.sum())), "<u4").reshape(-1, 2)
    long = two & (head[:, 0] == (l_seq << 4 | OPERATIONS.index("S"))) & ((head[:, 1] & 15) == OPERATIONS.index("N")) & tags.arrays("CG", "I")
    cg_at, cg_n = tags.span("CG", long)
    ops_at, n_ops = np.where(long, cg_at, ops_at), np.where(long, cg_n, n_ops)
    packed = _spans(data, ops_at, 4 * n_ops).view("<u4") if len(start) else np.zeros(0, np.uint32)
    letters = pa.DictionaryArray.from_arrays(pa.array((packed & 15).astype(np.int32), mask=(packed & 15) >= len(OPERATIONS)), pa.array(list(OPERATIONS))).cast(pa.string())
    cigar = nested_list(n_ops, pa.StructArray.from_arrays([letters, pa.array((packed >> 4).astype(np.int64))], ["op", "len"]))
    # two letters for each packed byte; the second of an odd last one is none
    half = (l_seq + 1) // 2
    pairs = _PAIRS[_spans(data, seq_at, half)].ravel()
    seq = _texts(pairs, 2 * (np.cumsum(half) - half), l_seq)
    pair = tags.texts("MM") & tags.arrays("ML", "C")  # a pair counts only as a whole
    other = ~pair & tags.texts("Mm") & tags.arrays("Ml", "C")
    (mm_at, mm_n), (low_at, low_n) = tags.span("MM", pair), tags.span("Mm", other)
    (ml_at, ml_n), (lower_at, lower_n) = tags.span("ML", pair), tags.span("Ml", other)
    has, ml_n = pair | other, ml_n + lower_n
    edges = pa.array(np.concatenate([[0], np.cumsum(ml_n)]), pa.int32(), mask=np.append(~has, False))
    ml = pa.ListArray.from_arrays(edges, pa.array(_spans(data, ml_at + lower_at, ml_n).astype(np.int32)))
    known = (ref_id >= 0) & (ref_id < len(names))
    chrom = pa.array(names, pa.string()).take(pa.array(np.where(known, ref_id, 0), pa.int32(), mask=~known)) if names else pa.nulls(len(start), pa.string())
    sa = tags.texts("SA")
    columns = [
        pa.array(ordinals, pa.int64()), pa.array(ref_id), chrom, pa.array(pos), pa.array(flag.astype(np.int32)),
        _texts(data, start + 32, np.maximum(l_name - 1, 0), encoding="utf-8"), pa.array(l_seq.astype(np.int32)), seq, cigar, _texts(data, mm_at + low_at, mm_n + low_n, has), ml, _texts(data, *tags.span("SA", sa), sa),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.replace("array<struct<op:string,len:bigint>>", "x").split(", ")])


def _sound(blocks: Blocks, at: int, n_refs: int, left: int = SOUND) -> bool:
    while left:
        head = blocks.need(at, 36)
        if not head:
            return left < SOUND
        if len(head) < 36:
            return False
        size, ref_id, pos, l_name, _, _, n_cigar, _, l_seq, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", head)
        if not (-1 <= ref_id < n_refs and -1 <= mate < n_refs and pos >= -1 and mate_pos >= -1 and l_name >= 1 and 0 <= l_seq):
            return False
        if not 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq <= size < 1 << 28:
            return False
        name = blocks.need(at + 36, l_name)
        if len(name) < l_name or name[-1] or 0 in name[:-1]:
            return False
        at, left = at + 4 + size, left - 1
    return True


@dataclass
class Split(InputPartition):
    path: str
    file: int
    begin: int
    end: int


class BamReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int, mapped: bool):
        self.paths, self.split_bytes, self.mapped, self.pushed = paths, split_bytes, mapped, []

    def pushFilters(self, filters):
        """Conditions on numbers of a record's fixed part are tested before anything else of it is decoded."""
        for f in filters:
            if compares(f, ("ref_id", "pos", "flag", "l_seq")):
                self.pushed.append(f)
            else:
                yield f

    def fits(self, columns: dict) -> np.ndarray:
        out = np.ones(len(columns["flag"]), bool)
        if self.mapped:
            out &= (columns["flag"] & 0x104 == 0) & (columns["ref_id"] >= 0)
        for f in self.pushed:
            out &= holds(f, columns)
        return out

    def partitions(self):
        out = []
        for k, path in enumerate(self.paths):
            size = open_file(path).size()
            cuts = piece_starts(path) if path.endswith(PIECES) else list(range(0, max(size, 1), self.split_bytes))
            out += [Split(path, k, a, b) for a, b in zip(cuts, [*cuts[1:], size])]
        return out

    def read(self, split: Split):
        refs, first = read_header(start := Blocks(split.path))
        names = [n for n, _ in refs]
        blocks, at = start, first
        if split.begin:
            begin = _block_after(split.path, split.begin)
            if begin is None:
                return
            if begin > blocks.offset(at)[0] or not blocks.starts:
                blocks, at = Blocks(split.path, begin), 0
                while not _sound(blocks, at, len(refs)):
                    at += 1
                    if not blocks.need(at, 36) or (blocks.offset(at)[0] >= split.end):
                        return
        first, starts, sizes, ordinals = at, [], [], []

        def flush():
            data = np.frombuffer(blocks.need(first, at - first), np.uint8)
            return decode_records(data, np.array(starts, np.int64) - first, np.array(sizes, np.int64), np.array(ordinals, np.int64), names, self.fits)

        while True:
            head = blocks.need(at, 4)
            if not head:
                break
            if len(head) < 4:
                raise FormatError("file ends within a record")
            offset, inside = blocks.offset(at)
            if offset >= split.end:
                break
            size = struct.unpack("<i", head)[0]
            if size < 32 or len(blocks.need(at + 4, size)) < size:
                raise FormatError("file ends within a record")
            starts.append(at + 4)
            sizes.append(size)
            ordinals.append(split.file << 56 | offset << 16 | inside)
            at += 4 + size
            if len(starts) >= BATCH_ROWS or at - first >= BATCH_BYTES:
                yield flush()
                blocks.forget(at)
                first, starts, sizes, ordinals = at, [], [], []
        if starts:
            yield flush()


def _block_after(path: str, offset: int) -> int | None:
    """First block at or after ``offset`` from which two blocks in a row are sound; None if there is none."""
    stream = open_file(path)
    size = stream.size()
    stream.seek(offset)
    window = stream.read(min(1 << 17, size - offset))
    at = window.find(b"\x1f\x8b\x08")
    while at >= 0:
        try:
            stream.seek(offset + at)
            if read_block(stream) is not None and (stream.tell() >= size or read_block(stream) is not None):
                return offset + at
        except (FormatError, zlib.error, struct.error):
            pass
        at = window.find(b"\x1f\x8b\x08", at + 1)
    return None


class BamDataSource(DataSource):
    """Options: path (comma-separated list), splitBytes, mapped (only mapped, non-secondary records)."""

    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        paths = [p for p in self.options["path"].split(",") if p]
        return BamReader(paths, int(self.options.get("splitbytes", self.options.get("splitBytes", 128 << 20))), self.options.get("mapped", "false").lower() == "true")


def references(spark, path: str):
    """ref_id, chrom and length in the order of the header; files of a list must have the same references."""
    refs, *others = [read_header(Blocks(p))[0] for p in path.split(",") if p]
    if any(o != refs for o in others):
        raise FormatError("files with different references")
    return spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(refs)], "ref_id int, chrom string, length long")


def read_bam(spark, path: str, **options):
    allow_pushdown(spark)
    spark.dataSource.register(BamDataSource)
    return spark.read.format("bam").options(**options).load(path)

"""R serialization (version 3): a sink for the mappings table that executors write, and a source for saved data frames.

An RDS file is one stream with one column after the other. Each task encodes the values of its rows, column by column, and
compresses them to gzip members in a file of the shared folder; the commit writes what stands between columns and appends the
members in the order of the tasks. The driver sees no value, nothing is sorted or read twice, and the file appears only when it is whole.

To read, the stream is walked once to find where columns begin and where every so many rows of them stand; tasks then
decode stretches of rows, from the gzip member on in which they begin.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.staging import shared_dir
from .files import FormatError, at_path

#: Item kinds and flags, versions and encodings of the serialization (fixed values of R's format).
NIL, REFERENCE, ALTERNATIVE, SYMBOL, PAIR, CHARS, LOGICALS, INTEGERS, REALS, STRINGS, LIST = 254, 255, 238, 1, 2, 9, 10, 13, 14, 16, 19
IS_OBJECT, HAS_ATTRIBUTES, HAS_TAG, ASCII, UTF8 = 0x100, 0x200, 0x400, 0x40000, 0x8000
FORMAT, WRITER, READER = 3, 0x00040403, 0x00030500
NA_INTEGER = -(1 << 31)
CLASS = ["tbl_df", "tbl", "data.frame"]
STRANDS = ["+", "-", "*"]
#: Encoded bytes of a column that become one gzip member.
MEMBER_BYTES = 4 << 20
#: Rows between two places of a column that a reader can begin at.
STEP_ROWS = 4096


# Writing


def length(n: int) -> bytes:
    return struct.pack(">i", n) if n < 1 << 31 else struct.pack(">iII", -1, n >> 32, n & 0xFFFFFFFF)  # long vectors


def begin(kind: int, n: int, flags: int = 0) -> bytes:
    return struct.pack(">i", kind | flags) + length(n)


def chars(text: str | None) -> bytes:
    if text is None:
        return struct.pack(">ii", CHARS, -1)
    data = text.encode()
    return struct.pack(">ii", CHARS | (ASCII if data.isascii() else UTF8), len(data)) + data


def strings(values: list[str]) -> bytes:
    return begin(STRINGS, len(values)) + b"".join(map(chars, values))


class Symbols:
    """Names of attributes: written out where they first stand, as numbers later."""

    def __init__(self, known: tuple[str, ...] = ()):
        self.number = {name: k + 1 for k, name in enumerate(known)}

    def tag(self, name: str) -> bytes:
        head = struct.pack(">i", PAIR | HAS_TAG)
        if name in self.number:
            return head + struct.pack(">i", self.number[name] << 8 | REFERENCE)
        self.number[name] = len(self.number) + 1
        return head + struct.pack(">i", SYMBOL) + chars(name)

    def table(self, rows: bytes, names: list[str]) -> bytes:
        """row.names, names and class of a tibble, whose rows are given as an item."""
        return self.tag("row.names") + rows + self.tag("names") + strings(names) + self.tag("class") + strings(CLASS) + struct.pack(">i", NIL)

    def factor(self, levels: list[str]) -> bytes:
        return self.tag("levels") + strings(levels) + self.tag("class") + strings(["factor"]) + struct.pack(">i", NIL)


#: Symbols that stand before the first nested table, and before all others (fixed by the order of the columns).
_BEFORE_NESTED, _WITHIN = ("levels", "class"), ("levels", "class", "row.names", "names")


def _numbers(array: pa.Array, kind: str, missing) -> bytes:
    return (array.fill_null(missing) if array.null_count else array).to_numpy(zero_copy_only=False).astype(kind).tobytes()


class Nested:
    """Encodes the cells of mappings as tables of one row for each bin."""

    def __init__(self, names: list[str]):
        self.names = names

    def one(self, columns: list[np.ndarray], symbols: Symbols) -> bytes:
        n = len(columns[0])
        values = b"".join(begin(REALS, n) + c.tobytes() for c in columns)
        rows = begin(INTEGERS, n) + np.arange(1, n + 1, dtype=">i4").tobytes()
        return begin(LIST, len(columns), IS_OBJECT | HAS_ATTRIBUTES) + values + symbols.table(rows, self.names)

    def rows(self, cells: pa.Array):
        """The columns of each row's table, as big-endian bytes."""
        size = cells.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = cells.flatten()
        columns = [flat.field(k).cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(">f8") for k in range(len(self.names))]
        past = np.cumsum(size)
        for a, b in zip((past - size).tolist(), past.tolist()):
            yield [c[a:b] for c in columns]


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: its file, its rows, and where the members of each column stand in it; the first nested table comes in two
    forms, of which the file's very first row takes the one with symbols."""

    task: int
    file: str
    rows: int
    members: list = field(default_factory=list)


class RdsWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, columns: list[str], inner: list[str]):
        self.path, self.parts, self.level = options["path"], options["parts"], int(options.get("level", 6))
        self.levels, self.columns, self.inner = json.loads(options["levels"]), columns, inner

    def write(self, iterator):
        system, folder = at_path(self.parts)
        system.create_dir(folder, recursive=True)
        task = TaskContext.get().partitionId()
        part = Part(task, f"{folder}/{task}-{uuid.uuid4().hex}", 0)
        waiting: dict = {c: bytearray() for c in self.columns}
        nested, known = Nested(self.inner), Symbols(_WITHIN)
        with system.open_output_stream(part.file, compression=None) as out:

            def flush(column, data):
                packed = gzip.compress(bytes(data), self.level, mtime=0)
                part.members.append((column, out.tell(), len(packed)))
                out.write(packed)

            for batch in iterator:
                for c, array in zip(self.columns, batch.columns):
                    if c == "signalbin":
                        for table in nested.rows(array):
                            if not part.rows and not any(m[0] == "head" for m in part.members):
                                flush("first", nested.one(table, Symbols(_BEFORE_NESTED)))
                                flush("head", nested.one(table, known))
                            else:
                                waiting[c] += nested.one(table, known)
                    elif c == "read_id":
                        waiting[c] += b"".join(map(chars, array.to_pylist()))
                    elif c == "flag":
                        waiting[c] += _numbers(array.cast(pa.int32()), ">i4", NA_INTEGER)
                    elif c == "ref_id":
                        waiting[c] += _numbers(pc.add(array.cast(pa.int32()), 1), ">i4", NA_INTEGER)
                    elif c == "strand":
                        waiting[c] += _numbers(pc.add(pc.index_in(array, pa.array(STRANDS)), 1), ">i4", NA_INTEGER)
                    else:
                        waiting[c] += _numbers(array.cast(pa.float64()), ">f8", float("nan"))
                    if len(waiting[c]) >= MEMBER_BYTES:
                        flush(c, waiting[c])
                        waiting[c].clear()
                part.rows += batch.num_rows
            for c, data in waiting.items():
                if data:
                    flush(c, data)
        return part

    def commit(self, messages):
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        n, symbols = sum(p.rows for p in parts), Symbols()
        system, folder = at_path(self.parts)
        target, path = at_path(self.path)
        names = ["chrom" if c == "ref_id" else c for c in self.columns]
        kinds = {"read_id": (STRINGS, 0), "flag": (INTEGERS, 0), "ref_id": (INTEGERS, IS_OBJECT | HAS_ATTRIBUTES), "strand": (INTEGERS, IS_OBJECT | HAS_ATTRIBUTES), "signalbin": (LIST, 0)}
        with target.open_output_stream(f"{path}.part", compression=None) as out:
            put = lambda data: out.write(gzip.compress(data, self.level, mtime=0))
            put(b"X\n" + struct.pack(">iiii", FORMAT, WRITER, READER, 5) + b"UTF-8" + begin(LIST, len(names), IS_OBJECT | HAS_ATTRIBUTES))
            for c in self.columns:
                kind, flags = kinds.get(c, (REALS, 0))
                put(begin(kind, n, flags))
                first = c == "signalbin"
                for p in parts:
                    if not p.rows:
                        continue
                    wanted = [m for m in p.members if m[0] == ("first" if first else "head")] if c == "signalbin" else []
                    first = False
                    with system.open_input_file(p.file) as f:
                        for _, at, size in [*wanted, *(m for m in p.members if m[0] == c)]:
                            f.seek(at)
                            out.write(f.read(size))
                if c == "ref_id":
                    put(symbols.factor(self.levels))
                elif c == "strand":
                    put(symbols.factor(STRANDS))
                elif c == "signalbin" and n:
                    symbols = Symbols(_WITHIN)  # its first row wrote them
            put(symbols.table(begin(INTEGERS, 2) + struct.pack(">ii", NA_INTEGER, -n), names))
        target.move(f"{path}.part", path)
        system.delete_dir(folder)

    def abort(self, messages):
        system, folder = at_path(self.parts)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)
        target, path = at_path(self.path)
        if target.get_file_info(f"{path}.part").type == fs.FileType.File:
            target.delete_file(f"{path}.part")


class RdsDataSource(DataSource):
    """Options: path, parts (folder that the driver and all executors share), levels (JSON list of the references), level."""

    @classmethod
    def name(cls):
        return "rds"

    def writer(self, schema, overwrite):
        return RdsWriter(dict(self.options), schema.names, schema["signalbin"].dataType.elementType.names)


def write_rds(table: DataFrame, refs: DataFrame, path: str, level: int = 6) -> None:
    """Write nested mappings (read_id, flag, ref_id, strand, start, end, signalbin, medians) in the order of their partitions.

    Missing numbers become NaN. ``table`` is read once. The file is one stream, so the commit appends it on the driver, which needs
    no more memory than one member."""
    spark = table.sparkSession
    spark.dataSource.register(RdsDataSource)
    levels = [r.chrom for r in refs.orderBy("ref_id").collect()]
    medians = [c for c in table.columns if c.startswith("med_signal")]
    rows = table.select("read_id", "flag", "ref_id", "strand", "start", "end", "signalbin", *medians)
    parts = f"{shared_dir(spark)}/strandlab/rds-{uuid.uuid4().hex}"
    rows.write.format("rds").options(parts=parts, levels=json.dumps(levels), level=str(level)).mode("append").save(path)


# Reading


class Inflated:
    """The plain bytes of a file, gzip or not, from one of its members on; remembers where members begin."""

    def __init__(self, path: str, member: tuple[int, int] = (0, 0)):
        system, inner = at_path(path)
        self.file = system.open_input_file(inner)
        self.packed = self.file.read(2) == b"\x1f\x8b"
        self.file.seek(member[0])
        self.at, self.buffer, self.place = member[1], b"", 0
        self.inflater, self.members = zlib.decompressobj(31) if self.packed else None, [member]

    def _more(self) -> bool:
        raw = self.file.read(1 << 18)
        if not raw:
            return False
        if not self.packed:
            self.buffer, self.place = self.buffer[self.place :] + raw, 0
            return True
        out = [self.buffer[self.place :]]
        plain = self.at + len(out[0])
        while raw:
            out.append(self.inflater.decompress(raw))
            plain += len(out[-1])
            raw = self.inflater.unused_data
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(31)
                self.members.append((self.file.tell() - len(raw), plain))
        self.buffer, self.place = b"".join(out), 0
        return True

    def read(self, n: int) -> bytes:
        while len(self.buffer) - self.place < n:
            if not self._more():
                raise FormatError("file ends early")
        self.place, self.at = self.place + n, self.at + n
        return self.buffer[self.place - n : self.place]

    def skip(self, n: int) -> None:
        while n > 0:
            step = min(n, 1 << 20)
            self.read(step)
            n -= step

    def ints(self, n: int = 1):
        return struct.unpack(f">{n}i", self.read(4 * n))

    def length(self) -> int:
        n = self.ints()[0]
        if n == -1:
            high, low = struct.unpack(">II", self.read(8))
            return high << 32 | low
        return n


@dataclass
class Item:
    """A value with its kind and attributes; a skipped one has no value."""

    kind: int
    value: object = None
    attributes: dict = field(default_factory=dict)


class Parser:
    """Items of a stream. ``symbols`` grows as they are defined, unless it is given whole to a reader that begins further on."""

    def __init__(self, stream: Inflated, symbols: list[str] | None = None):
        self.stream, self.symbols, self.whole = stream, [] if symbols is None else symbols, symbols is not None

    def header(self) -> None:
        if self.stream.read(2) != b"X\n":
            raise FormatError("not a binary R serialization")
        version = self.stream.ints(3)[0]
        if version not in (2, 3):
            raise FormatError("unknown version of the serialization")
        if version == 3:
            self.stream.skip(self.stream.ints()[0])

    def text(self) -> str | None:
        flags, n = self.stream.ints(2)
        if flags & 255 != CHARS:
            raise FormatError("not a text")
        return None if n < 0 else self.stream.read(n).decode("utf-8" if flags & (UTF8 | ASCII) else "latin-1")

    def _pairs(self, flags: int) -> dict:
        """A list of tagged values, of which the flags of the first are read."""
        out = {}
        while flags & 255 == PAIR:
            if flags & HAS_ATTRIBUTES:
                self.item(self.stream.ints()[0])
            tag = self.item(self.stream.ints()[0]).value if flags & HAS_TAG else len(out)
            out[tag] = self.item(self.stream.ints()[0])
            flags = self.stream.ints()[0]
        if flags & 255 != NIL:
            raise FormatError("a list of attributes does not end")
        return out

    def item(self, flags: int | None = None) -> Item:
        flags = self.stream.ints()[0] if flags is None else flags
        kind, read = flags & 255, self.stream.read
        if kind == NIL:
            return Item(kind)
        if kind == REFERENCE:
            number = flags >> 8 or self.stream.ints()[0]
            return Item(SYMBOL, self.symbols[number - 1])
        if kind == SYMBOL:
            name = self.text()
            if not self.whole:
                self.symbols.append(name)
            return Item(kind, name)
        if kind == PAIR:
            return Item(kind, self._pairs(flags))
        if kind == ALTERNATIVE:
            return self._alternative()
        if kind not in (LOGICALS, INTEGERS, REALS, STRINGS, LIST):
            raise FormatError(f"an item of kind {kind} is not one of a data frame")
        n = self.stream.length()
        if kind in (LOGICALS, INTEGERS):
            value = np.frombuffer(read(4 * n), ">i4").astype(np.int32)
        elif kind == REALS:
            value = np.frombuffer(read(8 * n), ">f8").astype(float)
        elif kind == STRINGS:
            value = [self.text() for _ in range(n)]
        else:
            value = [self.item() for _ in range(n)]
        return Item(kind, value, self.attributes(flags))

    def attributes(self, flags: int) -> dict:
        return self._pairs(self.stream.ints()[0]) if flags & HAS_ATTRIBUTES else {}

    def _alternative(self) -> Item:
        """Compact sequences, and wrapped vectors."""
        info, state, attributes = self.item().value, self.item(), self.item()
        name = next(iter(info.values())).value
        extra = attributes.value if attributes.kind == PAIR else {}
        if name in ("compact_intseq", "compact_realseq"):
            n, first, step = (float(x) for x in state.value)
            value = first + step * np.arange(int(n))
            return Item(INTEGERS, value.astype(np.int32), extra) if name == "compact_intseq" else Item(REALS, value, extra)
        if name.startswith("wrap_"):
            inner = state.value[0] if state.kind == LIST else next(iter(state.value.values()))
            return Item(inner.kind, inner.value, extra or inner.attributes)
        raise FormatError(f"a vector of class {name} is not one of a data frame")


@dataclass
class Column:
    """A column: its kind and attributes (levels, class), and where rows 0, STEP_ROWS, ... begin in the plain stream."""

    name: str = ""
    kind: int = 0
    marks: list = field(default_factory=list)
    attributes: dict = field(default_factory=dict)
    inner: list = field(default_factory=list)
    inner_attributes: dict = field(default_factory=dict)


@dataclass
class Index:
    path: str
    rows: int
    columns: list
    attributes: dict
    symbols: list
    members: list
    step: int = STEP_ROWS


def plain(attributes: dict) -> dict:
    """Attributes as plain lists; numbers only by what they are, as they depend on the rows."""
    return {k: v.value if v.kind == STRINGS else ("numbers" if v.kind in (INTEGERS, REALS, LOGICALS) else v.value) for k, v in attributes.items()}


def index_rds(path: str) -> Index:
    """Walk a saved data frame once, in bounded memory, and note its columns and where their rows stand."""
    stream = Inflated(path)
    parser = Parser(stream)
    parser.header()
    flags = stream.ints()[0]
    if flags & 255 != LIST:
        raise FormatError("not a data frame")
    columns, rows, step = [], 0, STEP_ROWS
    for _ in range(stream.length()):
        column, own = Column(), stream.ints()[0]
        column.kind = own & 255
        if column.kind == ALTERNATIVE:
            raise FormatError("columns that are compact sequences are not read")
        rows = stream.length()
        for row in range(0, rows, step):
            column.marks.append(stream.at)
            n = min(step, rows - row)
            if column.kind in (LOGICALS, INTEGERS, REALS):
                stream.skip(n * (8 if column.kind == REALS else 4))
            elif column.kind == STRINGS:
                for _ in range(n):
                    stream.skip(max(0, stream.ints(2)[1]))
            elif column.kind == LIST:
                for k in range(n):
                    item = parser.item()
                    if not row and not k:
                        column.inner_attributes = plain(item.attributes)
                        column.inner = column.inner_attributes.get("names", [])
            else:
                raise FormatError(f"a column of kind {column.kind} is not read")
        column.attributes = plain(parser.attributes(own))
        columns.append(column)
    attributes = parser.attributes(flags)
    for column, name in zip(columns, attributes["names"].value):
        column.name = name
    return Index(path, rows, columns, plain(attributes), parser.symbols, stream.members, step)


def _type_of(column: Column) -> T.DataType:
    if column.kind == LIST:
        cell = T.StructType()
        for name in column.inner or ["positions"]:
            cell = cell.add(name, T.DoubleType())
        return T.ArrayType(cell)
    if column.kind == STRINGS or "levels" in column.attributes:
        return T.StringType()
    return {LOGICALS: T.BooleanType(), INTEGERS: T.IntegerType(), REALS: T.DoubleType()}[column.kind]


def _values(index: Index, column: Column, step: int) -> pa.Array:
    """A column's rows from its mark number ``step`` on."""
    n = min(index.step, index.rows - index.step * step)
    place = column.marks[step]
    member = max(m for m in index.members if m[1] <= place)
    stream = Inflated(index.path, member)
    stream.skip(place - stream.at)
    parser = Parser(stream, index.symbols)
    if column.kind == STRINGS:
        return pa.array([parser.text() for _ in range(n)], pa.string())
    if column.kind == REALS:
        return pa.array(np.frombuffer(stream.read(8 * n), ">f8").astype(float))
    if column.kind in (INTEGERS, LOGICALS):
        value = np.frombuffer(stream.read(4 * n), ">i4").astype(np.int32)
        missing = value == NA_INTEGER
        if "levels" in column.attributes:
            return pa.array(column.attributes["levels"], pa.string()).take(pa.array(np.where(missing, 0, value - 1), pa.int32(), mask=missing))
        return pa.array(value != 0 if column.kind == LOGICALS else value, mask=missing)
    tables = [parser.item() for _ in range(n)]
    names = column.inner or ["positions"]
    size = [len(t.value[0].value) if t.value else 0 for t in tables]
    if any(plain(t.attributes).get("names", []) != column.inner or any(len(c.value) != s for c in t.value) for t, s in zip(tables, size)):
        raise FormatError("nested tables of different columns")
    fields = [pa.array(np.concatenate([np.zeros(0), *(np.asarray(t.value[k].value, float) for t in tables if t.value)])) for k in range(len(names))]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.StructArray.from_arrays(fields, names))


def read_rds(spark: SparkSession, path: str, index: Index | None = None) -> DataFrame:
    """A saved data frame as ``row`` (from 0) and its columns: factors as texts, missing values as nulls except for numbers, which keep NaN,
    nested tables as arrays of structs.

    The stream is walked once to find its columns, where none is given; tasks decode STEP_ROWS rows each. The file must be
    where all executors see it."""
    index = index_rds(path) if index is None else index
    schema = T.StructType().add("row", T.LongType())
    for c in index.columns:
        schema = schema.add(c.name, _type_of(c))

    def rows(batches):
        for batch in batches:
            for step in batch.column(0).to_pylist():
                first, past = index.step * step, min(index.rows, index.step * (step + 1))
                columns = [_values(index, c, step) for c in index.columns]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, past)), *columns], schema.names)

    steps = -(-index.rows // index.step)
    return spark.range(0, steps, 1, max(1, min(steps, 4096))).mapInArrow(rows, schema)

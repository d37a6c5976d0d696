"""bigWig tracks: a data source that reads sections in parallel, and a writer.

The layout follows the format's published description: header, zoom headers, chromosome B+ tree, zlib sections of
(start, end, value), an R-tree over the sections, and levels of summaries with R-trees of their own. Conditions on chromosome, start
and end open only those nodes of the R-tree, and read only those sections, that can hold rows for them.
"""

from __future__ import annotations

import os
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from ..functions.staging import stage, unstage
from .files import FormatError, open_file
from .pushdown import allow_pushdown, bounds, compares, values_of

SCHEMA = "chrom string, start long, end long, value float"
#: Marks of the file, its chromosome tree and its R-tree (fixed values of the format).
MAGIC, TREE_MAGIC, INDEX_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
SECTION_ITEMS, ZOOM_ITEMS = 1024, 512
#: Bases summed in one record of each zoom level.
ZOOMS = (1_000, 8_000, 64_000, 512_000)


def _at(stream, offset: int, layout: str):
    stream.seek(offset)
    data = stream.read(struct.calcsize(layout))
    if len(data) < struct.calcsize(layout):
        raise FormatError("file ends early")
    return struct.unpack(layout, data)


def chromosomes(stream) -> dict[int, tuple[str, int]]:
    """Number to (name, length)."""
    head = _at(stream, 0, "<IHHQQQ")
    if head[0] != MAGIC:
        raise FormatError("not a bigWig file")
    tree = head[3]
    magic, _, key_size, _, _, _ = _at(stream, tree, "<IIIIQQ")
    if magic != TREE_MAGIC:
        raise FormatError("no chromosome tree")
    out, todo = {}, [tree + 32]
    while todo:
        at = todo.pop()
        leaf, _, count = _at(stream, at, "<BBH")
        at += 4
        for _ in range(count):
            key, *rest = _at(stream, at, f"<{key_size}sII" if leaf else f"<{key_size}sQ")
            if leaf:
                out[rest[0]] = key.rstrip(b"\0").decode(), rest[1]
            else:
                todo.append(rest[0])
            at += key_size + 8
    return out


@dataclass
class Wanted:
    """What is asked for: chromosome numbers (None: all), and the lowest and highest place that a row can touch."""

    chroms: set | None = None
    low: float = float("-inf")
    high: float = float("inf")

    def meets(self, first: int, start: int, last: int, end: int) -> bool:
        """Whether a stretch from (first, start) to (last, end) can hold such rows."""
        chroms = [first, last] if self.chroms is None else [c for c in self.chroms if first <= c <= last]
        if self.chroms is None and first != last:
            return True
        return any((c > first or start <= self.high) and (c < last or end >= self.low) for c in chroms)


def sections(stream, wanted: Wanted = Wanted(), at: int | None = None) -> list[tuple[int, int]]:
    """(offset, size) of the data sections that can hold wanted rows, in order; other nodes of the index are not opened. ``at`` is the
    place of another index than that of the data."""
    index = _at(stream, 0, "<IHHQQQ")[5] if at is None else at
    if _at(stream, index, "<I")[0] != INDEX_MAGIC:
        raise FormatError("no index")
    out, todo = [], [index + 48]
    while todo:
        at = todo.pop()
        leaf, _, count = _at(stream, at, "<BBH")
        for k in range(count):
            *stretch, offset = _at(stream, at + 4 + (32 if leaf else 24) * k, "<IIIIQ")
            if wanted.meets(*stretch):
                if leaf:
                    out.append((offset, _at(stream, at + 4 + 32 * k + 24, "<Q")[0]))
                else:
                    todo.append(offset)
    return sorted(out)


def intervals_of(data: bytes, names: dict) -> list[tuple]:
    """Rows of one inflated section of any of the three item kinds."""
    chrom, start, _, step, span, kind, _, count = struct.unpack_from("<IIIIIBBH", data)
    name = names[chrom][0]
    if kind == 1:
        return [(name, *struct.unpack_from("<IIf", data, 24 + 12 * i)) for i in range(count)]
    if kind == 2:
        items = [struct.unpack_from("<If", data, 24 + 8 * i) for i in range(count)]
        return [(name, s, s + span, v) for s, v in items]
    if kind == 3:
        return [(name, start + i * step, start + i * step + span, struct.unpack_from("<f", data, 24 + 4 * i)[0]) for i in range(count)]
    raise FormatError("unknown section kind")


@dataclass
class Sections(InputPartition):
    path: str
    places: list


class BigWigReader(DataSourceReader):
    def __init__(self, path: str, each: int):
        self.path, self.each, self.filters = path, each, []

    def pushFilters(self, filters):
        """Conditions choose sections; Spark tests them again on the rows."""
        for f in filters:
            if compares(f, ("start", "end")) or (isinstance(f, (EqualTo, In)) and f.attribute == ("chrom",)):
                self.filters.append(f)
            yield f

    def wanted(self, stream) -> Wanted:
        (a, b), (c, d) = bounds(self.filters, "start"), bounds(self.filters, "end")
        out = Wanted(None, max(a, c), min(b, d))
        for f in self.filters:
            if f.attribute == ("chrom",):
                found = {k for k, (name, _) in chromosomes(stream).items() if name in values_of(f)}
                out.chroms = found if out.chroms is None else out.chroms & found
        return out

    def partitions(self):
        stream = open_file(self.path)
        found = sections(stream, self.wanted(stream))
        return [Sections(self.path, found[i : i + self.each]) for i in range(0, len(found), self.each)] or [Sections(self.path, [])]

    def read(self, part: Sections):
        stream = open_file(part.path)
        names, packed = chromosomes(stream), _at(stream, 52, "<I")[0] > 0
        for offset, size in part.places:
            stream.seek(offset)
            data = stream.read(size)
            rows = intervals_of(zlib.decompress(data) if packed else data, names)
            if rows:
                chrom, start, end, value = zip(*rows)
                yield pa.record_batch([pa.array(chrom), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(value, pa.float32())], names=["chrom", "start", "end", "value"])


class BigWigDataSource(DataSource):
    """Options: path, sectionsPerTask."""

    @classmethod
    def name(cls):
        return "bigwig"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return BigWigReader(self.options["path"], int(self.options.get("sectionspertask", self.options.get("sectionsPerTask", 256))))


def read_bigwig(spark, path: str, **options) -> DataFrame:
    """chrom, start, end and value of a track; conditions on the first three read only the sections they need."""
    allow_pushdown(spark)
    spark.dataSource.register(BigWigDataSource)
    return spark.read.format("bigwig").options(**options).load(path)


def _tree(entries: list[tuple], size: int, items: int, at: int, pack_leaf, pack_node, cover) -> bytes:
    """Nodes of a search tree over ``entries`` in one piece that begins at file offset ``at``, root first."""
    levels = [entries]
    while len(levels[-1]) > items:
        level = levels[-1]
        levels.append([cover(level[i : i + items]) for i in range(0, len(level), items)])
    levels.reverse()
    node_sizes = [(4 + items * (size if k == len(levels) - 1 else size_of_node(pack_node))) for k in range(len(levels))]
    starts, place = [], at
    for level, width in zip(levels, node_sizes):
        starts.append(place)
        place += width * max(1, -(-len(level) // items))
    out = b""
    for k, level in enumerate(levels):
        leaf = k == len(levels) - 1
        for i in range(0, max(1, len(level)), items):
            part = level[i : i + items]
            body = b"".join(pack_leaf(e) if leaf else pack_node(e, starts[k + 1] + (i + j) * node_sizes[k + 1]) for j, e in enumerate(part))
            out += (struct.pack("<BBH", leaf, 0, len(part)) + body).ljust(node_sizes[k], b"\0")
    return out


def size_of_node(pack_node) -> int:
    return pack_node.size


class _Index:
    """Packs an R-tree entry (first chromosome, start, last chromosome, end, offset, size)."""

    size = 24

    def __call__(self, entry, child):
        return struct.pack("<IIIIQ", *entry[:4], child)

    @staticmethod
    def cover(part):
        first, last = min((e[0], e[1]) for e in part), max((e[2], e[3]) for e in part)
        return *first, *last, 0, 0


_DATA = np.dtype([("start", "<u4"), ("end", "<u4"), ("value", "<f4")])
_ZOOM = np.dtype([("ref_id", "<u4"), ("start", "<u4"), ("end", "<u4"), ("bases", "<u4"), ("low", "<f4"), ("high", "<f4"), ("sum", "<f4"), ("squares", "<f4")])


def zoom_levels(track: DataFrame) -> list[DataFrame]:
    """Staged summaries (ref_id, start, end, bases, low, high, sum, squares) of stretches of ZOOMS bases, each level from the one before."""
    value = F.col("value").cast("double")
    cut = track.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / ZOOMS[0]), F.floor((F.col("end") - 1) / ZOOMS[0]))))
    cut = cut.select("ref_id", F.greatest("start", F.col("bin") * ZOOMS[0]).alias("start"), F.least("end", (F.col("bin") + 1) * ZOOMS[0]).alias("end"), value.alias("low"), value.alias("high"))
    bases = F.col("end") - F.col("start")
    rows, out = cut.select("*", bases.alias("bases"), (bases * F.col("low")).alias("sum"), (bases * F.col("low") * F.col("low")).alias("squares")), []
    for size in ZOOMS:
        sums = [F.min("start").alias("start"), F.max("end").alias("end"), F.sum("bases").alias("bases"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("sum").alias("sum"), F.sum("squares").alias("squares")]
        rows = stage(rows.groupBy("ref_id", F.floor(F.col("start") / size).alias("bin")).agg(*sums).drop("bin"), "zoom")
        out.append(rows)
    return out


def _packed(rows: DataFrame, layout: np.dtype, items: int) -> DataFrame:
    """Compressed sections of at most ``items`` rows of one reference, in order: ref_id, start, end, n, data."""

    def pack(batches):
        held = np.zeros(0, [("ref", "<i8"), *layout.descr])

        def section(part):
            body = np.ascontiguousarray(part[list(layout.names)].astype(layout)).tobytes()
            head = struct.pack("<IIIIIBBH", part["ref"][0], part["start"][0], part["end"][-1], 0, 0, 1, 0, len(part)) if layout is _DATA else b""
            return int(part["ref"][0]), int(part["start"][0]), int(part["end"].max()), len(part), zlib.compress(head + body)

        def flush(last: bool):
            nonlocal held
            done, at = [], 0
            runs = [*(np.flatnonzero(np.diff(held["ref"])) + 1).tolist(), len(held)]
            for past in runs:
                whole = last or past < len(held)
                while past - at >= items or (whole and past > at):
                    done.append(section(held[at : min(past, at + items)]))
                    at = min(past, at + items)
            held = held[at:]
            kinds = [pa.int64()] * 4 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done) if done else [[]] * 5, kinds)], ["ref_id", "start", "end", "n", "data"])

        for batch in batches:
            more = np.zeros(batch.num_rows, held.dtype)
            more["ref"] = batch.column(0).to_numpy()
            for name in layout.names:
                more[name] = batch.column(batch.schema.names.index(name)).to_numpy()
            held = np.concatenate([held, more])
            yield flush(False)
        yield flush(True)

    columns = ["ref_id", *[n for n in layout.names if n != "ref_id"]]
    return rows.select(*columns).repartitionByRange("ref_id", "start").sortWithinPartitions("ref_id", "start").mapInArrow(pack, "ref_id long, start long, end long, n long, data binary")


def write_bigwig(track: DataFrame, refs: DataFrame, path: str) -> int:
    """Write ``track`` (ref_id, start, end, value), sorted here, and return its number of intervals.

    Sections and all zoom levels are made and packed by the executors; the driver only appends them to the file one after the other,
    which one file asks for, and keeps one index entry for each section. A table of references comes whole, as a header does.
    The file appears when it is whole; a write that fails leaves none."""
    names = [(r.ref_id, r.chrom, r.length) for r in refs.orderBy("ref_id").collect()]
    track = stage(track.select("ref_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("value").cast("float").alias("value")), "track")
    zooms = zoom_levels(track)
    total = zooms[-1].agg(F.sum("bases").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("sum").alias("sum"), F.sum("squares").alias("squares")).first()
    part = f"{path}.part"
    try:
        with open(part, "wb") as f:
            count = _append(f, track, zooms, names, total)
        os.replace(part, path)
    finally:
        unstage(track, *zooms)
        if os.path.exists(part):
            os.remove(part)
    return count


def _append(f, track: DataFrame, zooms: list[DataFrame], names: list[tuple], total) -> int:
    key_size = max([1, *(len(n.encode()) for _, n, _ in names)])
    tree_at = 64 + 24 * len(zooms)
    f.write(b"\0" * tree_at)
    items = max(1, min(256, len(names)))
    f.write(struct.pack("<IIIIQQ", TREE_MAGIC, items, key_size, 8, len(names), 0))
    leaf = lambda e: struct.pack(f"<{key_size}sII", e[1].encode(), e[0], e[2])

    class Node:
        size = key_size + 8

        def __call__(self, e, child):
            return struct.pack(f"<{key_size}sQ", e[1].encode(), child)

    f.write(_tree(sorted(names, key=lambda n: n[1].encode()), key_size + 8, items, tree_at + 32, leaf, Node(), lambda part: part[0]))
    summary_at = f.tell()
    f.write(struct.pack("<Qdddd", *((int(total.n), total.low, total.high, total.sum, total.squares) if total.n else (0, 0.0, 0.0, 0.0, 0.0))))
    largest = 0

    def run(rows: DataFrame, layout: np.dtype, per: int, counted: str) -> tuple[int, int, int, int]:
        """Append packed sections behind their number, then their index: (where they begin, where the index is, sections, rows)."""
        nonlocal largest
        at, entries, n = f.tell(), [], 0
        f.write(struct.pack(counted, 0))
        for r in _packed(rows, layout, per).toLocalIterator(prefetchPartitions=True):
            entries.append((r.ref_id, r.start, r.ref_id, r.end, f.tell(), len(r.data)))
            f.write(r.data)
            n, largest = n + r.n, max(largest, 24 + layout.itemsize * r.n)
        index_at = f.tell()
        f.write(struct.pack("<IIQIIIIQII", INDEX_MAGIC, 256, len(entries), *(_Index.cover(entries)[:4] if entries else (0, 0, 0, 0)), f.tell(), per, 0))
        f.write(_tree(entries, 32, 256, f.tell(), lambda e: struct.pack("<IIIIQQ", *e), _Index(), _Index.cover))
        return at, index_at, len(entries), n

    data_at, index_at, found, count = run(track, _DATA, SECTION_ITEMS, "<Q")
    places = [(size, *run(z, _ZOOM, ZOOM_ITEMS, "<I")) for size, z in zip(ZOOMS, zooms)]
    f.write(struct.pack("<I", MAGIC))
    f.seek(data_at)
    f.write(struct.pack("<Q", found))
    for _, at, _, _, n in places:
        f.seek(at)
        f.write(struct.pack("<I", n))
    f.seek(0)
    f.write(struct.pack("<IHHQQQHHQQIQ", MAGIC, 4, len(places), tree_at, data_at, index_at, 0, 0, 0, summary_at, largest, 0))
    for size, at, index, _, _ in places:
        f.write(struct.pack("<IIQQ", size, 0, at, index))
    return count


def zoom_records(path: str) -> dict[int, list[tuple]]:
    """Summaries of each zoom level by its bases, for tools that draw: (chrom, start, end, bases, low, high, sum, squares)."""
    stream = open_file(path)
    names, packed = chromosomes(stream), _at(stream, 52, "<I")[0] > 0
    out = {}
    for k in range(_at(stream, 6, "<H")[0]):
        size, _, _, index = _at(stream, 64 + 24 * k, "<IIQQ")
        out[size] = []
        for offset, n in sections(stream, at=index):
            stream.seek(offset)
            data = stream.read(n)
            rows = np.frombuffer(zlib.decompress(data) if packed else data, _ZOOM).tolist()
            out[size] += [(names[r[0]][0], *r[1:]) for r in rows]
    return out

"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark texts become windows of 13 consecutive words; the windows, as byte strings of normalised words, are the
patterns. A block shift table lets the scan skip positions that cannot start a pattern, hash buckets over the last
block of the pattern prefix select the patterns to test, and a direct comparison confirms each occurrence.

The scan keeps one cursor in each stretch of text and moves all cursors by their own shifts at once in numpy, which is
the same search as a single cursor per text. Documents are never shuffled. Windows are sent in blocks of about
``patterns_per_pass`` windows and PASS_BYTES bytes at most; a larger benchmark makes more passes over the same rows,
PASSES_AT_ONCE of them in one Spark stage, whose blocks are all that the driver and the executors hold of the benchmark.
Between such groups of passes the rows they hit are kept by number; texts are written once, however many groups there are.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import group_starts, row_struct, stage, text_runs, unstage

WINDOW_WORDS = 13
#: Bound of one broadcast: windows for each pass (about 100 bytes each).
PATTERNS_PER_PASS = 100_000
PASS_BYTES = 16 << 20
#: Blocks that are held at once; more passes go in groups of so many.
PASSES_AT_ONCE = 4
LANE = 2048
TABLE_BITS = 20

_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of ASCII letters, digits and non-ASCII bytes."""
    return text.translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    """Windows as byte strings ``b" w1 w2 ... "``; fewer words than ``size`` (but some) make one window."""
    if not words:
        return []
    if len(words) < size:
        return [b" " + b" ".join(words) + b" "]
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(len(words) - size + 1)]


class WuManber:
    """Search for byte patterns of similar length: SHIFT over blocks of the first ``m`` bytes, HASH over their last block."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.block = b = min(8, m)
        firsts = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(len(patterns), m)
        self.shift = np.full(1 << TABLE_BITS, m - b + 1, np.uint16 if m > 200 else np.uint8)
        for at in range(m - b + 1):
            h = self._hash(np.ascontiguousarray(firsts[:, at : at + b]))
            np.minimum.at(self.shift, h, m - b - at)
        last = self._hash(np.ascontiguousarray(firsts[:, m - b :]))
        self.order = np.argsort(last, kind="stable")
        self.keys = last[self.order]

    def _hash(self, blocks: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(blocks), 8), np.uint8)
        padded[:, : blocks.shape[1]] = blocks
        return self._slot(padded.view("<u8").ravel())

    @staticmethod
    def _slot(words: np.ndarray) -> np.ndarray:
        return ((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, text: bytes) -> list[tuple[int, int]]:
        """All (position, pattern number) of occurrences in ``text``."""
        n, m, b = len(text), self.m, self.block
        if n < m:
            return []
        data = np.frombuffer(text + b"\0" * 16, np.uint8)
        view = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
        mask = np.uint64((1 << (8 * b)) - 1) if b < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
        cursor = np.arange(0, n - m + 1, LANE)
        limit = np.minimum(cursor + LANE, n - m + 1)
        hits: list[np.ndarray] = []
        slots: list[np.ndarray] = []
        while len(cursor):
            slot = self._slot(view[cursor + (m - b)] & mask)
            step = self.shift[slot].astype(np.int64)
            zero = step == 0
            if zero.any():
                hits.append(cursor[zero])
                slots.append(slot[zero])
            cursor = cursor + np.maximum(step, 1)
            live = cursor < limit
            cursor, limit = cursor[live], limit[live]
        if not hits:
            return []
        at, slot = np.concatenate(hits), np.concatenate(slots)
        low, high = np.searchsorted(self.keys, slot, "left"), np.searchsorted(self.keys, slot, "right")
        found = []
        for p, x, y in zip(at.tolist(), low.tolist(), high.tolist()):
            for k in self.order[x:y].tolist():
                if text.startswith(self.patterns[k], p):
                    found.append((p, k))
        return found


class Matcher:
    """Patterns grouped by length, so that a short one does not shrink the shifts of the rest."""

    def __init__(self, rows: list[tuple[bytes, int]]):
        items: dict[bytes, list[int]] = {}
        for pattern, item in rows:
            items.setdefault(pattern, []).append(item)
        groups: dict[int, list[bytes]] = {}
        for pattern in items:
            groups.setdefault(len(pattern).bit_length(), []).append(pattern)
        self.scans = [(WuManber(group), [items[p] for p in group], [p.count(b" ") - 1 for p in group]) for group in groups.values()]

    def find(self, text: bytes):
        """(position, words of the pattern, its items) of all occurrences in normalised text."""
        for scan, items, sizes in self.scans:
            for p, k in scan.find(text):
                yield p, sizes[k], items[k]


def _benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """window and item of all windows; items keep their type."""
    rows = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).where("item is not null and text is not null")

    def cut(batches):
        for batch in batches:
            found = [(w, i) for i, t in enumerate(batch.column(1).to_pylist()) for w in set(windows_of(words_of(t.encode()), size))]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()), batch.column(0).take(pa.array([i for _, i in found], pa.int64()))], names=["window", "item"])

    return rows.mapInArrow(cut, T.StructType([T.StructField("window", T.BinaryType()), T.StructField("item", rows.schema["item"].dataType)])).distinct()


def _result_type(item: T.DataType) -> T.StructType:
    whole = T.LongType()
    return T.StructType(
        [
            *(T.StructField(n, whole) for n in ("n_words", "n_hit", "n_items")),
            T.StructField("items", T.ArrayType(item)),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    patterns_per_pass: int = PATTERNS_PER_PASS,
    keep: list[str] | None = None,
    result_col: str = "contamination",
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all when None) plus ``result_col``: n_words, n_hit, n_items, the sorted ``items`` with an
    occurring window and the hit word ``spans`` [first, past], merged.

    Null or empty text has no words and no hits; very long texts are searched whole; repeated rows get equal results, and
    items of one id in several rows are one item. Null item ids and items without words give no window. An empty
    benchmark gives zero hits, an empty table no rows. A column called ``result_col`` in ``docs`` is replaced; other
    columns may have any name, and item ids any type that can be compared.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != result_col]
    windows = stage(_benchmark_windows(benchmark, item_col, item_text_col, window_words), "windows")
    total = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("window")), F.lit(0)).alias("bytes")).first()
    passes = max(1, -(-total.n // patterns_per_pass), -(-total.bytes // PASS_BYTES))
    blocks = windows.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(passes)).cast("int"))
    if passes > 1:  # a pass reads only its own files
        blocks, whole = stage(blocks.repartition("block"), "windows", by="block"), windows
        unstage(whole)
    item = windows.schema["item"].dataType
    row = row_struct(docs, keep).alias("row") if keep else F.struct(F.lit(None).cast("int").alias("none")).alias("row")
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    final = T.StructType([rows.schema["row"], T.StructField("result", _result_type(item))])
    if passes <= PASSES_AT_ONCE:
        out = _search(rows, blocks, range(passes), item, final)[0]
    else:
        out = _search_in_groups(rows, blocks, passes, item, final)
    unstage(windows, blocks)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("result").alias(result_col))


def _search(rows: DataFrame, blocks: DataFrame, numbers, item: T.DataType, final: T.StructType | None = None) -> tuple[DataFrame, list]:
    """Rows (row, text) with what the numbered blocks find in them, and the blocks sent: the summary as ``final`` has it, or hits and items so far."""
    state = rows.select("row", "text", F.lit(None).cast("binary").alias("hits"), F.lit(None).cast(T.ArrayType(item)).alias("items"))
    sent = []
    for k in numbers:
        block = blocks.where(F.col("block") == k).select("window", "item").toArrow()  # about patterns_per_pass rows
        sent.append(rows.sparkSession.sparkContext.broadcast(list(zip(block.column("window").to_pylist(), block.column("item").to_pylist()))))
        last = final is not None and k == numbers[-1]
        state = state.mapInArrow(_scan(sent[-1], last), final if last else state.schema)
    return state, sent


def _search_in_groups(rows: DataFrame, blocks: DataFrame, passes: int, item: T.DataType, final: T.StructType) -> DataFrame:
    """As :func:`_search` for many blocks: texts are written once, under numbers; each PASSES_AT_ONCE blocks leave a table of the rows they
    hit, and only these tables meet the rows again, by number and without the texts."""
    counted = T.StructType([*rows.schema, T.StructField("place", T.LongType()), T.StructField("n_words", T.LongType())])
    numbered = stage(rows.withColumn("place", F.monotonically_increasing_id()).mapInArrow(_count_words, counted), "texts")
    tables = []
    for first in range(0, passes, PASSES_AT_ONCE):
        state, sent = _search(numbered.select(F.struct("place").alias("row"), "text"), blocks, range(first, min(first + PASSES_AT_ONCE, passes)), item)
        tables.append(stage(state.where(F.octet_length("hits") > 0).select("row.place", "hits", "items"), "hits"))
        for old in sent:
            old.destroy()
    every = reduce(DataFrame.unionByName, tables)
    # a row is at most once in each table; the merged table's size decides whether it is broadcast
    merged = stage(every.groupBy("place").agg(F.collect_list("hits").alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "hits")
    unstage(*tables)
    return numbered.select("row", "n_words", "place").join(merged, "place", "left").select("row", "n_words", "hits", "items").mapInArrow(_summaries, final)


def _count_words(batches):
    for batch in batches:
        counts = [len(words_of(data[a:b].tobytes())) for _, _, offsets, data in text_runs(batch.column("text")) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], [*batch.schema.names, "n_words"])


def _summaries(batches):
    for batch in batches:
        found = zip(*(batch.column(c).to_pylist() for c in ("n_words", "hits", "items")))
        out = [_summary(n, b"".join(hits or []), sorted(items or [])) for n, hits, items in found]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _summary_type(batch.schema.field("items").type))], ["row", "result"])


def _summary_type(items: pa.DataType) -> pa.DataType:
    return pa.struct([*((n, pa.int64()) for n in ("n_words", "n_hit", "n_items")), ("items", items), ("spans", pa.list_(pa.list_(pa.int32())))])


def _scan(shared, last: bool):
    def scan(batches):
        matcher = Matcher(shared.value) if shared.value else None
        for batch in batches:
            hits_in, items_in = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            hits_out, items_out, out = [], [], []
            for row, past, offsets, data in text_runs(batch.column("text")):
                raw, bounds = data.tobytes(), offsets.tolist()
                words = [raw[a:b].translate(_FOLD).split() for a, b in zip(bounds, bounds[1:])]
                found = _find_all(matcher, words) if matcher else {}
                for k, w in enumerate(words):
                    spans, items = hits_in[row + k] or b"", items_in[row + k] or []
                    if k in found:
                        spans += found[k][0]
                        items = sorted({*items, *found[k][1]})
                    if last:
                        out.append(_summary(len(w), spans, items))
                    else:
                        hits_out.append(spans)
                        items_out.append(items)
            kind = batch.schema.field("items").type
            if last:
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _summary_type(kind))], ["row", "result"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(hits_out, pa.binary()), pa.array(items_out, kind)], ["row", "text", "hits", "items"])

    return scan


def _find_all(matcher: Matcher, texts: list[list[bytes]]) -> dict[int, tuple[bytes, set]]:
    """For each text (by number) with occurrences: word spans as packed pairs, and items. All texts are searched as one."""
    joined = b"\0".join(b" " + b" ".join(w) + b" " if w else b"" for w in texts)
    found = list(matcher.find(joined))
    if not found:
        return {}
    data = np.frombuffer(joined, np.uint8)
    space, start = np.flatnonzero(data == 32), np.concatenate([[0], np.flatnonzero(data == 0) + 1])
    at = np.array([f[0] for f in found])
    text = np.searchsorted(start, at, side="right") - 1
    first = np.searchsorted(space, at) - np.searchsorted(space, start[text])
    pairs = np.stack([first, first + np.array([f[1] for f in found])], 1).astype("<i4")
    order = np.argsort(text, kind="stable")
    head = group_starts(text[order])
    out = {}
    for a, b in zip(head, np.append(head[1:], len(order))):
        rows = order[a:b]
        out[int(text[rows[0]])] = pairs[rows].tobytes(), {i for r in rows.tolist() for i in found[r][2]}
    return out


def _summary(n_words: int, spans: bytes, items: list[int]) -> dict:
    merged: list[list[int]] = []
    for first, past in sorted(map(tuple, np.frombuffer(spans, "<i4").reshape(-1, 2).tolist())):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], past)
        else:
            merged.append([first, past])
    return {"n_words": n_words, "n_hit": sum(b - a for a, b in merged), "n_items": len(items), "items": items, "spans": merged}


def item_digest(items):
    """sha256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ","), 256)


def contaminated(c):
    """The rule of the report: some hit, and hits at least a twentieth of the words."""
    return (c["n_hit"] > 0) & (20 * c["n_hit"] >= c["n_words"])


def sha_of(items: list[int]) -> str:
    """Plain form of :func:`item_digest`, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()

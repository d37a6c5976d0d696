"""Removal of repeated substrings over a sparse suffix array, sorted deep-shallow.

A byte goes when a string of ``length`` bytes that covers it also starts in a document with a smaller id. Strings are
the windows of ``length`` bytes of all documents. Each window has one anchor, its least ``gram``-byte hash; equal
windows have equal anchors, and only windows whose anchor occurs in two documents can repeat. So

1. batches of documents send the distinct hashes of their anchors to hash buckets, which answer with those that occur
   elsewhere too;
2. batches send the text around those anchors once for each distinct context, and buckets sort the suffixes that start
   in it: multikey quicksort over 8-byte symbols to a shallow depth, then blind tries for groups that still share their
   prefix. Suffixes that agree over ``length`` bytes are one string, and its smallest document goes back to the batches;
3. batches mark the bytes of each document.

A batch is a hash partition of the documents; what is sent is one message for each batch and bucket. A string
that many documents hold is one entry of each batch. Anchors that occur very often are sent window by window, so that
no bucket gathers all texts around them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, batch_count, byte_view, column, deltas, group_starts, message_rows, pack, row_struct, take_spans, text_runs, unpack

LENGTH = 50
#: Input of a batch where texts are rewritten, which holds other columns and the remaining texts beside the given ones.
REMOVE_MB = 5
GRAM = 20
#: Anchors that occur this often are sent window by window.
HOT = 4096
#: 8-byte symbols compared by multikey quicksort before blind tries take over.
SHALLOW = 4
#: Contexts whose suffixes are sorted together.
SORT_CONTEXTS = 20_000

_POSITION_BITS = np.uint64(28)
#: Bytes of a text whose windows are anchored together.
SLICE = 1 << 27
_HASH_40 = np.uint64((1 << 40) - 1)


class Runs:
    """Maximal runs of consecutive windows with the same anchor, over texts that lie one after the other."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, length: int, gram: int):
        self.rolling = RollingHash(data)
        sizes = np.diff(offsets)
        inside = np.zeros(len(data) + 1, np.int32)
        long = sizes >= length
        np.add.at(inside, offsets[:-1][long], 1)
        np.add.at(inside, offsets[1:][long] - length + 1, -1)
        inside = np.cumsum(inside)[: len(data)] > 0
        # positions have 28 bits: longer texts are taken in slices, and a run ends where a slice does
        parts = [self._slice(at, min(SLICE, len(data) - at), inside, length, gram) for at in range(0, len(data), SLICE)] if long.any() else []
        empty = np.zeros(0, np.int64)
        self.start, self.windows, self.anchor = (np.concatenate(x) for x in zip(*parts)) if parts else (empty, empty, np.zeros(0, np.uint64))

    def _slice(self, at: int, size: int, inside: np.ndarray, length: int, gram: int):
        """(start, windows, anchor) of the runs of windows that start in [at, at + size)."""
        hashes = self.rolling.fixed(gram, at, size + length - gram)
        if len(hashes) <= length - gram:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        least = (hashes >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(hashes), dtype=np.uint64)
        span, reach = length - gram + 1, 1
        while reach * 2 <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            rest = span - reach
            least = np.minimum(least[:-rest], least[rest:])
        valid = np.flatnonzero(inside[at : at + min(size, len(least))])
        chosen = least[valid]
        cut = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (np.diff(valid) != 1)])) if len(valid) else np.zeros(0, np.int64)
        anchor = hashes[(chosen[cut] & np.uint64((1 << 28) - 1)).astype(np.int64)]
        return at + valid[cut], np.diff(np.append(cut, len(valid))), anchor


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _split(keys: np.ndarray):
    """(key, rows) of each distinct key."""
    order = np.argsort(keys, kind="stable")
    at = group_starts(keys[order])
    for a, b in zip(at, np.append(at[1:], len(order))):
        yield int(keys[order[a]]), order[a:b]


def _batch(id_col: str, text_col: str, batches: int):
    """Batch of a row: rows with one id, or none, are spread by their texts."""
    return F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")), F.lit(batches)).cast("int")


def _chunks(table: pa.Table, length: int, gram: int):
    """(rows, documents' bounds, bytes, runs) of each part of a batch, in the order of its rows; nothing depends on what that is."""
    text = column(table, "text")
    for row, past, offsets, data in text_runs(text):
        yield row, past, offsets, data, Runs(offsets, data, length, gram)


def anchor_messages(table: pa.Table, pid: int, buckets: int, length: int, gram: int) -> pa.Table:
    """Distinct anchor hashes of a batch and how many documents' runs have them (255: more), by bucket."""
    found = [np.zeros(0, np.uint64)]
    ids = column(table, "doc_id")
    known = np.asarray(ids.is_valid())
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for row, past, offsets, _, runs in _chunks(table, length, gram):
        doc = row + np.searchsorted(offsets, runs.start, side="right") - 1
        keep = known[doc]
        # one entry for each document and anchor
        pair = np.stack([values[doc[keep]].view(np.uint64), runs.anchor[keep]])
        order = np.lexsort(pair)
        pair = pair[:, order]
        if pair.shape[1]:
            first = np.concatenate([[True], (pair[:, 1:] != pair[:, :-1]).any(0)])
            found.append(pair[1, first])
    anchors, counts = np.unique(np.concatenate(found), return_counts=True)
    return message_rows(
        [
            (bucket, pid, pack(deltas(np.sort(anchors[rows] & _HASH_40)), np.minimum(counts[rows[np.argsort(anchors[rows] & _HASH_40, kind="stable")]], 255).astype(np.uint8)))
            for bucket, rows in _split(_bucket(anchors, buckets))
        ]
    )


def shared_anchors(table: pa.Table) -> pa.Table:
    """Answers of a bucket: which of each batch's anchors are also in another document, and which of those are hot."""
    bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
    pids = table.column("pid").to_pylist()
    parts = [unpack(m) for m in table.column("message").to_pylist()]
    hashes = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
    all_hashes = np.concatenate(hashes)
    counts = np.concatenate([p[1] for p in parts]).astype(np.int64)
    distinct, inverse = np.unique(all_hashes, return_inverse=True)
    total = np.bincount(inverse, counts, len(distinct))
    rows, at = [], 0
    for pid, own in zip(pids, hashes):
        n = total[inverse[at : at + len(own)]]
        at += len(own)
        keep = n >= 2
        if keep.any():
            rows.append((bucket, pid, pack(deltas(own[keep]), (n[keep] >= HOT).astype(np.uint8))))
    return message_rows(rows)


def _candidates(answers: pa.Table, buckets: int):
    """Sorted keys (bucket and 40 bits) of a batch's shared anchors, and whether each is hot."""
    keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for bucket, message in zip(answers.column("bucket").to_pylist(), answers.column("message").to_pylist()):
        h, flags = unpack(message)
        keys.append(np.cumsum(h, dtype=np.uint64) | np.uint64(bucket << 40))
        hot.append(flags)
    keys, hot = np.concatenate(keys), np.concatenate(hot)
    order = np.argsort(keys)
    return keys[order], hot[order].astype(bool)


def _contexts(runs: Runs, keys: np.ndarray, hot: np.ndarray, buckets: int, length: int):
    """(start, windows, group, hash) of the contexts to compare: runs of shared anchors, window by window (0) where hot."""
    own = np.uint64(1 << 40) * _bucket(runs.anchor, buckets).astype(np.uint64) + (runs.anchor & _HASH_40)
    at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
    shared = (keys[at] == own) if len(keys) else np.zeros(len(own), bool)
    dense = shared & hot[at] if len(keys) else shared
    plain = shared & ~dense
    start, windows, group = runs.start[plain], runs.windows[plain], runs.anchor[plain]
    n = runs.windows[dense]
    each = np.repeat(runs.start[dense] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    start = np.concatenate([start, each])
    windows = np.concatenate([windows, np.ones(len(each), np.int64)])
    hashes = runs.rolling.spans(start, start + windows + length - 1)
    windows[len(group) :] = 0  # marks the single window of a hot anchor
    return start, windows, np.concatenate([group, hashes[len(group) :]]), hashes


def context_messages(docs: pa.Table, answers: pa.Table, pid: int, buckets: int, length: int, gram: int) -> pa.Table:
    """Distinct contexts of a batch with their smallest document, by bucket."""
    keys, hot = _candidates(answers, buckets)
    ids = column(docs, "doc_id")
    known = np.asarray(ids.is_valid())
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    parts = []
    for row, _, offsets, data, runs in _chunks(docs, length, gram):
        start, windows, group, hashes = _contexts(runs, keys, hot, buckets, length)
        doc = row + np.searchsorted(offsets, start, side="right") - 1
        keep = known[doc]
        start, windows, group, hashes, least = start[keep], windows[keep], group[keep], hashes[keep], values[doc[keep]]
        order = np.lexsort((least, hashes))
        order = order[group_starts(hashes[order])]
        size = np.maximum(windows[order], 1) + length - 1
        parts.append((hashes[order], group[order], windows[order].astype(np.uint8), least[order], size, take_spans(data, start[order], size)))
    if not parts:
        return message_rows([])
    hashes, group, windows, least, size, data = (np.concatenate(x) for x in zip(*parts))
    begin = np.cumsum(size) - size
    order = np.lexsort((least, hashes))
    order = order[group_starts(hashes[order])]
    hashes, group, windows, least, size, begin = (x[order] for x in (hashes, group, windows, least, size, begin))
    return message_rows(
        [
            (bucket, pid, pack(hashes[rows], group[rows], windows[rows], least[rows], take_spans(data, begin[rows], size[rows])))
            for bucket, rows in _split((group % np.uint64(buckets)).astype(np.int64))
        ]
    )


def _symbols(data: np.ndarray, position: np.ndarray, depth: int) -> np.ndarray:
    """8 bytes from ``depth`` symbols past each position on, as integers that compare like the bytes."""
    view = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    return view[position + 8 * depth].byteswap()


def _resegment(segment: np.ndarray, label: np.ndarray, width: int):
    """Stable order that splits each segment by label, and the new segments' numbers."""
    key = segment * width + label
    order = np.argsort(key, kind="stable")
    key = key[order]
    return order, np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))


def _drop_single(item: np.ndarray, segment: np.ndarray):
    size = np.bincount(segment)
    keep = size[segment] > 1
    return item[keep], segment[keep], keep


def deep_shallow_classes(data: np.ndarray, position: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Class number of each suffix; suffixes of one group that agree over ``length`` bytes share a class.

    All segments advance together: each round of multikey quicksort takes a pivot symbol in every open segment and splits
    it in three, the middle part moving one symbol deeper. Segments that reach the shallow depth go to blind tries, which
    find the first byte where a segment's suffixes differ, branch on it, and look at no byte before it again. ``data``
    must reach 16 bytes past the last suffix."""
    classes = np.arange(len(position))
    order = np.argsort(group, kind="stable")
    item, segment = order, np.cumsum(np.concatenate([[False], group[order][1:] != group[order][:-1]])) if len(order) else order
    item, segment, _ = _drop_single(item, segment)
    depth = np.zeros(len(item), np.int64)
    shallow = min(SHALLOW, length // 8)
    deep_item, deep_segment, past = [], [], 0
    while len(item):
        symbol = _symbols(data, position[item] + 8 * depth, 0)
        first = group_starts(segment)
        size = np.diff(np.append(first, len(segment)))
        pivot = np.repeat(symbol[first + size // 2], size)
        label = np.where(symbol < pivot, 0, np.where(symbol == pivot, 1, 2))
        order, parts = _resegment(segment, label, 3)
        depth = depth[order] + (label[order] == 1)
        item, segment, keep = _drop_single(item[order], parts)
        depth = depth[keep]
        done = depth >= shallow
        if done.any():
            deep_item.append(item[done])
            deep_segment.append(segment[done] + past)
            past += int(segment.max()) + 1
            item, segment, depth = item[~done], segment[~done], depth[~done]
    if not deep_item:
        return classes
    item = np.concatenate(deep_item)
    segment = np.unique(np.concatenate(deep_segment), return_inverse=True)[1]
    words = [(d, 8) for d in range(shallow, length // 8)] + ([(length // 8, length % 8)] if length % 8 else [])
    while len(item):
        order = np.argsort(segment, kind="stable")
        item, segment = item[order], segment[order]
        first = group_starts(segment)
        size = np.diff(np.append(first, len(segment)))
        where = np.full(len(item), length)
        for d, width in reversed(words):
            symbol = _symbols(data, position[item], d)
            if width < 8:
                symbol = symbol >> np.uint64(64 - 8 * width) << np.uint64(64 - 8 * width)
            differs = symbol ^ np.repeat(symbol[first], size)
            lead = np.zeros(len(item), np.int64)
            rest = differs.copy()
            for step in (32, 16, 8):  # leading zero bytes
                low = rest < (np.uint64(1) << np.uint64(64 - step))
                lead[low] += step // 8
                rest[low] <<= np.uint64(step)
            where = np.where(differs != 0, 8 * d + lead, where)
        branch = np.repeat(np.minimum.reduceat(where, first), size)
        equal = branch >= length
        if equal.any():  # leaves: all suffixes of the segment are one string
            head = group_starts(segment[equal])
            classes[item[equal]] = np.repeat(item[equal][head], np.diff(np.append(head, int(equal.sum()))))
        item, segment, branch = item[~equal], segment[~equal], branch[~equal]
        if len(item):
            order, segment = _resegment(segment, data[position[item] + branch].astype(np.int64), 256)
            item, segment, _ = _drop_single(item[order], segment)
    return classes


def least_documents(table: pa.Table, length: int) -> pa.Table:
    """Answers of a bucket: for each batch's contexts, the smallest document of each window where that is smaller."""
    bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
    pids = table.column("pid").to_pylist()
    parts = [unpack(m) for m in table.column("message").to_pylist()]
    hashes, group, windows, least, data = (np.concatenate(x) for x in zip(*parts))
    sent, windows = windows, np.maximum(windows, 1).astype(np.int64)
    size = windows + length - 1
    begin = np.cumsum(size) - size
    sender = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    # distinct contexts and their smallest documents
    order = np.lexsort((least, hashes))
    head = order[group_starts(hashes[order])]
    which = np.empty(len(hashes), np.int64)
    which[order] = np.cumsum(np.concatenate([[0], hashes[order][1:] != hashes[order][:-1]]))
    by_group = np.argsort(group[head], kind="stable")
    best: list[np.ndarray] = [np.zeros(0, np.int64)] * len(head)
    bounds = np.append(group_starts(group[head][by_group]), len(head))
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + SORT_CONTEXTS, side="right")) - 1)
        chosen = by_group[bounds[a] : bounds[b]]
        rows, n = head[chosen], windows[head[chosen]]
        before = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(rows)), n)
        length_of = size[rows]
        text = np.concatenate([take_spans(data, begin[rows], length_of), np.zeros(16, np.uint8)])
        position = (np.cumsum(length_of) - length_of - before)[owner] + np.arange(int(n.sum()))
        classes = deep_shallow_classes(text, position, group[rows][owner], length)
        smallest = least[rows][owner].copy()
        np.minimum.at(smallest, classes, least[rows][owner])
        value = smallest[classes]
        for k, x in zip(chosen.tolist(), np.split(value, before[1:])):
            best[k] = x
        a = b
    rows = []
    for k, pid in enumerate(pids):
        mine = np.flatnonzero(sender == k)
        value = [best[w] for w in which[mine].tolist()]
        rows.append((bucket, pid, pack(hashes[mine], sent[mine], np.concatenate(value))))
    return message_rows(rows)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def mark(docs: pa.Table, answers: pa.Table, length: int, gram: int, with_text: bool) -> pa.Table:
    """Removed bytes of each document of a batch."""
    parts = [unpack(m) for m in answers.column("message").to_pylist()] or [[np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)]]
    hashes, windows, value = (np.concatenate(x) for x in zip(*parts))
    n = np.maximum(windows, 1).astype(np.int64)
    begin = np.cumsum(n) - n
    order = np.argsort(hashes, kind="stable")
    hashes, windows, begin = hashes[order], windows[order], begin[order]
    any_hot = bool((windows == 0).any())
    ids = column(docs, "doc_id")
    known = np.asarray(ids.is_valid())
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out: list[list] = [[] for _ in RESULT]
    for row, past, offsets, data, runs in _chunks(docs, length, gram):
        change = np.zeros(len(data) + 1, np.int64)
        if len(hashes):
            # contexts as they were sent: whole runs, or single windows of hot anchors
            start, n = runs.start, runs.windows
            whole = runs.rolling.spans(start, start + n + length - 1)
            at = np.minimum(np.searchsorted(hashes, whole), len(hashes) - 1)
            hit = (hashes[at] == whole) & (windows[at] > 0)
            n = n[hit]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            each, source = np.repeat(start[hit], n) + step, np.repeat(begin[at[hit]], n) + step
            if any_hot:
                n = runs.windows[~hit]
                single = np.repeat(start[~hit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                alone = runs.rolling.spans(single, single + length)
                at = np.minimum(np.searchsorted(hashes, alone), len(hashes) - 1)
                hit = (hashes[at] == alone) & (windows[at] == 0)
                each, source = np.concatenate([each, single[hit]]), np.concatenate([source, begin[at[hit]]])
            doc = row + np.searchsorted(offsets, each, side="right") - 1
            gone = each[known[doc] & (value[source] < values[doc])]
            if len(gone):
                change = np.bincount(gone, minlength=len(change)) - np.bincount(gone + length, minlength=len(change))
        removed = np.cumsum(change[:-1]) > 0
        for k in range(past - row):
            a, b = offsets[k], offsets[k + 1]
            lost = removed[a:b]
            kept = data[a:b][~lost].tobytes()
            n = int(lost.sum())
            spans = int(lost[0]) + int(np.count_nonzero(lost[1:] & ~lost[:-1])) if n else 0
            row_out = (ids[row + k].as_py(), int(b - a), n, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)
            for values_out, x in zip(out, row_out):
                values_out.append(x)
    return pa.table([pa.array(c, f.type) for c, f in zip(out, RESULT)], schema=RESULT)


def _answers(rows: DataFrame, batches: int, length: int, gram: int) -> DataFrame:
    """What the buckets answer to the batches of ``rows`` (doc_id, text, pid, any others)."""
    buckets = max(8, batches // 2)
    spec = "bucket int, pid int, message binary"

    def send_anchors(key, table):
        return anchor_messages(table, key[0].as_py(), buckets, length, gram)

    def send_contexts(key, left, right):
        return context_messages(left, right, key[0].as_py(), buckets, length, gram)

    anchors = rows.groupBy("pid").applyInArrow(send_anchors, spec)
    shared = anchors.groupBy("bucket").applyInArrow(lambda t: shared_anchors(t), spec)
    contexts = rows.groupBy("pid").cogroup(shared.groupBy("pid")).applyInArrow(send_contexts, spec)
    return contexts.groupBy("bucket").applyInArrow(lambda t: least_documents(t, length), spec)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Null text counts as empty; texts shorter than ``length`` bytes lose nothing. Documents with the same id, such as
    repeated rows, do not remove each other's bytes. A null id is neither smaller nor larger than any: such rows lose
    nothing and remove nothing. Very long texts are judged whole. An empty table gives no rows. Only the two named columns are read.
    """
    batches = batch_count(docs, text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), _batch(id_col, text_col, batches).alias("pid"))
    return rows.groupBy("pid").cogroup(_answers(rows, batches, length, gram).groupBy("pid")).applyInArrow(
        lambda left, right: mark(left, right, length, gram, False).drop_columns(["kept"]), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def with_repeats_removed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the remaining text in ``text_col``; rows that lose all their text go, null and empty texts stay.

    A character of which only some bytes remain becomes U+FFFD. Other columns are passed on as they are, whatever their
    names; null ids, repeated rows, long texts and empty tables are as in :func:`remove_repeats`."""
    batches = batch_count(docs, text_col, REMOVE_MB)
    others = [c for c in docs.columns if c != text_col]
    kept = row_struct(docs, others) if others else F.struct(F.lit(0).alias("none"))
    rows = docs.select(kept.alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), _batch(id_col, text_col, batches).alias("pid"))

    def apply(left, right):
        done = mark(left, right, length, gram, True)
        texts = pa.array([None if old else new.decode(errors="replace") for old, new in zip(column(left, "text").is_null().to_pylist(), done.column("kept").to_pylist())], pa.string())
        lost = pc.and_(pc.greater(done.column("n_bytes"), 0), pc.equal(done.column("n_bytes"), done.column("n_removed")))
        fields = dict(zip(others, column(left, "row").flatten())) | {text_col: texts}
        return pa.table([fields[c] for c in docs_schema.names], names=docs_schema.names).filter(pc.invert(lost))

    docs_schema = docs.schema
    return rows.groupBy("pid").cogroup(_answers(rows.select("doc_id", "text", "pid"), batches, length, gram).groupBy("pid")).applyInArrow(apply, docs_schema)

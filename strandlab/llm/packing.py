"""Packing of tokenised documents into fixed windows by the sum-of-squares rule.

Every partition packs its own documents online: a document's whole windows stand alone, its rest goes to the open fill
level that keeps the sum of squared counts of partially filled windows smallest. State is one level array of
``seq_len`` counters plus the pieces of open windows. When the partition ends, what is left open is cut anew into full
windows and the last rest into windows of powers of two, which need no padding; so padding is near nothing however
many partitions there are, and no shuffle is needed.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQ_LEN = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Splitting pattern of byte-level BPE vocabularies of this family (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks by bytes of a byte-level BPE vocabulary file, whose letters stand for bytes, the printable ones for themselves; and
    its added tokens, which are found in texts as they are."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    return {bytes(letters[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in added}, added


#: White space of the splitting pattern (Unicode's property of that name, fixed values).
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Runs of white space from this many characters on are cut out before the pattern sees them, as it steps back through them.
LONG_BLANK = 10_000


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, the same as the file's own library gives without the special
    tokens that frame a text; added tokens within a text are their one id.

    In a byte-level BPE vocabulary ids are in the order of its merges, so its ranks alone give the same ids. The pattern takes a run
    of white space as one part but for its last character, or with it where a text or an added token follows; so long runs are merged
    on their own, and what stands around them is encoded as if they were not there."""

    def __init__(self, path: str):
        import tiktoken

        ranks, added = byte_ranks(path)
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.added = tuple(added)
        self.blanks = re.compile(f"[{_BLANK}]{{{LONG_BLANK},}}")

    def _plain(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(text) < LONG_BLANK:
            return self._plain(text)
        out, at = [], 0
        for run in self.blanks.finditer(text):
            start, past = run.span()
            whole = past == len(text) or text.startswith(self.added, past)
            out.append(self._plain(text[at:start]))
            at = past if whole else past - 1
            out.append(np.array(self.encoding._encode_single_piece(text[start:at]), "<u4").tobytes())
        return b"".join([*out, self._plain(text[at:])])


class SumOfSquares:
    """Online placement into windows of ``size``: counts of open windows by fill level, and which windows they are."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        self.next = 0

    def place(self, length: int) -> tuple[int, int]:
        """(window, fill before) for an item of ``length`` < size."""
        n, b = self.count, self.size
        # change of the sum of squares when a window goes from level h to h + length, for each open level h
        levels = np.flatnonzero(n[1 : b - length + 1]) + 1
        new = 2 * n[length] + 1
        best, level = new, 0
        if len(levels):
            to = levels + length
            change = np.where(to < b, 2 * n[to] + 1, 0) - 2 * n[levels] + 1
            k = int(np.argmin(change))
            if change[k] <= best:
                best, level = change[k], int(levels[k])
        if level:
            window = self.open[level].pop()
            n[level] -= 1
        else:
            window, self.next = self.next, self.next + 1
        if level + length < b:
            n[level + length] += 1
            self.open.setdefault(level + length, []).append(window)
        return window, level


def pack_stream(docs, size: int = SEQ_LEN):
    """Yield (row, start, ids, doc_tokens, window, offset) pieces of (row, ids bytes) documents."""
    rule, held = SumOfSquares(size), {}
    whole = 1 << 39
    for row, ids in docs:
        n = len(ids) // 4
        full = n - n % size
        for start in range(0, full, size):
            yield row, start, ids[4 * start : 4 * (start + size)], n, whole, 0
            whole += 1
        if n > full:
            window, level = rule.place(n - full)
            held.setdefault(window, []).append((row, full, ids[4 * full :], n, level))
            if level + n - full == size:
                for r, s, x, total, at in held.pop(window):
                    yield r, s, x, total, window, at
    # what is open is cut anew: full windows, then powers of two
    rest = [piece for window in sorted(held) for piece in held[window]]
    left = sum(len(p[2]) // 4 for p in rest)
    window, at = rule.next, 0
    room = size if left >= size else 1 << (left.bit_length() - 1) if left else 0
    for row, start, ids, total, _ in rest:
        while ids:
            take = min(len(ids) // 4, room - at)
            yield row, start, ids[: 4 * take], total, window, at
            ids, start, at, left = ids[4 * take :], start + take, at + take, left - take
            if at == room:
                window, at = window + 1, 0
                room = size if left >= size else 1 << (left.bit_length() - 1) if left else 0


def pack_documents(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row for each piece: where it lies in its document and in its sequence; ``with_ids`` adds the ids themselves.

    Null and empty texts are one token, the end id. Null and repeated doc_ids are packed like others, row by row.
    Very long texts, and runs of white space of any length, are encoded whole and cut into pieces like others. An empty table gives no rows. Only ``id_col`` and ``text_col`` are read, so other columns cannot clash.
    ``sequence_id`` is unique over the table: the partition's number, then the window's in that partition.
    """

    def pack(batches):
        encoder = Encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()

        def tokens():
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        yield doc, (encoder.encode(text) if text else b"") + end

        out: list[tuple] = []
        for doc, start, ids, total, window, at in pack_stream(tokens(), seq_len):
            out.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, base + window, at, ids))
            if len(out) >= 4096:
                yield _batch(out, with_ids)
                out = []
        yield _batch(out, with_ids)

    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(pack, schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * 8
    arrays = [pa.array(cols[i], pa.int64()) for i in range(7)]
    if with_ids:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(cols[7], pa.binary())], [*names, "ids"])
    return pa.RecordBatch.from_arrays(arrays, names)

"""Fill-in-the-middle transformation with piece tables.

A document is a short list of descriptors (buffer, start, length) over two immutable buffers: the bytes of its Arrow batch and the
sentinels. Cutting at two token ends splits the one descriptor of the text in three; a form is a permutation of these and of the three
sentinels; the inverse permutation, without the sentinels, is the text again. Digests stream over descriptors, so a rearranged
text is only put together for the output column.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_struct, text_runs
from .shingles import word_bounds

#: Sentinels of prefix, suffix and middle, one after the other (fixed values of the contract).
SENTINELS = b"<P><S><M>"
TEXT, MARKS = 0, 1
#: Descriptors of a cut document: prefix, middle, suffix, then the three sentinels in the order of their buffer.
PREFIX, MIDDLE, SUFFIX, P, S, M = range(6)
#: Arrangement of the descriptors in each form (fixed values of the contract).
FORMS = {"psm": (P, PREFIX, S, SUFFIX, M, MIDDLE), "spm": (S, SUFFIX, P, PREFIX, M, MIDDLE)}
RESULT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, text: string, sha256: string>"


class PieceTable:
    """Descriptors of one document over immutable buffers."""

    def __init__(self, buffers, pieces):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, at: int) -> "PieceTable":
        """Split the piece that holds the byte at ``at``, or that ends there; a cut at an end leaves an empty piece."""
        out, before = [], 0
        for k, (buffer, start, length) in enumerate(self.pieces):
            if at <= before + length:
                head = at - before
                return PieceTable(self.buffers, [*out, (buffer, start, head), (buffer, start + head, length - head), *self.pieces[k + 1 :]])
            out.append((buffer, start, length))
            before += length
        raise IndexError("cut past the end")

    def arranged(self, order) -> "PieceTable":
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def restored(self, order) -> "PieceTable":
        """Undo :meth:`arranged`, and drop what lies in the buffer of the sentinels."""
        back = np.argsort(order).tolist()
        return PieceTable(self.buffers, [p for p in (self.pieces[i] for i in back) if p[0] == TEXT])

    def spans(self):
        return (self.buffers[b][s : s + n] for b, s, n in self.pieces if n)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for span in self.spans():
            digest.update(span)
        return digest.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.spans())


_MARK_PIECES = [(MARKS, 3 * k, 3) for k in range(3)]


def _draws(seed: int, ids: list) -> np.ndarray:
    """h1 to h4 of each id: the first four big-endian words of sha256 of ``seed:id``; a null id counts as empty text."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def _sentinel_texts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether each text holds a sentinel."""
    out = np.zeros(len(offsets) - 1, bool)
    if len(data) >= 3:
        at = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")) & np.isin(data[1:-1], np.frombuffer(b"PSM", np.uint8)))
        row = np.searchsorted(offsets, at, side="right") - 1
        out[row[at + 3 <= offsets[row + 1]]] = True
    return out


def transformed(ids: list, array: pa.Array, *, seed: int, fim_percent: int, spm_percent: int):
    """(n, form, prefix_chars, middle_chars, piece table of the output) of each text."""
    for row, past, offsets, data in text_runs(array):
        start, end, text = word_bounds(offsets, data)
        words = np.bincount(text, minlength=past - row)
        size = np.diff(offsets)
        # white space after the last word is a token of its own
        last = np.where(words > 0, end[np.maximum(np.cumsum(words) - 1, 0)] if len(end) else 0, offsets[:-1])
        n = words + (last < offsets[1:])
        h = _draws(seed, ids[row:past])
        cut = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
        first = np.cumsum(words) - words
        edge = np.where(cut == 0, offsets[:-1, None], np.where(cut > words[:, None], offsets[1:, None], 0))
        inner = (cut > 0) & (cut <= words[:, None])
        edge[inner] = end[(first[:, None] + cut - 1)[inner]]
        plain = (size == 0) | _sentinel_texts(offsets, data) | (h[:, 2] % 100 >= fim_percent)
        spm = h[:, 3] % 100 < spm_percent
        # code points before each byte
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        buffers = (memoryview(np.ascontiguousarray(data)), memoryview(SENTINELS))
        chars = np.stack([points[edge[:, 0]] - points[offsets[:-1]], points[edge[:, 1]] - points[edge[:, 0]]], 1).tolist()
        edge, begin = edge.tolist(), offsets.tolist()
        for k in range(past - row):
            table = PieceTable(buffers, [(TEXT, begin[k], begin[k + 1] - begin[k])])
            if plain[k]:
                yield int(n[k]), "plain", None, None, table
                continue
            form = "spm" if spm[k] else "psm"
            table = table.cut(edge[k][0] - begin[k]).cut(edge[k][1] - begin[k])
            yield int(n[k]), form, *chars[k], PieceTable(buffers, table.pieces + _MARK_PIECES).arranged(FORMS[form])


def fill_in_middle(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", result_col: str = "fim", keep: list[str] | None = None, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80
) -> DataFrame:
    """``keep`` columns of ``docs`` (all when None) and ``result_col``: n tokens, form (plain, psm, spm), prefix_chars and middle_chars
    in code points (null if plain), the transformed text and its sha256.

    The draw depends on ``seed`` and the id alone: repeated rows are cut alike, a null id draws as an empty one. Null texts count as
    empty; empty texts, and those that hold a sentinel, stay plain. Very long texts are cut like others. An empty table gives no rows.
    Other columns may have any name; a column of the result's name is replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != result_col]

    def run(batches):
        for batch in batches:
            found = list(zip(*transformed(batch.column(1).to_pylist(), batch.column(2), seed=seed, fim_percent=fim_percent, spm_percent=spm_percent)))
            if not found:
                continue
            n, form, prefix, middle, tables = found
            parts = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            parts += [pa.array([t.bytes() for t in tables], pa.binary()).cast(pa.string()), pa.array([t.sha256() for t in tables])]
            yield pa.record_batch([batch.column(0), pa.StructArray.from_arrays(parts, ["n", "form", "prefix_chars", "middle_chars", "text", "sha256"])], names=["row", "found"])

    rows = docs.select(row_struct(docs, keep).alias("row") if keep else F.struct(F.lit(0)).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"found {RESULT}")]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("found").alias(result_col))


def arrangement_of(output: bytes, form: str) -> PieceTable:
    """An output text as the arranged piece table of its form: six descriptors, found at the sentinels."""
    buffers = (memoryview(output), memoryview(SENTINELS))
    if form == "plain":
        return PieceTable(buffers, [(TEXT, 0, len(output))])
    pieces, at = [], 0
    marks = [k for k in FORMS[form] if k >= P]
    for k, mark in enumerate(marks):
        sentinel = SENTINELS[3 * (mark - P) : 3 * (mark - P) + 3]
        if output[at : at + 3] != sentinel:
            raise ValueError(f"not of form {form}")
        at += 3
        after = SENTINELS[3 * (marks[k + 1] - P) : 3 * (marks[k + 1] - P) + 3] if k + 1 < len(marks) else None
        past = output.find(after, at) if after else len(output)
        if past < 0:
            raise ValueError(f"not of form {form}")
        pieces += [_MARK_PIECES[mark - P], (TEXT, at, past - at)]
        at = past
    return PieceTable(buffers, pieces)


def restore_texts(outputs: DataFrame, *, text_col: str, form_col: str, result_col: str = "restored") -> DataFrame:
    """Adds ``result_col``: the text before the transformation, from the output and its form alone.

    A null output or form gives null, an output that is not of its form is an error; repeated rows are restored alike."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            back = []
            for output, form in zip(texts, batch.column(2).to_pylist()):
                if output is None or form is None:
                    back.append(None)
                else:
                    table = arrangement_of(output, form)
                    back.append((table if form == "plain" else table.restored(FORMS[form])).bytes())
            yield pa.record_batch([batch.column(0), pa.array(back, pa.binary()).cast(pa.string())], names=["row", "text"])

    keep = [c for c in outputs.columns if c != result_col]
    rows = outputs.select(row_struct(outputs, keep).alias("row"), F.col(text_col).alias("text"), F.col(form_col).alias("form"))
    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("text").alias(result_col))

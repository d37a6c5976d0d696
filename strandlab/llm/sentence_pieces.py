"""SentencePiece encoding and decoding with a table of distinct chunks.

No piece of the vocabulary has a whitespace marker behind another character, so no merge crosses the place where a run of markers
begins: a text is a sequence of marked words (its markers and the word behind them), each of which is segmented alone. Each
distinct marked word is segmented once and its ids are joined back to all places where it stands.

The table has two parts. Words that make up at least one in ``2 ** TABLE_BITS`` of all marked words are counted over all texts,
segmented in one job and sent to all executors: by that rule there are never more than ``2 ** TABLE_BITS`` of them. All other
words are rows of a batch's own table, segmented once for the batch. No text is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_struct, take_spans, text_runs

#: The shared table holds at most 2 ** TABLE_BITS words, of at most TABLE_WORD bytes each.
TABLE_BITS, TABLE_WORD = 16, 48
#: The whitespace marker (fixed value of the format).
MARK = "▁"
_MARK_BYTES = MARK.encode()
RESULT = "struct<ids: array<int>, text: string>"


def check_model(path: str) -> None:
    """Raise if chunks of a model may depend on each other, or texts are rewritten before they are cut."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, kind = model.normalizer_spec, model.trainer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or kind.treat_whitespace_as_suffix:
        raise ValueError("the model changes texts before it cuts them")
    if kind.model_type != kind.BPE or any(MARK in p.piece.lstrip(MARK) for p in model.pieces) or any(p.type == p.USER_DEFINED for p in model.pieces):
        raise ValueError("pieces of the model cross whitespace markers")


def chunk_starts(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, size of its first marker in bytes) of all chunks: where a text begins, whose first marker is implied and takes no
    byte, and where a run of markers begins behind another character."""
    mark = data == 32
    wide = np.zeros(0, np.int64)
    if len(data) >= 3:
        wide = np.flatnonzero((data[:-2] == _MARK_BYTES[0]) & (data[1:-1] == _MARK_BYTES[1]) & (data[2:] == _MARK_BYTES[2]))
        for k in range(3):
            mark[wide + k] = True
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    place = np.flatnonzero(begins | first)
    return place, np.where(first[place], 0, np.where(data[place] == 32, 1, 3))


def chunk_words(offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Chunks of all texts without their first marker, as dictionary-coded binary values, and the number of each text's chunks."""
    place, marker = chunk_starts(offsets, data)
    past = np.append(place[1:], len(data))
    begin = place + marker
    length = past - begin
    edges = np.concatenate([[0], np.cumsum(length)])
    flat = data if not marker.any() else take_spans(data, begin, length)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))])
    counts = np.diff(np.searchsorted(place, offsets)) if len(place) else np.zeros(len(offsets) - 1, np.int64)
    return words.dictionary_encode(), counts


class Segmenter:
    """Ids of marked words, and the bytes that ids stand for."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.marker = [self.model.piece_to_id(MARK)]
        self.surfaces = [self._surface(i) for i in range(self.model.get_piece_size())]

    def _surface(self, i: int) -> bytes:
        if self.model.is_control(i):
            return b""
        if self.model.is_byte(i):
            return bytes([int(self.model.id_to_piece(i)[3:5], 16)])
        if self.model.is_unknown(i):
            return self.model.decode([i]).encode()
        return self.model.id_to_piece(i).replace(MARK, " ").encode()

    def segment(self, words: list[bytes]) -> list[list[int]]:
        """The library puts the first marker back; a marker alone is a text that it can't be given."""
        ids = self.model.encode([w.decode() for w in words], num_threads=1)
        return [x or self.marker for x in ids]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


class ChunkTable:
    """Ids of the marked words of one run: those of the shared table looked up, the others segmented once."""

    def __init__(self, segmenter: Segmenter, shared: dict[bytes, bytes]):
        self.segmenter, self.shared = segmenter, shared

    def rows(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, count, ids): where each word's ids stand among all."""
        keys = words.to_pylist()
        found = [self.shared.get(w) for w in keys]
        rest = [k for k, x in enumerate(found) if x is None]
        for k, ids in zip(rest, self.segmenter.segment([keys[k] for k in rest])):
            found[k] = np.array(ids, np.int32).tobytes()
        count = np.array([len(x) // 4 for x in found], np.int64)
        return np.cumsum(count) - count, count, np.frombuffer(b"".join(found), np.int32)


def encoded(table: ChunkTable, array: pa.Array):
    """Yield (first row, number of ids of each text, ids) for each run of texts."""
    for row, _, offsets, data in text_runs(array):
        words, chunks = chunk_words(offsets, data)
        start, count, ids = table.rows(words.dictionary)
        code = words.indices.to_numpy()
        sizes = np.concatenate([[0], np.cumsum(count[code])])
        at = np.cumsum(chunks)
        yield row, sizes[at] - sizes[at - chunks], take_spans(ids, start[code], count[code])


def decoded(segmenter: Segmenter, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Text of each list of ids, from the table of surfaces; lists whose bytes are no text go to the library itself."""
    surface = segmenter.surfaces
    out, at = [], 0
    for n in sizes.tolist():
        own = ids[at : at + n].tolist()
        at += n
        text = b"".join([surface[i] for i in own])
        # one marker at the start is the implied one
        lead = text[:1] == b" " and segmenter.model.id_to_piece(next(i for i in own if surface[i])).startswith(MARK)
        try:
            out.append(text[lead:].decode())
        except UnicodeDecodeError:
            out.append(segmenter.decode(own))
    return out


def _common_words(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """Marked words that make up at least one in 2 ** bits of all, so at most 2 ** bits rows."""

    def count(batches):
        for batch in batches:
            for _, _, offsets, data in text_runs(batch.column(0)):
                words, _ = chunk_words(offsets, data)
                n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                short = pc.less_equal(pc.binary_length(words.dictionary), TABLE_WORD)
                # what is left out still counts among all
                out = pa.record_batch([words.dictionary.cast(pa.binary()).filter(short), pa.array(n).filter(short)], names=["word", "n"])
                yield out
                yield pa.record_batch([pa.array([None], pa.binary()), pa.array([int(n.sum())], pa.int64())], names=["word", "n"])

    counts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    total = counts.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts, counts.where("word is not null").where(F.col("n") * (1 << bits) >= total).select("word")


def chunk_table(docs: DataFrame, model_path: str, *, text_col: str = "text", bits: int = TABLE_BITS) -> dict[bytes, bytes]:
    """Ids, as little-endian 32-bit bytes, of the marked words that are common enough in ``docs``: at most 2 ** bits words."""

    def segment(batches):
        segmenter = Segmenter(model_path)
        for batch in batches:
            ids = segmenter.segment(batch.column(0).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array([np.array(x, np.int32).tobytes() for x in ids], pa.binary())], names=["word", "ids"])

    counts, words = _common_words(docs, text_col, bits)
    try:
        found = words.mapInArrow(segment, "word binary, ids binary").toArrow()
    finally:
        counts.unpersist()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))


def encode_texts(
    docs: DataFrame, model_path: str, *, text_col: str = "text", result_col: str = "pieces", keep: list[str] | None = None, bits: int = TABLE_BITS, table: dict[bytes, bytes] | None = None
) -> DataFrame:
    """``keep`` columns of ``docs`` (all when None) and ``result_col``: the ids of the text, and the text that these decode to.

    Ids are those of the library, without begin or end ids. Null texts count as empty and have no ids; repeated rows get equal ids;
    texts and words of any length are segmented whole. An empty table gives no rows. Other columns may have any name; a column of the
    result's name is replaced. ``table`` gives a chunk table that was made before."""
    check_model(model_path)
    keep = [c for c in (docs.columns if keep is None else keep) if c != result_col]
    shared = docs.sparkSession.sparkContext.broadcast(chunk_table(docs, model_path, text_col=text_col, bits=bits) if table is None else table)

    def run(batches):
        segmenter = Segmenter(model_path)
        chunks = ChunkTable(segmenter, shared.value)
        for batch in batches:
            for row, sizes, ids in encoded(chunks, batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
                found = pa.StructArray.from_arrays([lists, pa.array(decoded(segmenter, ids, sizes), pa.string())], ["ids", "text"])
                yield pa.record_batch([batch.column(0).slice(row, len(sizes)), found], names=["row", "found"])

    rows = docs.select(row_struct(docs, keep).alias("row") if keep else F.struct(F.lit(0)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"found {RESULT}")]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("found").alias(result_col))


def decode_ids(rows: DataFrame, model_path: str, *, ids_col: str = "ids", result_col: str = "text") -> DataFrame:
    """Adds ``result_col``: the text that a column of ids stands for, as the library decodes them; null ids give an empty text."""

    def run(batches):
        segmenter = Segmenter(model_path)
        for batch in batches:
            ids = batch.column(1)
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            yield pa.record_batch([batch.column(0), pa.array(decoded(segmenter, ids.flatten().to_numpy(zero_copy_only=False), sizes), pa.string())], names=["row", "text"])

    keep = [c for c in rows.columns if c != result_col]
    given = rows.select(row_struct(rows, keep).alias("row"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    out = given.mapInArrow(run, T.StructType([given.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("text").alias(result_col))


@F.arrow_udf(T.StringType())
def ids_digest(ids: pa.Array) -> pa.Array:
    """sha256 of each list of ids, in decimal and joined by commas."""
    flat, at, out = ids.flatten().to_numpy(zero_copy_only=False), 0, []
    for n in ids.value_lengths().fill_null(0).to_pylist():
        out.append(hashlib.sha256(",".join(map(str, flat[at : at + n].tolist())).encode()).hexdigest())
        at += n
    return pa.array(out, pa.string())

"""Quality classifier: random Fourier features of document statistics, ridge scores and isotonic calibration.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a text. Each partition sums its
share of the normal equations; the sums meet in Spark and only a matrix of fixed size reaches the driver, so all
labelled rows take part. Raw scores are calibrated by isotonic regression on counts over a fixed grid of scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RollingHash, row_struct, text_runs
from .shingles import word_bounds

FOURIER = 512
#: Width of the Gaussian kernel, in standard deviations of a statistic.
WIDTH = 4.0
RIDGE = 1e-3
#: Scores from -1 to 2 in steps of 1/GRID are what isotonic regression sees.
GRID = 1000

STATISTICS = (
    "log_bytes log_words word_bytes upper digits marks stops non_ascii lines distinct_words top_word repeats_before "
    "exclaims sentence_words repeated_lines spaces long_words symbols"
).split()

_MARKS = np.zeros(256, bool)
_MARKS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,"]] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#$%&*@^~|<>{}[]\\/_=+"]] = True


def _count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)


def statistics(array: pa.Array) -> np.ndarray:
    """One row of statistics for each text; all are zero for empty and null texts."""
    out = [np.zeros((0, len(STATISTICS)))]
    for row, past, offsets, data in text_runs(array):
        n = past - row
        size = np.diff(offsets).astype(float)
        some = np.maximum(size, 1)
        start, end, text = word_bounds(offsets, data)
        words = np.bincount(text, minlength=n).astype(float)
        rolling = RollingHash(data)
        word = rolling.spans(start, end)
        least = np.maximum(words, 1)
        order = np.lexsort((word, text))
        key, owner = word[order], text[order]
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(head, len(key)))
        distinct = np.bincount(owner[head], minlength=n).astype(float)
        top = np.zeros(n)
        np.maximum.at(top, owner[head], times)
        again = np.bincount(text[1:][(word[1:] == word[:-1]) & (text[1:] == text[:-1])], minlength=n) if len(word) else np.zeros(n)
        newline = data == 10
        lines = _count(newline, offsets) + (size > 0)
        # lines as stretches between newlines and the ends of texts
        edge = np.unique(np.concatenate([offsets, np.flatnonzero(newline) + 1]))
        a, b = edge[:-1], edge[1:]
        owner_line = np.searchsorted(offsets, a, side="right") - 1
        full = b - a > 1
        a, b, owner_line = a[full], b[full], owner_line[full]
        ends_in = data[b - 1] == 10 if len(b) else np.zeros(0, bool)
        line = rolling.spans(a, b - ends_in)
        order = np.lexsort((line, owner_line))
        line, owner_line = line[order], owner_line[order]
        same = np.zeros(len(line), bool)
        same[1:] = (line[1:] == line[:-1]) & (owner_line[1:] == owner_line[:-1])
        repeated = np.bincount(owner_line[same], minlength=n)
        full_lines = np.bincount(owner_line, minlength=n)
        stops = _count((data == 46) | (data == 33) | (data == 63), offsets)
        exclaims = _count(data == 33, offsets)
        columns = [
            np.log1p(size), np.log1p(words), size / least, _count((data >= 65) & (data <= 90), offsets) / some,
            _count((data >= 48) & (data <= 57), offsets) / some, _count(_MARKS[data], offsets) / least,
            _count((data == 46) | (data == 44), offsets) / least, _count(data >= 128, offsets) / some, lines / least,
            distinct / np.maximum(words, 1) ** 0.85, top / least, again / least, exclaims / least, np.log1p(words / (stops + 1)),
            repeated / np.maximum(full_lines, 1), _count(data == 32, offsets) / some,
            np.bincount(text[end - start > 18], minlength=n) / least, _count(_SYMBOLS[data], offsets) / least,
        ]
        block = np.stack(columns, 1)
        block[size == 0] = 0
        out.append(block)
    return np.concatenate(out)


@dataclass
class QualityModel:
    """Standardisation, Fourier frequencies, ridge weights and calibration steps; all of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray | None = None
    step_x: np.ndarray | None = None
    step_y: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        wave = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.frequency + self.phase)
        return np.concatenate([wave, np.ones((len(stats), 1))], 1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.concatenate([self.features(stats[i : i + 4096]) @ self.weight for i in range(0, len(stats), 4096)] or [np.zeros(0)])

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated probability of a high-quality text; the raw score breaks ties within a calibration step."""
        raw = self.raw(stats)
        return np.clip(0.995 * np.interp(raw, self.step_x, self.step_y) + 0.005 * np.clip((raw + 1) / 3, 0, 1), 0, 1)


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its text's statistics."""

    def run(batches):
        for batch in batches:
            block = statistics(batch.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(block.ravel()), block.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column(0), lists], names=["doc_id", "stats"])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("stats", T.ArrayType(T.DoubleType()))]))


def _stats_of(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def fit_quality(train: DataFrame, seed: int = 7) -> QualityModel | None:
    """Model from all rows of ``train`` (stats, label 0 or 1), repeated rows each time; None without rows. Null and empty texts
    teach by their zero statistics. Only a matrix of fixed size and counts over GRID reach the driver."""
    sums = train.select(*[F.struct(F.avg(F.col("stats")[i]).alias("m"), F.stddev_pop(F.col("stats")[i]).alias("s")).alias(f"s{i}") for i in range(len(STATISTICS))], F.count("*").alias("n")).first()
    if not sums["n"]:
        return None
    rng = np.random.default_rng(seed)
    d = len(STATISTICS)
    mean = np.array([sums[f"s{i}"]["m"] for i in range(d)])
    scale = np.maximum([sums[f"s{i}"]["s"] for i in range(d)], 1e-3)
    model = QualityModel(mean, scale, rng.normal(size=(d, FOURIER)) / WIDTH, rng.uniform(0, 2 * np.pi, FOURIER))
    width = FOURIER + 1

    def normal(batches):
        total = np.zeros((width, width + 1))
        seen = False
        for batch in batches:
            stats, label = _stats_of(batch.column(0)), batch.column(1).to_numpy().astype(float)
            for i in range(0, len(stats), 4096):
                z = model.features(stats[i : i + 4096])
                total += np.concatenate([z.T @ z, (z.T @ label[i : i + 4096])[:, None]], 1)
                seen = True
        if seen:
            yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["row", "part"])

    def add(key, table):
        total = sum(np.frombuffer(x, np.float64) for x in table.column("part").to_pylist())
        return pa.table({"row": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    rows = train.select("stats", F.col("label").cast("int")).mapInArrow(normal, "row int, part binary").groupBy("row").applyInArrow(add, "row int, part binary").collect()
    total = np.zeros((width, width + 1))
    for r in rows:
        total[r.row] = np.frombuffer(r.part, np.float64)
    a, y = total[:, :width], total[:, width]
    penalty = RIDGE * sums["n"] * np.eye(width) / width
    penalty[-1, -1] = 1e-9
    model.weight = np.linalg.solve(a + penalty, y)

    def grid(batches):
        n, ones = np.zeros(3 * GRID + 1, np.int64), np.zeros(3 * GRID + 1, np.int64)
        for batch in batches:
            at = np.rint((np.clip(model.raw(_stats_of(batch.column(0))), -1, 2) + 1) * GRID).astype(int)
            label = batch.column(1).to_numpy().astype(int)
            n += np.bincount(at, minlength=len(n))
            ones += np.bincount(at, label, len(n)).astype(np.int64)
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array(used), pa.array(n[used]), pa.array(ones[used])], names=["at", "n", "ones"])

    table = train.select("stats", F.col("label").cast("int")).mapInArrow(grid, "at long, n long, ones long").groupBy("at").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).orderBy("at").toArrow()
    at, n, ones = (table.column(c).to_numpy().astype(float) for c in ("at", "n", "ones"))
    model.step_x, model.step_y = isotonic(at / GRID - 1, ones, n)
    return model


def isotonic(x: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; (x, y) of the ends of each block, for interpolation."""
    blocks: list[list[float]] = []
    for a, k, m in zip(x, ones, n):
        blocks.append([a, a, k, m])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return np.array([v for b in blocks for v in (b[0], b[1])]), np.array([v for b in blocks for v in (b[2] / b[3],) * 2])


def training_rows(stats: DataFrame, labels: DataFrame, bucket, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """Statistics and labels of the rows that ``bucket`` lets train; null labels are left out."""
    known = labels.where(F.col(label_col).isin(0, 1)).where(bucket).select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"))
    return stats.join(known, stats["doc_id"] == known["_id"]).select("stats", "label")


def with_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", score_col: str = "quality_score") -> DataFrame:
    """``docs`` with a score column (a column of that name is replaced). Without a model every score is 1.

    Null and empty texts are scored from zero statistics; very long texts whole; repeated rows get equal scores; an empty
    table gives no rows. Other columns are passed on, whatever their names."""
    keep = [c for c in docs.columns if c != score_col]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(1.0).alias(score_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(shared.value.score(statistics(batch.column(1))))], names=["row", "score"])

    rows = docs.select(row_struct(docs, keep).alias("row"), F.col(f"`{text_col}`").alias("text"))
    scored = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("score").alias(score_col))


def score_statistics(stats: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id and score from a table of statistics."""
    if model is None:
        return stats.select("doc_id", F.lit(1.0).alias("score"))
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(shared.value.score(_stats_of(batch.column(1))))], names=["doc_id", "score"])

    return stats.mapInArrow(run, T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())]))

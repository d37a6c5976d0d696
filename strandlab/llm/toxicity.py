"""Toxicity by a gapped-subsequence string kernel, Nystrom landmarks and a linear support vector machine.

The kernel of two words counts their common subsequences of ``ORDER`` letters, each weighed by LAMBDA to the power of
the stretch it spans in either word, in units of the landmark's own kernel; gaps and inserted characters lower it but do
not break it. It is computed as a sparse product: a word's subsequences are looked up among those of all landmarks at
once. A sentence's similarity to a landmark is the greatest over its words, over words without their
marks (``i-d-i-o-t``) and over runs of single letters (``i d i o t``). Nystrom features whiten the similarities by the
landmarks' own kernel matrix, and a linear SVM over them is trained on labelled sentences: those of clean documents,
and those of toxic documents that hold a word typical of toxic ones. A document is judged by its worst sentence's
margin and by how many of its words are like a landmark.

Words less similar than FLOOR to every landmark count as unlike all. Training reads at most ``TRAIN_DOCS`` labelled
documents of each class.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import GOLDEN, RollingHash, byte_view, crc_bucket, group_starts, mix64, row_struct, take_spans, text_runs
from .shingles import LOWER, word_bounds

ORDER = 3
LAMBDA = 0.8
LONGEST = 24
#: Words whose similarity to every toxic landmark is below this are not looked at further.
FLOOR = 0.3
#: Bound of toxic landmarks.
LANDMARKS = 128
#: Words typical of toxic documents among which landmarks are chosen, and how likely it is that chance makes any.
SURE, CHANCE = 4000, 0.05
#: Documents that a landmark must explain, whatever the size of the sample, and different neighbours that it must have:
#: words that only came along in copies of one text have few.
LEAST_DOCS, LEAST_CONTEXTS = 2, 4.0
CLEAN_LANDMARKS = 8
#: Bound of the training sample: labelled documents of each class, those with the least hash of their id.
TRAIN_DOCS = 6000
COVERS = 4
#: A word is typical of toxic documents with this log-odds.
LEAST_LOG_ODDS = 2.5
#: Words whose similarities a task remembers.
MEMO = 2_000_000

_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


_MARKS = bytes(b for b in range(256) if not _LETTER[b])


def bare(word: bytes) -> bytes:
    """A lower-case word without marks."""
    return word.translate(None, _MARKS)


def stretches(word: bytes) -> list[bytes]:
    """The word, or its overlapping stretches of LONGEST bytes if it is longer."""
    half = LONGEST // 2
    return [word] if len(word) <= LONGEST else [word[i : i + LONGEST] for i in range(0, len(word) - half, half)]


def _spread_weights(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of ORDER letters of a word of ``length``, and their weights."""
    at = np.array(list(combinations(range(length), ORDER)), np.int64).reshape(-1, ORDER)
    return at, LAMBDA ** (at[:, -1] - at[:, 0] + 1.0)


class Kernel:
    """Kernel of words with a fixed set of landmarks, by looking up the words' subsequences."""

    def __init__(self, landmarks: list[bytes]):
        letters = sorted({b for w in landmarks for b in w})
        self.base = len(letters) + 1
        self.code = np.zeros(256, np.int64)
        self.code[letters] = np.arange(1, self.base)
        self.shapes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows = []
        for k, mark in enumerate(landmarks):
            at, weight = self._shape(len(mark))
            rows += [(int(c), k, w) for c, w in zip(self._codes(self.code[np.frombuffer(mark, np.uint8)][None], at)[0], weight)]
        features = sorted({c for c, _, _ in rows})
        self.feature = np.full(self.base**ORDER, -1, np.int32)
        self.feature[features] = np.arange(len(features))
        self.weight = np.zeros((len(features), len(landmarks)))
        for c, k, w in rows:
            self.weight[self.feature[c], k] += w
        self.own = np.maximum((self.weight**2).sum(0), 1e-300)
        self.most = (self.weight / self.own).max(1) if rows else np.zeros(0)

    def _shape(self, length: int):
        if length not in self.shapes:
            self.shapes[length] = _spread_weights(length)
        return self.shapes[length]

    def _codes(self, letters: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = letters[:, at[:, 0]]
        for k in range(1, ORDER):
            out = out * self.base + letters[:, at[:, k]]
        return out

    def values(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, floor: float = 0.0) -> np.ndarray:
        """Kernel of each stretch of ``data``, of at most LONGEST bytes, with each landmark; left 0 where it is below ``floor``,
        in units of the landmarks' own, for all of them."""
        out = np.zeros((len(start), self.weight.shape[1]))
        for length in np.unique(size[size >= ORDER]).tolist():
            rows = np.flatnonzero(size == length)
            at, weight = self._shape(length)
            step = max(1, min((2 << 20) // len(at), (4 << 20) // max(1, len(self.weight))))
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                letters = self.code[data[start[part][:, None] + np.arange(length)]]
                some = np.flatnonzero((letters > 0).sum(1) >= ORDER)
                found = self.feature[self._codes(letters[some], at)]
                word, which = np.nonzero(found >= 0)
                reach = np.bincount(word, weight[which] * self.most[found[word, which]], len(some)) >= floor
                if not reach.all():
                    held = reach[word]
                    word, which, some, found = (np.cumsum(reach) - 1)[word[held]], which[held], some[reach], found[reach]
                sums = np.bincount(word * len(self.weight) + found[word, which], weight[which], len(some) * len(self.weight))
                out[part[some]] = sums.reshape(len(some), len(self.weight)) @ self.weight
        return out

    def similarities(self, words: list[bytes]) -> np.ndarray:
        """Kernel in units of each landmark's own, at most 1, which holding it whole gives; the greatest over the stretches of
        words that are longer than LONGEST."""
        pieces = [stretches(w) for w in words]
        flat = [p for ps in pieces for p in ps]
        size = np.array([len(p) for p in flat], np.int64)
        value = np.minimum(self.values(np.frombuffer(b"".join(flat), np.uint8), np.cumsum(size) - size, size) / self.own, 1.0)
        head = np.cumsum([0, *map(len, pieces)])[:-1]
        return np.maximum.reduceat(value, head, axis=0) if len(words) else value


def gram_matrix(landmarks: list[bytes]) -> np.ndarray:
    """Kernel of all pairs of landmarks, divided by their own kernels."""
    kernel = Kernel(landmarks)
    own = np.sqrt(kernel.own)
    return kernel.weight.T @ kernel.weight / own[:, None] / own[None]


class ToxicModel:
    """Landmarks, of which the first ``toxic`` ones are insults, Nystrom map, SVM weights and the document line."""

    def __init__(self, landmarks: list[bytes], toxic: int, whiten: np.ndarray):
        self.landmarks, self.toxic, self.whiten = landmarks, toxic, whiten
        self.weight: np.ndarray | None = None
        self.bias = -1.0
        self.line: np.ndarray | None = None
        self.kernel = Kernel(landmarks)
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered of words: hashes of all that were seen, and the similarities of those like a landmark."""
        self.seen, self.like, self.sims = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, len(self.landmarks)))

    def learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Remember the words of a stretch of bytes; each distinct one is compared once."""
        distinct = np.unique(hashes)
        fresh = distinct[~_member(distinct, self.seen)]
        if not len(fresh):
            return
        if len(self.seen) + len(fresh) > MEMO:
            self.forget()
            fresh = distinct
        rows = np.flatnonzero(_member(hashes, fresh))
        _, first = np.unique(hashes[rows], return_index=True)
        rows = rows[first]
        letters = take_spans(data, start[rows], end[rows] - start[rows])
        owner = np.repeat(np.arange(len(rows)), end[rows] - start[rows])
        plain = _LETTER[letters]
        letters, size = letters[plain], np.bincount(owner[plain], minlength=len(rows))
        begin = np.cumsum(size) - size
        short = np.where(size <= LONGEST, size, 0)
        sims = np.minimum(self.kernel.values(letters, begin, short, FLOOR) / self.kernel.own, 1.0)
        long = np.flatnonzero(size > LONGEST)
        if len(long):
            sims[long] = self.kernel.similarities([letters[begin[i] : begin[i] + size[i]].tobytes() for i in long.tolist()])
        near = (sims[:, : self.toxic] >= FLOOR).any(1)
        self.seen = np.sort(np.concatenate([self.seen, fresh]))
        self.like = np.concatenate([self.like, fresh[near]])
        self.sims = np.concatenate([self.sims, sims[near]])
        order = np.argsort(self.like)
        self.like, self.sims = self.like[order], self.sims[order]

    def margin(self, similarities: np.ndarray) -> np.ndarray:
        return similarities @ self.whiten @ self.weight + self.bias

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.line[:-1] + self.line[-1], -30, 30)))


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among sorted ones."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray):
    """(first, past) words of each run of at least ORDER words of one letter, or of one and a mark, in a text."""
    single = np.flatnonzero(_LETTER[data[start]] & ((end - start == 1) | (end - start == 2) & ~_LETTER[data[end - 1]]))
    if not len(single):
        return
    head = np.flatnonzero(np.concatenate([[True], (np.diff(single) != 1) | (np.diff(text[single]) != 0)]))
    size = np.diff(np.append(head, len(single)))
    for a, n in zip(single[head[size >= ORDER]].tolist(), size[size >= ORDER].tolist()):
        yield a, a + n


def like_words(model: ToxicModel, array: pa.Array):
    """Yield (first row, text of each word, its sentence, similarities) of the words and spelled runs that are like a landmark."""
    for row, past, offsets, data in text_runs(array):
        data = LOWER[data]
        start, end, text = word_bounds(offsets, data)
        if not len(start):
            continue
        hashes = RollingHash(data).spans(start, end)
        model.learn(hashes, data, start, end)
        found = np.flatnonzero(_member(hashes, model.like))
        sims = model.sims[np.searchsorted(model.like, hashes[found])]
        runs = list(_spelled(data, start, end, text))
        if runs:
            spelled = model.kernel.similarities([data[start[a:b]].tobytes() for a, b in runs])
            near = (spelled[:, : model.toxic] >= FLOOR).any(1)
            found = np.concatenate([found, np.array([a for a, _ in runs], np.int64)[near]])
            sims = np.concatenate([sims, spelled[near]])
        if len(found):
            # sentences are numbered by the marks that end them, and split at the ends of texts
            ends = np.concatenate([[0], np.cumsum(_END[data])])
            yield row, text[found], text[found].astype(np.int64) * (len(data) + 2) + ends[start[found]], sims


def sentence_features(model: ToxicModel, array: pa.Array):
    """Yield (first row, text of each sentence, similarities) of the sentences that hold a word like a landmark."""
    for row, text, sentence, sims in like_words(model, array):
        order = np.argsort(sentence, kind="stable")
        head = group_starts(sentence[order])
        yield row, text[order][head], np.maximum.reduceat(sims[order], head, axis=0)


def _known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """The labels that may be learnt from, as counts too: those of ids with crc32 mod 4 other than 2."""
    return labels.where(F.col(label_col).isin(0, 1)).where(crc_bucket(id_col, 4) != 2).where(F.col(id_col).isNotNull())


def _train_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """text, toxic of the training sample; its ids are at most 2 * TRAIN_DOCS and are sent to every executor."""
    known = _known_labels(labels, id_col, label_col).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
    order = F.xxhash64("_id")
    some = [known.where(F.col("toxic") == k).distinct().orderBy(order, "_id").limit(TRAIN_DOCS) for k in (0, 1)]
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.join(F.broadcast(some[0].union(some[1])), "_id").where("text is not null").select("text", "toxic")


def units(word: bytes) -> list[bytes]:
    """What may mark an insult: the word, or the stretches of a long one, and its stems of 4 to 8 bytes; none is above LONGEST."""
    return [word[:n] for n in range(4, min(9, len(word))) if word[n] & 0xC0 != 0x80] + list(dict.fromkeys(stretches(word))) if len(word) >= ORDER else []


def _words(array: pa.Array):
    """Yield (first row, text, hash and neighbours' hash of each word, how to get one's bytes) over runs of texts."""
    for row, _, offsets, data in text_runs(array):
        data = LOWER[data]
        start, end, text = word_bounds(offsets, data)
        if not len(start):
            continue
        word = RollingHash(data).spans(start, end)
        edge = np.concatenate([[True], text[1:] != text[:-1], [True]])
        before = np.where(edge[:-1], 0, np.concatenate([word[:1], word[:-1]]))
        after = np.where(edge[1:], 0, np.concatenate([word[1:], word[-1:]]))
        yield row, text, word, mix64(before * GOLDEN + after), lambda i, d=data, s=start, e=end: d[s[i] : e[i]].tobytes()


def _unit_counts(batches):
    """Over batches of (text, toxic): unit, and in how many different places between neighbours either class has it."""
    for batch in batches:
        label = batch.column(1).to_numpy()
        counts: dict[bytes, list[int]] = {}
        for row, text, word, context, spell in _words(batch.column(0)):
            toxic = label[row + text].astype(np.uint64)
            _, first = np.unique(mix64(word + mix64(context + toxic)), return_index=True)
            distinct, at, inverse = np.unique(word[first], return_index=True, return_inverse=True)
            a = np.bincount(inverse, toxic[first]).astype(int).tolist()
            n = np.bincount(inverse).tolist()
            for i, x, y in zip(first[at].tolist(), a, n):
                for u in units(bare(spell(i))):
                    c = counts.setdefault(u, [0, 0])
                    c[0] += x
                    c[1] += y - x
        yield pa.record_batch([pa.array(list(counts), pa.binary()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["unit", "a", "b"])


def _unit_places(only: frozenset):
    """Over batches of (text, toxic): each occurrence of the units asked for: unit, a hash of its document, its neighbours."""

    def run(batches):
        for batch in batches:
            found: list[tuple] = []
            whole = RollingHash(byte_view(batch.column(0))[1]).spans(*(lambda o: (o[:-1], o[1:]))(byte_view(batch.column(0))[0])).view(np.int64).tolist()
            for row, text, word, context, spell in _words(batch.column(0)):
                distinct, at, inverse = np.unique(word, return_index=True, return_inverse=True)
                mine = [[u for u in units(bare(spell(i))) if u in only] for i in at.tolist()]
                for i in np.flatnonzero(np.array([bool(m) for m in mine])[inverse]).tolist():
                    found += [(u, whole[row + int(text[i])], int(context[i].view(np.int64))) for u in mine[inverse[i]]]
            cols = list(zip(*found)) or [[], [], []]
            yield pa.record_batch([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["unit", "doc", "context"])

    return run


def _cover(rows) -> list[bytes]:
    """Units that explain toxic documents, greedily: each is in the most documents that no unit before it is in.

    Documents are explained COVERS times over, by units that are not stems of each other, so that synonyms are found too.
    ``rows`` are of the training sample, so bounded by it."""
    docs: dict[bytes, set] = {}
    for r in rows:
        docs.setdefault(bytes(r.unit), set()).add(r.doc)
    everything = set().union(*docs.values()) if docs else set()
    chosen: list[bytes] = []
    for _ in range(COVERS):
        left = set(everything)
        while docs and len(chosen) < LANDMARKS:
            found = {w: n for w, d in docs.items() if (n := len(d & left)) >= LEAST_DOCS}
            if not found:
                break
            best = max(found, key=lambda w: (found[w], len(w), w))
            left -= docs[best]
            chosen.append(best)
            docs = {w: d for w, d in docs.items() if not (w.startswith(best) or best.startswith(w))}
    return chosen


def _variants(word: bytes) -> list[bytes]:
    """A landmark with one character inserted or doubled, or spread out."""
    out = [word, b"".join(bytes([b]) + b"x" for b in word)]
    for i in range(1, len(word)):
        out += [word[:i] + c + word[i:] for c in (b"z", b"q", word[i - 1 : i])]
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicModel | None:
    """Model from the labelled rows with crc32(id) mod 4 other than 2; None if no word is typical of toxic documents, as in an
    empty table. Null labels, ids and texts teach nothing; an id that is labelled or comes several times counts each time."""
    train = _train_rows(docs, labels, id_col, text_col, label_col).persist()
    known = {int(r[label_col]): r["n"] for r in _known_labels(labels, id_col, label_col).groupBy(label_col).agg(F.count("*").alias("n")).collect()}
    try:
        counts = train.mapInArrow(_unit_counts, "unit binary, a long, b long").groupBy("unit").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).persist()
        odds = F.log((F.col("a") + 0.5) / (F.col("b") + 0.5))
        total = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("n")).first()
        prior = float(np.log((total.a or 0.5) / (total.b or 0.5)))
        high = counts.where((odds - prior > LEAST_LOG_ODDS) & (F.col("a") >= LEAST_CONTEXTS))
        # twice the log-likelihood ratio of a unit's share of toxic places, against the chance of any of all units to reach it
        share = 1 / (1 + float(np.exp(-prior)))
        a, b = F.col("a"), F.col("b")
        ratio = 2 * (a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0))
        beyond = high.withColumn("ratio", ratio).where(F.col("ratio") > 2 * float(np.log(max(1, total.n) / CHANCE))).orderBy(F.col("ratio").desc(), "unit").limit(SURE).collect()
        only = frozenset(bytes(r.unit) for r in beyond)
        toxic = _cover(_typical(train, only).collect()) if only else []
        if not toxic:
            return None
        clean = counts.where("a > 0 and b > 0").where(F.octet_length("unit") > 3).orderBy(F.col("b").desc(), "unit").limit(CLEAN_LANDMARKS).collect()
        counts.unpersist()
        marks = toxic + [bytes(r.unit) for r in clean if bytes(r.unit) not in toxic]
        values, vectors = np.linalg.eigh(gram_matrix(marks))
        keep = values > 1e-6
        whiten = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
        model = ToxicModel(marks, len(toxic), whiten)
        _fit_svm(model, train, known)
        model.forget()
        return model
    finally:
        train.unpersist()


def _typical(train: DataFrame, only: frozenset) -> DataFrame:
    """(unit, doc) of the toxic sample for units whose neighbours differ: the effective number of them, as the inverse of the
    chance that two occurrences share theirs, is at least LEAST_CONTEXTS."""
    places = train.where("toxic = 1").mapInArrow(_unit_places(only), "unit binary, doc long, context long")
    count = places.groupBy("unit", "context").agg(F.count("*").cast("double").alias("n")).groupBy("unit").agg((F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n"))).alias("differ"))
    return places.select("unit", "doc").distinct().join(count.where(F.col("differ") >= LEAST_CONTEXTS).select("unit"), "unit")


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3, steps: int = 3000) -> tuple[np.ndarray, float]:
    """Weights and bias of the least weighted hinge loss plus decay / 2 times the squared weights: the mean of the second half of
    sub-gradient steps."""
    w, b, mean_w, mean_b = np.zeros(x.shape[1]), 0.0, 0.0, 0.0
    for step in range(1, steps + 1):
        active = y * (x @ w + b) < 1
        grad = decay * w - (weight[active] * y[active]) @ x[active]
        rate = 2.0 / (1 + 0.02 * step)
        w, b = w - rate * grad, b + rate * float((weight[active] * y[active]).sum())
        if step > steps // 2:
            mean_w, mean_b = mean_w + w, mean_b + b
    return mean_w / (steps - steps // 2), mean_b / (steps - steps // 2)


def _fit_svm(model: ToxicModel, train: DataFrame, known: dict[int, int]) -> None:
    """Sentence features, equal ones counted together, and each document's class; then sub-gradient steps and calibration."""
    def features(batches):
        for batch in batches:
            label = batch.column(1).to_numpy()
            cols: list[list] = [[], [], []]
            for row, text, sims in sentence_features(model, batch.column(0)):
                for t, s in zip(text.tolist(), np.round(sims, 3)):
                    cols[0].append(row + t)
                    cols[1].append(int(label[row + t]))
                    cols[2].append(s.astype("<f4").tobytes())
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], names=["text", "toxic", "sims"])

    table = train.mapInArrow(features, "text long, toxic int, sims binary").groupBy("toxic", "sims").agg(F.count("*").alias("n")).orderBy("toxic", "sims").toArrow()
    sims = np.array([np.frombuffer(x, "<f4") for x in table.column("sims").to_pylist()], float).reshape(-1, len(model.landmarks))
    label = table.column("toxic").to_numpy()
    count = table.column("n").to_numpy().astype(float)
    has = (sims[:, : model.toxic] >= 0.998).any(1)  # sentences that hold a landmark whole
    use = (label == 0) | has
    sims, label, count = sims[use], label[use], np.sqrt(count[use])
    extra = model.kernel.similarities([v for w in model.landmarks[: model.toxic] for v in _variants(w)])
    x = np.concatenate([sims, np.zeros((1, sims.shape[1])), extra]) @ model.whiten
    y = np.concatenate([np.where(label == 1, 1.0, -1.0), [-1.0], np.ones(len(extra))])
    weight = np.concatenate([count, [count.sum() + 1], np.full(len(extra), max(1.0, count[label == 1].sum() / max(1, len(extra))))])
    for side in (1.0, -1.0):
        weight[y == side] /= weight[y == side].sum()
    model.weight, model.bias = support_vectors(x, y, weight)
    _calibrate(model, train, known)


def _evidence(model: ToxicModel, array: pa.Array) -> np.ndarray:
    """For each text: its worst sentence's margin, how many of its words are like a toxic landmark, and their share."""
    size = np.diff(byte_view(array)[0])
    worst = np.full(len(size), float(model.margin(np.zeros((1, len(model.landmarks))))[0]))
    many = np.zeros(len(size))
    for row, text, sentence, sims in like_words(model, array):
        order = np.argsort(sentence, kind="stable")
        head = group_starts(sentence[order])
        np.maximum.at(worst, row + text[order][head], model.margin(np.maximum.reduceat(sims[order], head, axis=0)))
        np.add.at(many, row + text, np.clip(2 * sims[:, : model.toxic].max(1) - 1, 0, 1))
    return np.stack([worst, np.log1p(many), 30 * np.sqrt(many / (100 + size))], 1)


def _calibrate(model: ToxicModel, train: DataFrame, known: dict[int, int]) -> None:
    """Logistic weights of a document's evidence, by Newton steps; classes weigh as they do among all labelled rows."""

    def run(batches):
        for batch in batches:
            x = _evidence(model, batch.column(0))
            yield pa.record_batch([batch.column(1), *[pa.array(x[:, i]) for i in range(3)]], names=["toxic", "a", "b", "c"])

    table = train.mapInArrow(run, "toxic int, a double, b double, c double").orderBy("toxic", "a", "b", "c").toArrow()
    y = table.column("toxic").to_numpy().astype(float)
    x = np.stack([table.column(c).to_numpy() for c in "abc"] + [np.ones(len(y))], 1)
    share = np.where(y == 1, known.get(1, 1) / max(1, (y == 1).sum()), known.get(0, 1) / max(1, (y == 0).sum()))
    share *= len(y) / share.sum()
    w = np.zeros(4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-2 * np.eye(4)
        w = w + np.linalg.solve(hessian, x.T @ (share * (y - p)) - 1e-2 * w)
    model.line = w


def with_toxicity(docs: DataFrame, model: ToxicModel | None, *, text_col: str = "text", score_col: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all when None) and a score from 0 to 1; a column of that name is replaced.

    Null and empty texts get the score of a text without any similar word, as all clean texts do; very long texts are judged
    whole; repeated rows get equal scores; without a model every score is 0; an empty table gives no rows. Other columns are
    passed on, whatever their names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(0.0).alias(score_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(own.score(_evidence(own, batch.column(1))))], names=["row", "score"])

    rows = docs.select(row_struct(docs, keep).alias("row"), F.col(f"`{text_col}`").alias("text"))
    scored = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("score").alias(score_col))

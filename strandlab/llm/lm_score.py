"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) P(word | class, history). The most frequent tokens are classes of their own, other
words share classes by a hash of their ending. The class softmax has weights for n-gram features (previous class, hashed
pair of previous classes) and skip features (second and third class back); it starts from smoothed class bigrams and is
trained by gradient updates: every partition sums the gradient over its share of the corpus's class 4-gram counts, and
the sums set the next weights.

Within a class a word starts from its smoothed share of the class's training tokens, and has a weight for the nearest
word before it, at most three back, that is no class of its own: an n-gram or a skip feature, kept where the training texts
have it twice. As all other words of the class keep their share, the softmax is exact from the words with features alone.
These weights grow with the corpus. They are hashed to buckets by history and class (large classes in parts), and each
bucket fits its own by gradient updates with a Gaussian prior.

Token counts cover the whole corpus and never meet in one place: batches of documents send the hashes of their distinct
tokens with counts to hash buckets, which send back the corpus counts of just these; so do the pairs of words. Scores are
computed batch by batch in numpy, once for each distinct history.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, RollingHash, batch_count, column, crc_bucket, deltas, message_rows, mix64, pack, stage, text_runs, unpack, unstage
from .shingles import LOWER, word_bounds

CLASSES = 64
#: Tokens that are classes of their own; the first is the end of a text.
OWN = 32
PAIRS = 2048
UPDATES = 6
DAMPING = 0.5
#: How far back a word's history word may be, how often a pair must occur, the prior's variance and the updates of pair weights.
BACK, LEAST_PAIRS, VARIANCE, PAIR_UPDATES = 3, 2, 4.0, 16
#: A class is in one part for so many batches, and in at most so many parts.
BATCHES_PER_PART, MOST_PARTS = 64, 64
#: Summaries of buckets that are added up at once; the driver gets no more.
FAN_IN = 64

_SPEC = "bucket int, pid int, message binary"
_END_HASH = np.uint64(0x0E2D0E2D0E2D0E2D)


class Tokens:
    """Tokens of texts that lie one after the other: hash, ending class and text number, an end after each text."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        data = LOWER[data]
        start, past, text = word_bounds(offsets, data)
        texts = len(offsets) - 1
        word = RollingHash(data).spans(start, past) if len(start) else np.zeros(0, np.uint64)
        last = data[past - 1].astype(np.uint64) if len(start) else word
        before = np.where(past - start > 1, data[np.maximum(past - 2, 0)], 0).astype(np.uint64) if len(start) else word
        ending = (mix64(last * np.uint64(257) + before + GOLDEN) % np.uint64(CLASSES - OWN)).astype(np.int64) + OWN
        counts = np.bincount(text, minlength=texts)
        at = np.arange(len(word)) + text
        self.n = counts + 1
        total = len(word) + texts
        self.hash = np.full(total, _END_HASH, np.uint64)
        self.ending = np.zeros(total, np.int64)
        self.hash[at], self.ending[at] = word, ending
        self.text = np.repeat(np.arange(texts), self.n)


@dataclass
class Vocabulary:
    """Corpus totals, tokens that are classes (sorted hashes and their class) and totals of class parts; all of fixed size."""

    tokens: int
    distinct: int
    own_hash: np.ndarray
    own_class: np.ndarray
    part_total: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.part_total) // CLASSES

    def classes(self, tokens: Tokens) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.own_hash, tokens.hash), len(self.own_hash) - 1)
        return np.where(self.own_hash[at] == tokens.hash, self.own_class[at], tokens.ending)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of its class that a word is in; by the upper half of its hash, which is what pairs carry."""
    return ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def histories(classes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The three classes before each token, nearest first; before a text lies the end class 0."""
    out = np.zeros((3, len(classes)), np.int64)
    for k in (1, 2, 3):
        same = text[k:] == text[:-k]
        out[k - 1, k:] = np.where(same, classes[:-k], 0)
    return out


@dataclass
class ClassModel:
    """Weights of the class softmax."""

    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    pair: np.ndarray
    #: Logarithm of the softmax's normaliser for each history, by its code.
    norm: np.ndarray | None = None

    @staticmethod
    def slot(a, b):
        return (mix64((a * CLASSES + b).astype(np.uint64) + GOLDEN) % np.uint64(PAIRS)).astype(np.int64)

    def log_probabilities(self, history: np.ndarray) -> np.ndarray:
        a, b, c = history
        z = self.one[a] + self.two[b] + self.three[c] + self.pair[self.slot(a, b)]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def normalise(self) -> None:
        """Fill ``norm``, whose size is fixed, so that scoring needs no softmax."""
        code = np.arange(CLASSES**3)
        self.norm = np.empty(len(code))
        for i in range(0, len(code), 8192):
            part = code[i : i + 8192]
            a, b, c = part % CLASSES, part // CLASSES % CLASSES, part // CLASSES**2
            z = self.one[a] + self.two[b] + self.three[c] + self.pair[self.slot(a, b)]
            top = z.max(1)
            self.norm[part] = top + np.log(np.exp(z - top[:, None]).sum(1))

    def log_probability(self, history: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Of one class after each history."""
        a, b, c = history
        z = self.one[a, classes] + self.two[b, classes] + self.three[c, classes] + self.pair[self.slot(a, b), classes]
        return z - self.norm[(c * CLASSES + b) * CLASSES + a]


def _token_messages(table: pa.Table, pid: int, buckets: int) -> pa.Table:
    hashes, counts, endings = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    train = column(table, "train").to_numpy(zero_copy_only=False).astype(np.int64)
    for row, past, offsets, data in text_runs(column(table, "text")):
        t = Tokens(offsets, data)
        distinct, first, inverse = np.unique(t.hash, return_index=True, return_inverse=True)
        hashes.append(distinct)
        endings.append(t.ending[first])
        counts.append(np.bincount(inverse, train[row:past][t.text], len(distinct)).astype(np.int64))
    hashes, counts, endings = np.concatenate(hashes), np.concatenate(counts), np.concatenate(endings)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    counts, endings = np.bincount(inverse, counts, len(distinct)).astype(np.int64), endings[first]
    cut = np.searchsorted(distinct, (np.arange(1, buckets, dtype=np.uint64)) * np.uint64((1 << 64) // buckets))
    parts = zip(np.split(distinct, cut), np.split(counts, cut), np.split(endings, cut))
    return message_rows([(b, pid, pack(deltas(h), n.astype(np.uint32), e.astype(np.uint8))) for b, (h, n, e) in enumerate(parts) if len(h)])


def _corpus_counts(table: pa.Table, parts: int) -> pa.Table:
    """Answers of a bucket: corpus counts of each batch's tokens; and, as pid -1, its totals and most frequent tokens."""
    bucket = table.column("bucket")[0].as_py()
    messages = [unpack(m) for m in table.column("message").to_pylist()]
    hashes = [np.cumsum(p[0], dtype=np.uint64) for p in messages]
    distinct, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(inverse, np.concatenate([p[1] for p in messages]), len(distinct)).astype(np.int64)
    ending = np.concatenate([p[2] for p in messages])[first].astype(np.int64)
    rows, at = [], 0
    for pid, own in zip(table.column("pid").to_pylist(), hashes):
        rows.append((bucket, pid, pack(total[inverse[at : at + len(own)]])))
        at += len(own)
    seen = total > 0
    top = np.argsort(-total, kind="stable")[:OWN]
    slot = ending * parts + part_of(distinct, parts)
    sums = (np.bincount(slot, total, CLASSES * parts).astype(np.int64), np.bincount(slot, seen, CLASSES * parts).astype(np.int64))
    rows.append((bucket, -1, pack(*sums, distinct[top], total[top], ending[top])))
    return message_rows(rows)


def _added(summaries: list[bytes], parts: int) -> list[np.ndarray]:
    """Summaries of disjoint buckets as one of the same size: totals, and the most frequent tokens seen in training, the end first."""
    found = [unpack(m) for m in summaries] or [[np.zeros(CLASSES * parts, np.int64)] * 2 + [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]]
    hashes, counts, endings = (np.concatenate([p[i] for p in found]) for i in (2, 3, 4))
    order = np.lexsort((hashes, -counts, hashes != _END_HASH))
    order = order[counts[order] > 0][:OWN]
    return [sum(p[0] for p in found), sum(p[1] for p in found), hashes[order], counts[order], endings[order]]


def _summaries(counts: DataFrame, buckets: int, parts: int) -> list[bytes]:
    """Summaries of all buckets, added up until no more than FAN_IN of them are left for the driver."""

    def add(key, table):
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "message": pa.array([pack(*_added(table.column("message").to_pylist(), parts))], pa.binary())})

    rows = counts.where("pid = -1").select("bucket", "message")
    while buckets > FAN_IN:
        buckets = -(-buckets // FAN_IN)
        rows = rows.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("int")).groupBy("bucket").applyInArrow(add, "bucket int, message binary")
    return [bytes(r.message) for r in rows.orderBy("bucket").collect()]


def _vocabulary(summaries: list[bytes], parts: int) -> Vocabulary:
    tokens, distinct, hashes, counts, endings = _added(summaries, parts)
    order = np.arange(len(hashes))
    own = np.concatenate([[_END_HASH], hashes[hashes != _END_HASH]])[:OWN]
    all_tokens, all_distinct = int(tokens.sum()), int(distinct.sum())
    total = tokens + distinct
    np.subtract.at(total, endings[order] * parts + part_of(hashes[order], parts), counts[order] + 1)
    by = np.argsort(own)
    # one more for words that no training text has
    return Vocabulary(all_tokens, all_distinct, own[by], by, total + 1)


def word_pairs(t: Tokens, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of tokens with a pair feature, keys): upper halves of the hashes of the nearest earlier word that is no class of
    its own, and of the word itself. Histories that the training texts have once have no features."""
    rare = classes >= OWN
    place = np.arange(len(rare))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(rare, place, -1))[:-1]]) if len(rare) else place
    safe = np.maximum(last, 0)
    at = np.flatnonzero(rare & (last >= 0) & (t.text[safe] == t.text) & (place - last <= BACK) & (counts[safe] >= LEAST_PAIRS))
    low = np.uint64(32)
    return at, (t.hash[last[at]] >> low << low) | (t.hash[at] >> low)


class BatchTokens:
    """Tokens of a batch in parts, with their classes and corpus counts."""

    def __init__(self, docs: pa.Table, answers: pa.Table, vocabulary: Vocabulary):
        known = [unpack(m)[0] for _, m in sorted((b, m) for b, k, m in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "message"))) if k == 0)]
        known = np.concatenate(known or [np.zeros(0, np.int64)])
        self.parts = [(row, past, Tokens(o, d)) for row, past, o, d in text_runs(column(docs, "text"))]
        own = [np.unique(t.hash, return_inverse=True) for _, _, t in self.parts]
        distinct = np.unique(np.concatenate([h for h, _ in own] or [np.zeros(0, np.uint64)]))
        self.counts = [known[np.searchsorted(distinct, h)][inverse] for h, inverse in own]
        self.classes = [vocabulary.classes(t) for _, _, t in self.parts]
        pairs = [word_pairs(t, c, n) for (_, _, t), c, n in zip(self.parts, self.classes, self.counts)]
        keys = np.concatenate([np.zeros(0, np.uint64), *(k for _, k in pairs)])
        self.keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        # places of tokens with a pair in each part, and which one
        cut = np.cumsum([0, *(len(at) for at, _ in pairs)])
        self.pairs = [(at, inverse[a:b]) for (at, _), a, b in zip(pairs, cut, cut[1:])]
        self.key_class, self.key_count = (np.concatenate([x[at] for x, (at, _) in zip(values, pairs)] or [np.zeros(0, np.int64)])[first] for values in (self.classes, self.counts))

    def by_bucket(self, buckets: int, parts: int):
        """(bucket, its keys' rows) of the distinct pairs: those of one history and one part of a class go to one bucket."""
        unit = (self.keys >> np.uint64(32) << np.uint64(32)) + (self.key_class * parts).astype(np.uint64) + (self.keys & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
        bucket = (mix64(unit) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            yield b, order[cut[b] : cut[b + 1]]


def _pair_messages(docs: pa.Table, answers: pa.Table, pid: int, buckets: int, vocabulary: Vocabulary) -> pa.Table:
    """Distinct pairs of a batch: key, count in training texts, the word's class and corpus count."""
    b = BatchTokens(docs, answers, vocabulary)
    train = column(docs, "train").to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.zeros(len(b.keys))
    for (row, past, t), (at, which) in zip(b.parts, b.pairs):
        n += np.bincount(which, train[row:past][t.text[at]], len(b.keys))
    return message_rows([(x, pid, pack(deltas(b.keys[r]), n[r].astype(np.uint32), b.key_class[r].astype(np.uint8), b.key_count[r].astype(np.uint64))) for x, r in b.by_bucket(buckets, vocabulary.parts)])


def fit_pairs(unit: np.ndarray, share: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log P(word | class part, history) - log share of each pair: its weight less the logarithm of its unit's normaliser.

    ``unit`` numbers the history and class part of each pair, ``share`` is the word's share of that part, ``n`` its count. The
    likelihood with a Gaussian prior is climbed by diagonal Newton steps, for all units at once."""
    units = int(unit.max()) + 1 if len(unit) else 0
    total = np.bincount(unit, n, units)
    has = n >= LEAST_PAIRS
    weight = np.zeros(len(n))
    norm = np.ones(units)
    if has.any():
        u, q, k = unit[has], share[has], n[has]
        w = np.zeros(len(q))
        for _ in range(PAIR_UPDATES):
            p = q * np.exp(w)
            norm = 1 + np.bincount(u, p - q, units)
            p /= norm[u]
            expected = total[u] * p
            w += np.clip((k - expected - w / VARIANCE) / (expected * (1 - p) + 1 / VARIANCE), -2, 2)
        norm = 1 + np.bincount(u, q * np.expm1(w), units)
        weight[has] = w
    return weight - np.log(norm)[unit]


def _pair_values(table: pa.Table, vocabulary: Vocabulary) -> pa.Table:
    """Answers of a bucket: the value of each batch's pairs."""
    bucket, parts = table.column("bucket")[0].as_py(), vocabulary.parts
    messages = [unpack(m) for m in table.column("message").to_pylist()]
    keys = [np.cumsum(m[0], dtype=np.uint64) for m in messages]
    distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    n = np.bincount(inverse, np.concatenate([m[1] for m in messages]), len(distinct))
    kind, count = (np.concatenate([m[i] for m in messages])[first] for i in (2, 3))
    slot = kind.astype(np.int64) * parts + ((distinct & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64)
    history = (distinct >> np.uint64(32)).astype(np.int64)
    _, unit = np.unique(history * (CLASSES * parts) + slot, return_inverse=True)
    value = fit_pairs(unit, (count + 1.0) / vocabulary.part_total[slot], n).astype(np.float32)
    rows, at = [], 0
    for pid, own in zip(table.column("pid").to_pylist(), keys):
        rows.append((bucket, pid, pack(value[inverse[at : at + len(own)]])))
        at += len(own)
    return message_rows(rows)


def _class_grams(vocabulary):
    def run(batches):
        for batch in batches:
            codes = [np.zeros(0, np.int64)]
            for _, _, offsets, data in text_runs(batch.column(0)):
                t = Tokens(offsets, data)
                c = vocabulary.value.classes(t)
                a, b, d = histories(c, t.text)
                codes.append(((d * CLASSES + b) * CLASSES + a) * CLASSES + c)
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.record_batch([pa.array(code), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return run


def _fit_classes(grams: DataFrame) -> ClassModel:
    """Weights from (gram, n): class bigrams first, then gradient updates over all grams."""
    bigrams = grams.groupBy((F.col("gram") % CLASSES**2).alias("gram")).agg(F.sum("n").alias("n")).toArrow()  # CLASSES ** 2 rows
    counts = np.full((CLASSES, CLASSES), 0.0)
    code = bigrams.column("gram").to_numpy()
    counts[code // CLASSES, code % CLASSES] = bigrams.column("n").to_numpy()
    backoff = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * CLASSES)
    start = np.log((counts + 8 * backoff[None]) / (counts.sum(1, keepdims=True) + 8))
    model = ClassModel(start, np.zeros((CLASSES, CLASSES)), np.zeros((CLASSES, CLASSES)), np.zeros((PAIRS, CLASSES)))
    context = grams.sparkSession.sparkContext
    for _ in range(UPDATES):
        shared = context.broadcast(model)

        def gradient(batches, shared=shared):
            own = shared.value
            size = (CLASSES, CLASSES, CLASSES, PAIRS)
            grad, curve = [np.zeros((s, CLASSES)) for s in size], [np.zeros((s, CLASSES)) for s in size]
            for batch in batches:
                code, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(float)
                context, inverse = np.unique(code // CLASSES, return_inverse=True)
                for i in range(0, len(context), 8192):
                    part = context[i : i + 8192]
                    mine = (inverse >= i) & (inverse < i + 8192)
                    seen = np.zeros((len(part), CLASSES))
                    np.add.at(seen, (inverse[mine] - i, code[mine] % CLASSES), n[mine])
                    history = np.stack([part % CLASSES, part // CLASSES % CLASSES, part // CLASSES**2])
                    expected = np.exp(own.log_probabilities(history)) * seen.sum(1, keepdims=True)
                    residual = seen - expected
                    for k, at in enumerate((*history, own.slot(history[0], history[1]))):
                        order = np.argsort(at, kind="stable")
                        head = np.flatnonzero(np.concatenate([[True], at[order][1:] != at[order][:-1]]))
                        grad[k][at[order][head]] += np.add.reduceat(residual[order], head, axis=0)
                        curve[k][at[order][head]] += np.add.reduceat(expected[order], head, axis=0)
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([pack(*[x.ravel() for x in (*grad, *curve)])], pa.binary())], names=["part", "sums"])

        def add(key, table):
            total = None
            for message in table.column("sums").to_pylist():
                arrays = unpack(message)
                total = arrays if total is None else [a + b for a, b in zip(total, arrays)]
            return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([pack(*total)], pa.binary())})

        # partial sums of fixed size meet in a few tasks, then on the driver
        sums = grams.mapInArrow(gradient, "part int, sums binary").withColumn("part", F.spark_partition_id() % 8).groupBy("part").applyInArrow(add, "part int, sums binary").collect()
        arrays = [sum(x) for x in zip(*[unpack(r.sums) for r in sums])] if sums else []
        for k, name in enumerate(("one", "two", "three", "pair") if arrays else ()):
            weight = getattr(model, name)
            step = arrays[k].reshape(weight.shape) / (arrays[k + 4].reshape(weight.shape) + 10.0)
            setattr(model, name, weight + DAMPING * np.clip(step, -2, 2) * (1.0 if name == "one" else 0.7))
        shared.unpersist()
    model.normalise()
    return model


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (both log10) of every text.

    Learns from the texts whose crc32(id) modulo ``modulus`` is not ``held``. Null and empty texts are one token, the end.
    Null ids count as empty id text; very long texts are scored whole; repeated rows are counted and scored row by row. Without any training text every
    token has probability 1 in the base score and an even share in the model. An empty table gives no rows. Only the
    two named columns are read.
    """
    batches = batch_count(docs, text_col)
    buckets = max(8, batches // 2)
    parts = int(min(MOST_PARTS, max(1, batches // BATCHES_PER_PART)))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), (crc_bucket(id_col, modulus) != held).alias("train"))
    batch = rows.withColumn("pid", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))
    sent = batch.groupBy("pid").applyInArrow(lambda key, t: _token_messages(t, key[0].as_py(), buckets), _SPEC)
    counts = stage(sent.groupBy("bucket").applyInArrow(lambda t: _corpus_counts(t, parts), _SPEC), "token_counts")
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary(_summaries(counts, buckets, parts), parts))
    grams = stage(rows.where("train").select("text").mapInArrow(_class_grams(vocabulary), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "class_grams")
    model = docs.sparkSession.sparkContext.broadcast(_fit_classes(grams))
    unstage(grams)
    known = counts.where("pid >= 0").select("bucket", "pid", "message", F.lit(0).alias("kind"))

    def send_pairs(key, left, right):
        return _pair_messages(left, right, key[0].as_py(), buckets, vocabulary.value)

    pairs = batch.groupBy("pid").cogroup(known.groupBy("pid")).applyInArrow(send_pairs, _SPEC)
    values = pairs.groupBy("bucket").applyInArrow(lambda t: _pair_values(t, vocabulary.value), _SPEC).withColumn("kind", F.lit(1))

    def score(left, right):
        return _scores(left, right, vocabulary.value, model.value, buckets)

    spec = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return batch.groupBy("pid").cogroup(known.unionByName(values).groupBy("pid")).applyInArrow(score, spec)


def _scores(docs: pa.Table, answers: pa.Table, v: Vocabulary, m: ClassModel, buckets: int) -> pa.Table:
    """Both scores of the texts of a batch."""
    b = BatchTokens(docs, answers, v)
    value = np.zeros(len(b.keys))
    given = {x: message for x, k, message in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "message"))) if k == 1}
    for x, r in b.by_bucket(buckets, v.parts):
        value[r] = unpack(given[x])[0]
    log_total = np.log(v.part_total.reshape(CLASSES, -1).sum(1))
    out: list[list[np.ndarray]] = [[], [], [], []]
    for (row, past, t), c, count, (at, which) in zip(b.parts, b.classes, b.counts, b.pairs):
        of_class = m.log_probability(histories(c, t.text), c)
        # own classes hold one token each
        within = np.where(c < OWN, 0.0, np.log(count + 1.0) - log_total[c])
        within[at] += value[which]
        texts = past - row
        for values, x in zip(out, (t.n, np.bincount(t.text, count > 0, texts), np.bincount(t.text, np.log10((count + 1.0) / (v.tokens + v.distinct + 1.0)), texts), np.bincount(t.text, (of_class + within) / np.log(10), texts))):
            values.append(x)
    n_tokens, n_known, base, score = (np.concatenate(x) if x else np.zeros(0) for x in out)
    return pa.table(
        {
            "doc_id": column(docs, "doc_id"), "held_out": pc.invert(column(docs, "train")), "n_tokens": pa.array(n_tokens.astype(np.int64)), "n_known": pa.array(n_known.astype(np.int64)),
            "train_tokens": pa.array(np.full(docs.num_rows, v.tokens), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
        }
    )

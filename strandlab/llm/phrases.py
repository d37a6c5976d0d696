"""Phrase collocations by dynamic itemset counting.

Documents are dealt to ``SHARDS`` shards, which are scanned in turn, round and round. Single words are counted in the first round.
A pair of words is counted from the scan on after both its words have reached the threshold, a triple from the scan on after both
its pairs have; each is counted in just as many scans in a row as there are shards, so once on every shard, whichever comes first.
Pairs and triples of several ages are so counted in one scan, and rare ones never.

What is active, and since which scan, is one byte for each of 2 ** MASK_BITS hash places, the earliest of all words or pairs there:
tasks get it whole, as its size is fixed. A shared place lets a phrase start early, which costs rows but no exactness, as the
phrase's own scans, from the place's scan on, are still one full round, and its total is judged at the end.

Words are keyed by a 64-bit hash of language and word, pairs and triples by those of their words, so counts travel as whole numbers.
That no two words of the corpus share a hash is checked on the table of all words; if two do, counting starts again with other hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLDEN, RollingHash, byte_view, mix64, stage, text_runs, unstage
from .shingles import LOWER

SHARDS = 3
LEAST_COUNT = 10
MASK_BITS = 23
#: Bytes of text whose equal words and phrases are counted together before they leave the task.
RUN_BYTES = 8 << 20
#: Parts of a language that are ranked apart before their heads are ranked together.
RANK_PARTS = 64
NEVER = 255
#: Ends of pieces, and what separates words within pieces (fixed values of the contract).
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _ENDS.copy()
_APART[list(b" \t")] = True

_SCAN = "w1 long, w2 long, w3 long, since int, n long"


def _slices(offsets: np.ndarray, data: np.ndarray):
    """(offsets, bytes, words counted before) of a run; one long text comes in slices cut between words, each with the last two words
    before it."""
    if len(offsets) > 2 or len(data) <= 2 * RUN_BYTES:
        yield offsets, data, 0
        return
    at, before, known = 0, np.zeros(0, np.uint8), 0
    while at < len(data):
        past = min(len(data), at + RUN_BYTES)
        while past < len(data) and not _APART[data[past]]:
            ahead = np.flatnonzero(_APART[data[past : past + RUN_BYTES]])
            past = past + int(ahead[0]) if len(ahead) else min(len(data), past + RUN_BYTES)
        own = np.concatenate([before, data[at:past]])
        yield np.array([0, len(own)]), own, known
        start, end = _bounds(own)
        tail = [own[:0]]
        for k in range(max(0, len(start) - 2), len(start)):
            gap = own[end[k] : start[k + 1] if k + 1 < len(start) else len(own)]
            tail += [own[start[k] : end[k]], np.frombuffer(b"\n" if _ENDS[gap].any() else b" ", np.uint8)]
        at, before, known = past, np.concatenate(tail), min(2, len(start))


def _bounds(data: np.ndarray, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    word = ~_APART[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[[0, len(data)] if offsets is None else offsets] = True
    start = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    past = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1 if len(data) else start
    return start, past


class Run:
    """Words of a stretch of texts of one language: codes into a dictionary, and whether neighbours are of one piece."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, known: int):
        data = LOWER[data]
        start, past = _bounds(data, offsets)
        edges = np.concatenate([[0], np.cumsum(past - start)])
        flat = np.ascontiguousarray(data[~_APART[data]])
        coded = pa.StringArray.from_buffers(len(start), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(flat)).dictionary_encode()
        self.words, self.code, self.known = coded.dictionary, coded.indices.to_numpy().astype(np.int64), known
        piece = np.cumsum(_ENDS[data], dtype=np.int32)[start] + np.searchsorted(offsets, start, side="right") if len(start) else start
        self.beside = piece[1:] == piece[:-1]

    def hashes(self, salt: np.uint64) -> np.ndarray:
        offsets, data = byte_view(self.words)
        return RollingHash(data).spans(offsets[:-1], offsets[1:]) * GOLDEN + salt if len(data) else np.zeros(0, np.uint64)


def _salt(lang: str, seed: int) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    own = RollingHash(raw).spans(np.array([0]), np.array([len(raw)]))[0]
    return mix64(np.array([own], np.uint64) + np.array([seed], np.uint64) * GOLDEN)[0]


def word_keys(run: Run, lang: str, seed: int) -> np.ndarray:
    return mix64(run.hashes(_salt(lang, seed)))


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of words are mixed already; the same rule in SQL is PAIR_KEY."""
    return a ^ (b << np.uint64(17) | b >> np.uint64(47))


def _runs(batches):
    """(lang, run) of all texts; rows of a batch are taken language by language."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        code = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(1).filter(pa.array(code == k))
            for _, _, offsets, data in text_runs(texts, RUN_BYTES):
                for part in _slices(offsets, data):
                    yield lang, Run(*part)


def _rows_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))


def _count_words(shard: DataFrame, seed: int) -> DataFrame:
    """w, lang, word and n of all words of a shard."""

    def count(batches):
        for lang, run in _runs(batches):
            n = np.bincount(run.code[run.known :], minlength=len(run.words))
            seen = pa.array(n > 0)
            keys = pa.array(word_keys(run, lang, seed).view(np.int64))
            yield pa.record_batch([keys.filter(seen), pa.array([lang] * int((n > 0).sum()), pa.string()), run.words.filter(seen), pa.array(n).filter(seen)], names=["w", "lang", "word", "n"])

    return shard.mapInArrow(count, "w long, lang string, word string, n long").groupBy("w", "lang", "word").agg(F.sum("n").alias("n"))


def _grouped(keys: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first place, count) of each distinct tuple of codes below ``size``."""
    code = keys[0]
    for k, more in enumerate(keys[1:]):
        if k and size >= 1 << 20:  # three codes no longer fit in 64 bits
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        code = code * size + more
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def phrase_rows(run: Run, lang: str, seed: int, step: int, shards: int, word_since: np.ndarray, pair_since: np.ndarray) -> list[tuple]:
    """(w1, w2, w3, since, n) arrays of the pairs (w3 is 0) and triples of a run whose round is on at scan ``step``."""
    key, code = word_keys(run, lang, seed), run.code
    place = lambda x, mask: mask[(x >> np.uint64(64 - int(len(mask)).bit_length() + 1)).astype(np.int64)]
    since = place(key, word_since)[code]
    counted = np.arange(len(code)) >= run.known
    on = lambda s: (s <= step) & (s + shards > step)
    pair = np.maximum(since[1:], since[:-1]).astype(np.int32)
    at = np.flatnonzero(run.beside & on(pair) & counted[1:])
    out = []
    if len(at):
        first, n = _grouped([code[at], code[at + 1]], len(key))
        i = at[first]
        out.append((key[code[i]], key[code[i + 1]], np.zeros(len(i), np.uint64), pair[i], n))
    ready = run.beside & (pair <= step)
    both = np.flatnonzero(ready[1:] & ready[:-1] & counted[2:])
    if len(both):
        # a triple waits for the hash places of its pairs and of its words alike, so that its round has one beginning
        left = place(pair_keys(key[code[both]], key[code[both + 1]]), pair_since)
        right = place(pair_keys(key[code[both + 1]], key[code[both + 2]]), pair_since)
        triple = np.maximum(np.maximum(left, right), np.maximum(pair[both], pair[both + 1])).astype(np.int32)
        use = on(triple)
        at, triple = both[use], triple[use]
        if len(at):
            first, n = _grouped([code[at], code[at + 1], code[at + 2]], len(key))
            i = at[first]
            out.append((key[code[i]], key[code[i + 1]], key[code[i + 2]], triple[first], n))
    return out


def _count_phrases(shard: DataFrame, seed: int, step: int, shards: int, masks) -> DataFrame:
    """w1, w2, w3, since and n of the pairs and triples of a shard that are counted at this scan, partly summed."""
    word_since, pair_since = masks

    def count(batches):
        for lang, run in _runs(batches):
            for w1, w2, w3, since, n in phrase_rows(run, lang, seed, step, shards, word_since.value, pair_since.value):
                yield pa.record_batch([pa.array(w.view(np.int64)) for w in (w1, w2, w3)] + [pa.array(since, pa.int32()), pa.array(n, pa.int64())], names=["w1", "w2", "w3", "since", "n"])

    return shard.mapInArrow(count, _SCAN)


PAIR_KEY = "w1 ^ (shiftleft(w2, 17) | shiftrightunsigned(w2, 47))"


def _places(keys: DataFrame, bits: int) -> np.ndarray:
    """Whether any of the 64-bit ``key`` values falls on each of 2 ** bits hash places; 2 ** (bits - 6) rows at most come to the driver."""
    place = F.expr(f"shiftrightunsigned(key, {64 - bits})")
    words = keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, shards: int = SHARDS, bits: int = MASK_BITS, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): staged tables of all words (w, lang, word, n) and of the pairs (w3 is 0) and triples (w1, w2, w3, n) that come
    at least ``least`` times within pieces, by hash keys of their words."""
    spark = docs.sparkSession
    dealt = stage(_rows_of(docs, text_col, lang_col).withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")), "shards", by="shard")
    words, open_rows, done = None, None, []
    word_since, pair_since = np.full(1 << bits, NEVER, np.uint8), np.full(1 << bits, NEVER, np.uint8)
    step, last = 0, shards  # words may become active up to scan ``shards``
    while step < last or step < shards:
        shard = dealt.where(F.col("shard") == step % shards).select("lang", "text")
        if (word_since <= step).any():
            masks = spark.sparkContext.broadcast(word_since), spark.sparkContext.broadcast(pair_since)
            rows = _count_phrases(shard, seed, step, shards, masks)
            rows = rows if open_rows is None else rows.unionByName(open_rows)
            # a phrase whose round ends with this scan is complete
            open_now = F.col("since") + shards > step + 1
            counted = rows.groupBy("w1", "w2", "w3", "since").agg(F.sum("n").alias("n")).withColumn("open", open_now).where((F.col("n") >= least) | F.col("open"))
            counted = stage(counted, "counted", by="open")
            for m in masks:
                m.destroy()
            unstage(open_rows)
            done.append(counted.where("not open").select("w1", "w2", "w3", "n"))
            open_rows = counted.where("open").drop("open")
            open_rows._staged_at = f"{counted._staged_at}/open=true"
            hit = _places(counted.where((F.col("w3") == 0) & (F.col("n") >= least)).select(F.expr(PAIR_KEY).alias("key")), bits)
            pair_since[hit & (pair_since == NEVER)] = step + 1
        if step < shards:
            new = _count_words(shard, seed)
            before, words = words, stage(new if words is None else new.unionByName(words).groupBy("w", "lang", "word").agg(F.sum("n").alias("n")), "words")
            unstage(before)
            hit = _places(words.where(F.col("n") >= least).select(F.col("w").alias("key")), bits)
            word_since[hit & (word_since == NEVER)] = step + 1
        step += 1
        begun = np.concatenate([word_since[word_since != NEVER], pair_since[pair_since != NEVER]])
        last = int(begun.max()) + shards if len(begun) else shards
    unstage(dealt, open_rows)
    if words.groupBy("w").count().where("count > 1").limit(1).count():
        unstage(words)
        return phrase_counts(docs, text_col=text_col, lang_col=lang_col, least=least, shards=shards, bits=bits, seed=seed + 1)
    phrases = done[0] if done else spark.createDataFrame([], "w1 long, w2 long, w3 long, n long")
    for more in done[1:]:
        phrases = phrases.unionByName(more)
    return words, phrases


def _score(a: str, left: str, right: str):
    top, below = (" * ".join(f"cast({x} as decimal({d},0))" for x, d in f) for f in (((10**6, 7), (a, 15), (a, 15)), ((left, 15), (right, 15))))
    return F.expr(f"({top}) div ({below})")


def mine_phrases(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, cover_percent: int = 50, top: int = 2000, shards: int = SHARDS, bits: int = MASK_BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best ``top`` phrases of two and three words.

    A phrase's score is floor(10**6 a a / (l r)) at its worst cut into two parts that come l and r times; a pair goes if a triple
    that holds it comes at least ``cover_percent`` as often. Null languages are one, ``und``; null texts count as empty; repeated rows
    count each time; very long texts are counted whole; ties of score and count go by the phrase's bytes. An empty table, or one
    without frequent phrases, gives no rows. Only the two named columns are read."""
    words, phrases = phrase_counts(docs, text_col=text_col, lang_col=lang_col, least=least, shards=shards, bits=bits)
    known = words.where(F.col("n") >= least)
    side = lambda k: known.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"))
    pairs = phrases.where("w3 = 0").select("w1", "w2", F.col("n").alias("a"))
    triples = phrases.where("w3 <> 0").select("w1", "w2", "w3", F.col("n").alias("a"))
    inner = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = inner.groupBy("w1", "w2").agg(F.max("a").alias("longest"))
    kept = pairs.join(longer, ["w1", "w2"], "left").where(f"longest is null or 100 * longest < {cover_percent} * a")
    named = known.select(F.col("w").alias("w1"), "lang")
    two = kept.join(side(1), "w1").join(side(2), "w2").select(
        "w1", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"), _score("a", "n1", "n2").alias("score")
    )
    head = pairs.select("w1", "w2", F.col("a").alias("n12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("n23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(side(1), "w1").join(side(2), "w2").join(side(3), "w3")
    three = three.withColumn("s1", _score("a", "n1", "n23")).withColumn("s2", _score("a", "n12", "n3")).withColumn("one", F.col("s1") <= F.col("s2"))
    cut = lambda x, y, name: F.when(F.col("one"), F.col(x)).otherwise(F.col(y)).alias(name)
    three = three.select("w1", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", cut("n1", "n12", "l"), cut("n23", "n3", "r"), cut("s1", "s2", "score"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    found = two.unionByName(three).join(named, "w1").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    heads = found.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    best = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Classifiers, language model, top-k search and URL filter against plain versions or held-out accuracy."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from strandlab.llm import lm_score as M
from strandlab.llm import quality as Q
from strandlab.llm import topk_search as K
from strandlab.llm import toxicity as X
from strandlab.llm import url_filter as U
from strandlab.llm.common import crc_bucket

EXTRA = "doc_id long, text string, score string, stats int, pid int"


def docs_frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], EXTRA).repartition(3)


def test_isotonic_pools_violators():
    x, y = Q.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 2, 1, 4]), np.array([2.0, 2, 2, 4]))
    assert list(x) == [0, 0, 1, 2, 3, 3] and list(y) == [0, 0, 0.75, 0.75, 1, 1]


def test_quality_separates_junk(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word() for _ in range(60)) + "." if i % 2 else " ".join(["###"] * 30 + [word().upper()] * 9)) for i in range(400)]
    odd = [(900, None), (901, ""), (902, "x" * 200_000), (None, "text of no id"), (3, rows[3][1])]
    docs = docs_frame(spark, rows + odd)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit_quality(Q.training_rows(Q.statistics_table(docs), labels, crc_bucket("doc_id", 4) != 2, "quality"))
    got = Q.with_quality(docs, model, score_col="score").collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all((r.score >= 0.7) == (r.doc_id % 2 == 1) for r in held)
    assert Q.fit_quality(Q.training_rows(Q.statistics_table(docs), labels.limit(0), crc_bucket("doc_id", 4) != 2, "quality")) is None
    assert Q.with_quality(docs.limit(0), model).count() == 0


def plain_statistics(text):
    data = (text or "").encode()
    if not data:
        return [0.0] * len(Q.STATISTICS)
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [x.rstrip(b"\n") for x in re.findall(rb"[^\n]*\n|[^\n]+", data) if len(x) > 1]
    has = lambda chars: sum(x in chars for x in data)
    least, marks = max(len(words), 1), bytes(x for x in range(33, 127) if not chr(x).isalnum() and x not in b".,")
    return [
        math.log1p(len(data)), math.log1p(len(words)), len(data) / least, has(bytes(range(65, 91))) / len(data), has(b"0123456789") / len(data), has(marks) / least,
        has(b".,") / least, has(bytes(range(128, 256))) / len(data), (data.count(b"\n") + 1) / least, len(set(words)) / least**0.85,
        max(collections.Counter(words).values(), default=0) / least, sum(x == y for x, y in zip(words, words[1:])) / least, has(b"!") / least,
        math.log1p(len(words) / (has(b".!?") + 1)), (len(lines) - len(set(lines))) / max(len(lines), 1), has(b" ") / len(data),
        sum(len(w) > 18 for w in words) / least, has(b"#$%&*@^~|<>{}[]\\/_=+") / least,
    ]


def test_statistics_against_plain_counts(monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "b c", " ", "\n", "\n\n", "Zé", "9", "!", "?", ".", ",", "#", "word word ", "x" * 20, "same line\n"]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += ["", None, "\n", "a", "a\na\na", "!!!", " \t\r\n", "word " * 20_000]
    for limit in (1 << 21, 100):
        monkeypatch.setattr(Q.text_runs, "__defaults__", (limit,))
        assert np.allclose(Q.statistics(pa.array(texts, pa.string())), [plain_statistics(t) for t in texts])


def test_quality_weights_are_those_of_direct_ridge(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, len(Q.STATISTICS))) * rng.uniform(0.5, 4, len(Q.STATISTICS)) + 3
    y = (x[:, 0] + 0.5 * np.sin(x[:, 1]) + rng.normal(size=700) > 3).astype(int)
    train = spark.createDataFrame([(r.tolist(), int(k)) for r, k in zip(x, y)], "stats array<double>, label int").repartition(4)
    model = Q.fit_quality(train)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0))
    z = model.features(x)
    penalty = Q.RIDGE * len(x) * np.eye(z.shape[1]) / z.shape[1]
    penalty[-1, -1] = 1e-9
    assert np.allclose(z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), z @ model.weight, atol=1e-5)
    unit = (x[:40] - model.mean) / model.scale
    distance = ((unit[:, None] - unit[None]) ** 2).sum(2)
    near = z[:40, :-1] @ z[:40, :-1].T
    near = near / near[0, 0] if near[0, 0] else near
    assert np.abs(near - np.exp(-distance / (2 * Q.WIDTH**2))).max() < 0.25
    raw = np.rint((np.clip(model.raw(x), -1, 2) + 1) * Q.GRID) / Q.GRID - 1
    # the best monotone fit: at each place the largest over starts of the least mean over ends
    order = np.argsort(raw, kind="stable")
    grid, at = np.unique(raw, return_inverse=True)
    ones, n = np.bincount(at, y), np.bincount(at)
    mean = lambda i, j: ones[i : j + 1].sum() / n[i : j + 1].sum()
    some = range(0, len(grid), max(1, len(grid) // 25))
    want = [max(min(mean(i, j) for j in range(k, len(grid))) for i in range(k + 1)) for k in some]
    assert np.allclose(np.interp(grid[list(some)], model.step_x, model.step_y), want) and len(order) == 700


def plain_kernel(s, t, order, decay):
    def places(w):
        out = collections.defaultdict(float)

        def grow(chosen, start):
            if len(chosen) == order:
                out["".join(w[i] for i in chosen)] += decay ** (chosen[-1] - chosen[0] + 1)
                return
            for i in range(start, len(w)):
                grow(chosen + [i], i + 1)

        grow([], 0)
        return out

    a, b = places(s), places(t)
    return sum(v * b[k] for k, v in a.items())


def test_kernel_counts_gapped_subsequences():
    rng = random.Random(8)
    marks = [b"idiot", b"moron", "r\u00e9\u00ea".encode(), b"scum"]
    words = [b"idiot", b"idxiot", b"toidi", b"abcabc", b"it", b"", b"scumidiotscum"] + [bytes(rng.choice(b"idotmrnsc") for _ in range(rng.randint(1, 20))) for _ in range(60)]
    got = X.Kernel(marks).similarities(words)
    plain = lambda w, m: plain_kernel(w.decode("latin-1"), m.decode("latin-1"), X.ORDER, X.LAMBDA)
    for w, row in zip(words, got):
        for m, k in zip(marks, row):
            assert math.isclose(k, min(1.0, plain(w, m) / plain(m, m)), rel_tol=1e-9, abs_tol=1e-12)
    gram = X.gram_matrix(marks)
    assert np.allclose(gram, [[plain(a, b) / math.sqrt(plain(a, a) * plain(b, b)) for b in marks] for a in marks])


def test_features_are_the_worst_words_of_sentences():
    model = X.ToxicModel([b"idiot", b"moron"], 2, np.eye(2))
    texts = ["An IDIOT here. Nothing of it! a mo-ron, i d i o t. " + "x" * 3000, None, "", "m o r o n", "idi ot mo ron", "y" * 70 + "idiot" + "z" * 40]
    def plain(sentence):
        runs = [w for w in re.findall(r"(?:(?<=\s)|^)(?:\w(?: (?=\w(?:\W|$)))?){3,}", sentence)]
        words = [re.sub(r"[^0-9a-z\x80-\xff]", "", w) for w in sentence.split()] + [r.replace(" ", "") for r in runs if re.fullmatch(r"(\w )+\w?", r)]
        pieces = [p for w in words for p in X.stretches(w.encode())]
        value = model.kernel.similarities(pieces) if pieces else np.zeros((0, 2))
        value = value[(value >= X.FLOOR).any(1)]
        return value.max(0) if len(value) else None
    want = [(t, *v) for t, text in enumerate(texts) for x in re.split(r"(?<=[.!?\n])", (text or "").lower()) if (v := plain(x.strip())) is not None]
    got = [(int(r + t), *v) for r, text, sims in X.sentence_features(model, pa.array(texts, pa.string())) for t, v in zip(text, sims)]
    assert len(got) == len(want) == 4 and np.allclose(sorted(got), sorted(want))


def test_held_out_labels_teach_nothing(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abeghklnru") for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word() for _ in range(8)) + (" pathetic idiot" if i % 4 == 0 else " ###" * (i % 3))) for i in range(320)]
    docs = docs_frame(spark, rows)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    given = [(i, int(i % 3 != 0), int(i % 4 == 0)) for i, _ in rows]
    others = [
        [(i, 1 - q, 1 - t) if i in held else (i, q, t) for i, q, t in given], [r for r in given if r[0] not in held], given + [(i, 1, 1) for i in held for _ in range(5)], [(i, None, None) if i in held else (i, q, t) for i, q, t in given],
    ]

    def scores(rows):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        quality = Q.fit_quality(Q.training_rows(Q.statistics_table(docs), labels, crc_bucket("doc_id", 4) != 2, "quality"))
        toxic = X.fit_toxicity(docs, labels)
        return [sorted(map(tuple, f.collect())) for f in (Q.with_quality(docs, quality, score_col="score").select("doc_id", "score"), X.with_toxicity(docs, toxic, score_col="score").select("doc_id", "score"))]

    first = scores(given)
    assert len(held) > 40 and len({s for _, s in first[1]}) > 1
    for changed in others:
        quality, toxic = scores(changed)
        assert toxic == first[1]  # to the last bit
        # sums of partitions come in any order, so the last bits of a ridge fit may differ
        assert [d for d, _ in quality] == [d for d, _ in first[0]] and np.allclose([s for _, s in quality], [s for _, s in first[0]], rtol=0, atol=1e-7)


def test_toxicity_tolerates_inserted_characters(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abeghklnru") for _ in range(rng.randint(2, 7)))
    sentence = lambda extra=None: " ".join([word() for _ in range(5)] + ([extra] if extra else []) + [word() for _ in range(4)]) + "."
    bad = ["pathetic", "idiot", "moron"]
    rows = [(i, " ".join(sentence(bad[i % 3] if i % 5 == 0 and k == 1 else None) for k in range(4))) for i in range(500)]
    odd = [(901, sentence("p.a.t.h.e.t.i.c")), (902, sentence("idxiot")), (903, sentence("m o r o n")), (904, sentence()), (905, None), (906, ""), (None, sentence("idiot"))]
    docs = docs_frame(spark, rows + odd)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(500)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    model = X.fit_toxicity(docs, labels)
    assert {b"pathetic", b"idiot", b"moron"} <= set(model.landmarks)
    got = {r.doc_id: r.toxicity for r in X.with_toxicity(docs, model).collect()}
    assert all((got[i] >= 0.3) == (i % 5 == 0) for i in range(500))
    assert all(got[i] >= 0.3 for i in (901, 902, 903, None)) and all(got[i] < 0.3 for i in (904, 905, 906))
    assert X.fit_toxicity(docs.limit(0), labels) is None and X.with_toxicity(docs, None).where("toxicity = 0").count() == len(got)


def plain_evidence(model, text):
    """Worst sentence's margin, number and share of words like a landmark, with the kernel by its definition."""
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = [(m.start(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    plain = lambda w, m: plain_kernel(w.decode("latin-1"), m.decode("latin-1"), X.ORDER, X.LAMBDA)
    own = [plain(m, m) for m in model.landmarks]
    sims = lambda w: np.max([[min(1.0, plain(p, m) / o) for m, o in zip(model.landmarks, own)] for p in X.stretches(w)], axis=0)
    found = [(data[:at], sims(re.sub(rb"[^0-9a-z\x80-\xff]", b"", w))) for at, w in words]
    single = [bool(re.fullmatch(rb"[0-9a-z\x80-\xff][^0-9a-z\x80-\xff]?", w)) for _, w in words]
    for i, one in enumerate(single):
        n = (single[i:] + [False]).index(False)
        if one and n >= X.ORDER and not (i and single[i - 1]):
            found.append((data[: words[i][0]], sims(b"".join(w[:1] for _, w in words[i : i + n]))))
    worst, many = {None: np.zeros(len(model.landmarks))}, 0.0
    for before, value in found:
        if max(value[: model.toxic]) >= X.FLOOR:
            sentence = len(re.findall(rb"[.!?\n]", before))
            worst[sentence] = np.maximum(worst.get(sentence, 0), value)
            many += min(max(2 * max(value[: model.toxic]) - 1, 0), 1)
    return [max(float(v @ model.whiten @ model.weight + model.bias) for v in worst.values()), math.log1p(many), 30 * math.sqrt(many / (100 + len(data)))]


def test_toxicity_scores_against_plain_kernels(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abeghklnru") for _ in range(rng.randint(1, 6)))
    long = "unspeakablyhorriblenincompoopery" * 2
    bad = ["moron", "idiot", long]
    rows = [(i, ". ".join(" ".join([word() for _ in range(4)] + [bad[i % 3]] * (i % 5 == 0 and k == 1) + [word() for _ in range(3)]) for k in range(2))) for i in range(300)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    model = X.fit_toxicity(docs, labels)
    assert max(map(len, model.landmarks)) == X.LONGEST and math.isclose(max(model.kernel.similarities([long.encode()])[0]), 1)
    texts = ["You IDIOT. a mo-ron! i d. i o t here", "m o r o n", "idixot and moroon? fine", "all is well", "", None, long + "s", "the idiot\nidiot idiot"]
    got = {r.doc_id: r.toxicity for r in X.with_toxicity(docs_frame(spark, list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        want = plain_evidence(model, text) @ model.line[:-1] + model.line[-1]
        assert math.isclose(got[i], 1 / (1 + math.exp(-want)), rel_tol=1e-9)
    # at the document line's weights the gradient of the penalised likelihood is none, over the rows that may teach
    known = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    y = np.array([i % 5 == 0 for i, _ in known], float)
    x = np.array([[*plain_evidence(model, t), 1.0] for _, t in known])
    p = 1 / (1 + np.exp(-(x @ model.line)))
    assert np.abs(x.T @ (y - p) - 1e-2 * model.line).max() < 1e-4


def test_support_vectors_have_the_least_loss():
    rng = np.random.default_rng(13)
    x = np.concatenate([rng.normal(size=(80, 6)) + 0.7, rng.normal(size=(120, 6)) - 0.5])
    y = np.repeat([1.0, -1.0], [80, 120])
    weight = rng.uniform(0.5, 2, 200)
    for side in (1, -1):
        weight[y == side] /= weight[y == side].sum()
    w, b = X.support_vectors(x, y, weight)
    loss = lambda w, b: (weight * np.maximum(0, 1 - y * (x @ w + b))).sum() + 1e-3 / 2 * w @ w
    least = loss(w, b)
    # the loss is convex: what no step near or far lowers by a hundredth is the least to about that
    for size in (0.01, 0.1, 0.5, 2.0):
        for _ in range(500):
            step = rng.normal(size=7) * size
            assert loss(w + step[:6], b + step[6]) > least * 0.99


def test_base_scores_and_gain(spark):
    rng = random.Random(5)
    a, b = ["le", "la", "Été", "un"], ["the", "of", "THE", "x1"]
    rows = [(i, rng.choice([" ", "\t", "\n"]).join(rng.choice(a if i % 2 else b) for _ in range(rng.randint(0, 50)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "le the"), (7, rows[7][1]), (902, "fresh words here")]
    got = M.score_texts(docs_frame(spark, rows)).collect()
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    counts = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(d), held(d), len(tokens(t)), sum(w in counts for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for d, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert M.score_texts(docs_frame(spark, [])).count() == 0


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    shape = (M.CLASSES, M.CLASSES)
    model = M.ClassModel(rng.normal(size=shape), rng.normal(size=shape), rng.normal(size=shape), rng.normal(size=(M.PAIRS, M.CLASSES)))
    history, classes = rng.integers(0, M.CLASSES, (3, 50)), rng.integers(0, M.CLASSES, 50)
    assert np.allclose(np.exp(model.log_probabilities(history)).sum(1), 1)
    model.normalise()
    assert np.allclose(model.log_probability(history, classes), model.log_probabilities(history)[np.arange(50), classes])


def test_pair_weights_climb_the_penalised_likelihood():
    rng = np.random.default_rng(4)
    unit = np.repeat(np.arange(6), 5)
    n = rng.integers(0, 9, 30)
    share = rng.dirichlet(np.ones(6), 6)[:, :5].ravel()
    value = M.fit_pairs(unit, share, n)
    has = n >= M.LEAST_PAIRS
    for u in range(6):
        mine = unit == u
        q, k, active = share[mine], n[mine], has[mine]

        def loss(w, q=q, k=k, active=active):
            full = np.where(active, w, 0.0)
            norm = 1 + (q * np.expm1(full)).sum()
            return (k * (full + np.log(q) - np.log(norm))).sum() - (full**2).sum() / (2 * M.VARIANCE), norm, full

        # the normaliser makes all words of the part, those without any pair too, sum to one
        rest = value[mine][~active][0] if (~active).any() else None
        best = value[mine] - (rest if rest is not None else 0)
        if rest is not None:
            assert np.isclose((q * np.exp(value[mine])).sum() + (1 - q.sum()) * np.exp(rest), 1)
            top, norm, _ = loss(best)
            assert np.isclose(-np.log(norm), rest)
            for step in rng.normal(size=(50, 5)) * 0.1:
                assert loss(best + step)[0] <= top + 1e-6
    assert np.allclose(M.fit_pairs(np.zeros(3, int), np.full(3, 0.1), np.array([0, 1, 1])), 0) and not len(M.fit_pairs(np.zeros(0, int), np.zeros(0), np.zeros(0)))


def test_pairs_are_of_near_rare_words():
    texts = ["a b the c", "the b the the the d e"]
    offsets = np.cumsum([0, *map(len, texts)])
    t = M.Tokens(offsets, np.frombuffer("".join(texts).encode(), np.uint8))
    names = ["a", "b", "the", "c", None, "the", "b", "the", "the", "the", "d", "e", None]
    classes = np.array([0 if w in ("the", None) else M.OWN for w in names])
    counts = np.array([1 if w == "d" else 9 for w in names])
    at, keys = M.word_pairs(t, classes, counts)
    assert at.tolist() == [1, 3]  # b after a, c after b; d is four after b, e follows a word seen once
    assert all(k == (t.hash[u] >> np.uint64(32) << np.uint64(32)) | (t.hash[w] >> np.uint64(32)) for k, (u, w) in zip(keys, [(0, 1), (1, 3)]))


def test_repeated_phrases_beat_word_counts(spark):
    rng = random.Random(6)
    names = [f"w{rng.randint(0, 10**6)}x" for _ in range(600)]
    phrase = rng.sample(names, 60)
    rows = [(i, " ".join(rng.choice(names) for _ in range(80)) + " " + " ".join(phrase)) for i in range(120)]
    score = {r.doc_id: r for r in M.score_texts(docs_frame(spark, rows)).collect()}
    out = [r for r in score.values() if r.held_out]
    assert sum(r.score - r.base_score for r in out) / len(out) > 40  # decimal digits for 60 known successions


def test_scores_against_plain_products_of_shares(spark, monkeypatch):
    """Every text's score, word by word in dictionaries, from the fitted class weights; summaries meet two by two."""
    rng = random.Random(9)
    frequent, names = [f"f{i}" for i in range(40)], [f"n{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(frequent if rng.random() < 0.6 else names) for _ in range(rng.randint(0, 60)))) for i in range(150)] + [(900, None)]
    whole = {r.doc_id: r.score for r in M.score_texts(docs_frame(spark, rows)).collect()}
    kept, fit = [], M._fit_classes
    monkeypatch.setattr(M, "_fit_classes", lambda grams: kept.append(fit(grams)) or kept[-1])
    monkeypatch.setattr(M, "FAN_IN", 2)
    got = {r.doc_id: r.score for r in M.score_texts(docs_frame(spark, rows)).collect()}
    assert all(math.isclose(got[d], whole[d], rel_tol=1e-9) for d in whole)
    (model,) = kept
    words = {d: [*(t or "").split(), None] for d, t in rows}
    train = [w for d, w in words.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = collections.Counter(w for t in train for w in t)
    known = {w: M.Tokens(np.array([0, len(w)]), np.frombuffer(w.encode(), np.uint8)) for t in words.values() for w in t if w}
    own = [None, *sorted((w for w in counts if w), key=lambda w: (-counts[w], int(known[w].hash[0])))][: M.OWN]
    kind = lambda w: own.index(w) if w in own else int(known[w].ending[0])
    total = collections.Counter({c: 1 for c in range(M.CLASSES)})
    for w, n in counts.items():
        total[kind(w)] += n + 1

    def pair(text, i):
        back = next((j for j in range(i - 1, -1, -1) if text[j] not in own), None)
        return (text[back], text[i]) if text[i] not in own and back is not None and i - back <= M.BACK and counts[text[back]] >= M.LEAST_PAIRS else None

    pairs = collections.Counter(p for t in train for p in (pair(t, i) for i in range(len(t))) if p)
    units = collections.defaultdict(list)
    for p in sorted(pairs):
        units[p[0], kind(p[1])].append(p)
    value, rest = {}, {}
    for unit, members in units.items():
        # one more that never occurs bears the normaliser alone
        share = np.array([(counts[w] + 1) / total[unit[1]] for _, w in members] + [0.0])
        fitted = M.fit_pairs(np.zeros(len(share), int), share, np.array([pairs[p] for p in members] + [0]))
        value.update(zip(members, fitted))
        rest[unit] = fitted[-1]
    for d, text in words.items():
        history, score = [0, 0, 0], 0.0
        for i, w in enumerate(text):
            a, b, c = history
            z = model.one[a] + model.two[b] + model.three[c] + model.pair[int(M.ClassModel.slot(np.array([a]), np.array([b]))[0])]
            score += z[kind(w)] - np.log(np.exp(z).sum())
            if w not in own:
                score += math.log((counts[w] + 1) / total[kind(w)])
                p = pair(text, i)
                score += value.get(p, rest.get((p[0], kind(w)), 0.0)) if p else 0.0
            history = [kind(w), a, b]
        assert math.isclose(got[d], score / math.log(10), rel_tol=1e-5, abs_tol=1e-5)
    assert any(pairs[p] >= M.LEAST_PAIRS for p in pairs)


def test_class_updates_are_those_of_a_dense_model(spark):
    rng = np.random.default_rng(3)
    code = np.unique(rng.integers(0, M.CLASSES**4, 3000) % (M.CLASSES**2 * 5))
    n = rng.integers(1, 20, len(code))
    model = M._fit_classes(spark.createDataFrame([(int(c), int(k)) for c, k in zip(code, n)], "gram long, n long").repartition(3))
    target, a, b, c = (code // M.CLASSES**k % M.CLASSES for k in range(4))
    bigrams = np.zeros((M.CLASSES, M.CLASSES))
    np.add.at(bigrams, (a, target), n)
    backoff = (bigrams.sum(0) + 0.5) / (n.sum() + 0.5 * M.CLASSES)
    weights = [np.log((bigrams + 8 * backoff) / (bigrams.sum(1, keepdims=True) + 8)), *(np.zeros((s, M.CLASSES)) for s in (M.CLASSES, M.CLASSES, M.PAIRS))]
    places = (a, b, c, M.ClassModel.slot(a, b))
    likelihood = []
    for _ in range(M.UPDATES + 1):
        p = np.exp(sum(w[at] for w, at in zip(weights, places)))
        p /= p.sum(1, keepdims=True)
        likelihood.append((n * np.log(p[np.arange(len(n)), target])).sum())
        expected = n[:, None] * p
        residual = n[:, None] * np.eye(M.CLASSES)[target] - expected
        before = weights
        weights = []
        for k, (w, at) in enumerate(zip(before, places)):
            grad, curve = np.zeros_like(w), np.zeros_like(w)
            np.add.at(grad, at, residual)
            np.add.at(curve, at, expected)
            weights.append(w + M.DAMPING * np.clip(grad / (curve + 10), -2, 2) * (0.7 if k else 1))
    assert all(np.allclose(x, y) for x, y in zip((model.one, model.two, model.three, model.pair), before))
    assert likelihood == sorted(likelihood)


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 64)
    monkeypatch.setattr(K, "GROUP_QUERIES", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(400)] + [(400 + i, [0.5] * 6) for i in range(120)]
    odd = [(1000, None), (1001, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (None, [1.0] * 6), (1050, [0.3, -0.2])]
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows + odd], "vec_id long, embedding array<float>, cell string, score int")
    got = sorted(tuple(r) for r in K.top_k(df).collect())
    ints = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in [*rows, odd[-1]]}
    want = []
    for q in ints:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(ints[q], ints[c])), c) for c in ints if c != q)[:5]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert got == sorted(want)
    assert K.top_k(df.limit(0)).count() == 0


def best_rows(rows, modulus, k=5):
    ints = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows]
    out = []
    for q, v in {(i, tuple(v)) for i, v in ints if i % modulus == 0}:
        best = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), c) for c, w in ints if c != q)[:k]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def test_scores_beyond_doubles_and_repeated_rows(spark):
    rows = [(0, [1e7, 1.0]), (1, [1e7, 1.0 + 1 / 256]), (2, [1e7, 1.0 + 2 / 256]), (3, [1e30, 1.0]), (4, [-1e30, 2.0]), (5, [0.0, 0.0]), (6, [3.0]), (7, [])]
    rows += [(9, [1.0, 2.0])] * 4 + [(20, [0.5, 0.25])] * 3 + [(10, [1e7, 3.0]), (30, [-1e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(tuple(r) for r in K.top_k(df, query_modulus=10).collect()) == best_rows(rows, 10)


def test_clusters_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 100)
    monkeypatch.setattr(K, "GROUP_QUERIES", 10)
    seen = []
    dealt = K._needs
    monkeypatch.setattr(K, "_needs", lambda *a: seen.append((dealt(*a).collect(), int((a[2][0] + a[2][1]).max()))) or dealt(*a))
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(12, 16)) * 4
    rows = [(i, (middle[i % 12] + rng.normal(size=16) * 0.1).tolist()) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in K.top_k(df, query_modulus=20).collect())
    assert got == best_rows([(i, np.array(v, np.float32)) for i, v in rows], 20)
    (pairs, blocks), = seen
    groups = len({r.grp for r in pairs})
    assert groups > 5 and blocks > 12 and len(pairs) < groups * blocks / 3


def test_url_parts_and_rules(spark):
    urls = ["https://A.Example.NET/en/5?x#y", "http://example.com/de/1", "x.org/fr/2", None, "http://m.a.org/fr/3.html", "ftp://HOST?q", "http://org/fr/", "http://a.example.com/DE/1", "http://b.net#t", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(pages, labels).collect()}
    assert got == {
        0: ("a.example.net", "/en/5", "example.net/en/", "allow"), 1: ("example.com", "/de/1", "example.com/de/", "block"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("m.a.org", "/fr/3.html", "org/fr/", "allow"), 5: ("host", "", None, "allow"), 6: ("org", "/fr/", "org/fr/", "allow"), 7: ("a.example.com", "/DE/1", None, "allow"),
        8: ("b.net", "", None, "allow"), 9: ("b:", "//c/d", None, "allow"),
    }
    assert U.filter_urls(pages.limit(0), labels).count() == 0


def test_bad_templates_are_rejected(spark):
    rows = [(i, f"http://a.com/{'spam' if i % 2 else 'news'}/{'w%d' % i if i % 3 else 'page%d' % i}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(0, 400) if i % 5], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.filter_urls(pages, labels).collect()}
    assert all((got[i] == "block") == (i % 2 == 1) for i, _ in rows)


def test_large_bad_branch_among_many_rare_ones(spark):
    rows = [(i, "http://a.com/casino/x") for i in range(300)] + [(300 + i, f"http://a.com/{chr(97 + i % 26)}{chr(97 + i // 26)}/x") for i in range(400)]
    rows += [(700 + i, "http://a.com/shop/x") for i in range(300)]  # frequent and as bad as the whole host
    bad = lambda i: i < 300 or (i >= 700 and i % 10 < 4)
    labels = spark.createDataFrame([(i, int(not bad(i)), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()}
    assert all((got[i].verdict == "block") == (i < 300) for i, _ in rows)
    assert got[0].tree_node.startswith("/casino") and got[700].tree_node.startswith("/~") and got[300].tree_node.startswith("/*")


def test_rules_do_not_judge_other_pages(spark):
    rows = [(i, f"http://www.site.net/{i}") for i in range(500)] + [(500 + i, f"http://b.com/news/{i}") for i in range(40)] + [(600 + i, f"http://c.com/x/{i}") for i in range(20)]
    rows += [(700 + i, f"http://org/fr/{i}") for i in range(30)] + [(800 + i, f"http://org/{i}") for i in range(15)]  # bad pages beside allowed ones
    labels = spark.createDataFrame([(i, int(not (i < 500 or i >= 800)), 0) for i, _ in rows if not 600 <= i < 620], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()}
    assert all((got[i] == "block") == (i < 500 or i >= 800) for i, _ in rows)


def test_landmarks_explain_documents_and_not_copies(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abeghklnru") for _ in range(rng.randint(2, 7)))
    text = lambda *extra: " ".join(rng.sample([*extra, *(word() for _ in range(40))], 40 + len(extra)))
    bad = [(i, text("pathetic") if i % 10 else text("zzyzzy", "zzyzzy")) for i in range(120)]
    copy = text("moron") + " quartz"
    bad += [(200 + i, copy.replace(copy.split()[i % 30], word())) for i in range(60)]
    rows = bad + [(500 + i, text()) for i in range(300)]
    labels = spark.createDataFrame([(d, 1, int(d < 500)) for d, _ in rows], "doc_id long, quality int, toxic int")
    model = X.fit_toxicity(docs_frame(spark, rows), labels)
    assert {b"pathetic", b"zzyzzy"} <= set(model.landmarks[: model.toxic]) and b"quartz" not in model.landmarks and len(model.landmarks) < 12
    row = collections.namedtuple("row", "unit doc")
    rows = [row(b"common%c" % (97 + k), d) for k in range(20) for d in range(6000) if d % 25 == k] + [row(b"tail", d) for d in (5999, 5974)] + [row(b"lone", 24)]
    assert set(X._cover(rows)) == {r.unit for r in rows} - {b"lone"}

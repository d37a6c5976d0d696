"""Suffix dedup against a plain dictionary of all 50-byte strings."""

import hashlib
import random

import numpy as np

from strandlab.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, pid string, bucket int"


def plain(rows, length=50):
    least = {}
    for doc, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1) if doc is not None else ():
            w = b[i : i + length]
            least[w] = min(least.get(w, doc), doc)
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1) if doc is not None else ():
            if least[b[i : i + length]] < doc:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    line = " ".join(word() for _ in range(20))
    base = " ".join(word() for _ in range(120))
    rows = []
    for i in range(60):
        body = " ".join(word() for _ in range(rng.randint(0, 90)))
        if i % 3 == 0:
            body += line + word()
        if i % 4 == 0:
            cut = base.split(" ")
            for _ in range(rng.randint(0, 4)):
                cut[rng.randrange(len(cut))] = word()
            body = " ".join(cut) + word()
        rows.append((i * 7 % 61 - 5, body))
    rows += [(100, base), (101, base), (101, base), (None, base), (None, ""), (102, None), (103, ""), (104, "a" * 400), (105, "b" + "a" * 120), (106, base[:50]), (107, base[:49])]
    return rows


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    got = S.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_matches_plain_dictionary(spark):
    check(spark, corpus())


def test_hot_anchors_are_compared_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 4)
    rows = corpus()
    tables = [tuple(r) for r in rows]
    import pyarrow as pa

    buckets, batches = 2, 3
    parts = [[r for k, r in enumerate(tables) if (r[0] or 0) % batches == p] for p in range(batches)]
    docs = [pa.table({"doc_id": pa.array([r[0] for r in p], pa.int64()), "text": pa.array([r[1] for r in p], pa.string())}) for p in parts]
    split = lambda ts, col, n: [pa.concat_tables(ts).filter(pa.compute.equal(pa.concat_tables(ts)[col], k)) for k in range(n)]
    anchors = split([S.anchor_messages(d, k, buckets, 50, 20) for k, d in enumerate(docs)], "bucket", buckets)
    shared = split([S.shared_anchors(t) for t in anchors], "pid", batches)
    contexts = split([S.context_messages(d, a, k, buckets, 50, 20) for k, (d, a) in enumerate(zip(docs, shared))], "bucket", buckets)
    answers = split([S.least_documents(t, 50) for t in contexts], "pid", batches)
    got = pa.concat_tables([S.mark(d, a, 50, 20, False) for d, a in zip(docs, answers)]).to_pylist()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == plain(rows)


def test_long_texts_are_taken_in_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "SLICE", 70)
    rows = [(d, (t or "") * 3) for d, t in corpus() if d is not None]
    docs = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    one = S.shared_anchors(S.anchor_messages(docs, 0, 1, 50, 20))
    got = S.mark(docs, S.least_documents(S.context_messages(docs, one, 0, 1, 50, 20), 50), 50, 20, False).to_pylist()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == plain(rows)


def test_many_rows_without_id_and_clashing_columns(spark):
    rows = corpus() + [(None, t) for _, t in corpus()]
    check(spark, rows)
    names = ["pid_", "_doc", "row", "pid", "kept", "a.b"]
    df = spark.createDataFrame([(d, *range(6), t) for d, t in rows], "doc_id long, " + ", ".join(f"`{n}` int" for n in names) + ", text string").repartition(2)
    got = S.with_repeats_removed(df)
    assert got.columns == df.columns
    want = [(d, *range(6), t) for d, t in ((d, kept(rows, d, t)) for d, t in rows) if t is not False]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def kept(rows, doc, text):
    """What remains of a text, or False if a text has lost all."""
    b = (text or "").encode()
    gone = [False] * len(b)
    for i in range(len(b) - 49) if doc is not None else ():
        if any(d is not None and d < doc and b[i : i + 50] in (t or "").encode() for d, t in rows):
            gone[i : i + 50] = [True] * 50
    return False if b and all(gone) else text and bytes(x for x, g in zip(b, gone) if not g).decode(errors="replace")


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deep_shallow_classes():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[500:700] = text[0:200]
    text[1500:1700] = text[0:200]
    text[1590] = 120
    data = np.concatenate([text, np.zeros(16, np.uint8)])
    position = np.arange(len(text) - 50)
    classes = S.deep_shallow_classes(data, position, np.zeros(len(position), np.int64))
    by = {}
    for p, c in zip(position, classes):
        by.setdefault(bytes(text[p : p + 50]), set()).add(int(c))
    assert all(len(x) == 1 for x in by.values()) and len({min(x) for x in by.values()}) == len(by)

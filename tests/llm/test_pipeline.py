"""The pipeline's stages against plain versions, on a small corpus with odd rows."""

import random
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline as C
from strandlab.llm.queries import tokenizer_path


def write(spark, folder):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeghilmnoprst") for _ in range(rng.randint(2, 8)))
    good = lambda n: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(n)) + "."
    junk = lambda n: " ".join([word().upper() + "!!"] * 3 + ["###"] * n)
    bench = [(i, good(3)) for i in range(4)]
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        rows.append((i, junk(30) if bad else good(rng.randint(3, 12)), "en", f"s{i % 3}", 1))
        labels.append((i, int(not bad), 0))
    near = rows[1][1].split(" ")
    rows += [(300 + k, " ".join([*near[:-1], word()]), "en", "s1", 1) for k in range(3)]
    rows += [(310, rows[2][1], "en", "s1", 1), (311, good(4) + " " + bench[0][1], "en", "s1", 1), (312, good(6) + rows[3][1][:120], "en", "s0", 1), (313, None, None, None, None), (314, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {r[0]: r[1] for r in rows}


def test_stages_take_effect(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, step) in enumerate(C.STAGES):
        docs = step(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out/{k}")
        docs = spark.read.parquet(f"{tmp_path}/out/{k}")
        if k < 4:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
    quality, near, cut, clean = kept
    good = {i for i in range(240) if i % 4}
    assert good <= set(quality) and not {i for i in range(240) if i % 4 == 0} & set(quality)
    assert {1, 2} <= set(near) and not {300, 301, 302, 310} & set(near) and good <= set(near)
    assert cut[312] == texts[312][: -120] and all(cut[i] == texts[i] for i in good)
    assert 311 in cut and 311 not in clean and good <= set(clean)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter({i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in clean.items()})
    got = Counter()
    for r in docs.collect():
        got[r.doc_id] += r.length
    assert got == want


def test_run_returns_the_last_stage(spark, tmp_path):
    write(spark, str(tmp_path))
    assert np.isin(["doc_id", "sequence_id", "offset"], C.run(spark, str(tmp_path)).columns).all()


def test_stages_take_odd_columns_repeated_rows_and_nothing(spark, tmp_path):
    texts = write(spark, str(tmp_path))
    names = ["score", "_score", "contamination", "_text", "text_", "pid", "pid_", "_doc", "row", "hits", "items", "result", "component_id", "n_shingles", "keep", "_id", "stats", "a.b"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id in (1, 2, 313, 314)")).unionByName(docs.where("doc_id = 5").selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars"))
    for k, n in enumerate(names):
        docs = docs.withColumn(n, docs["doc_id"] * 100 + k)
    columns = docs.columns
    for name, step in C.STAGES[:4]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == columns, name
        rows = out.collect()
        assert all(r[n] == (None if r.doc_id is None else r.doc_id * 100 + k) for r in rows for k, n in enumerate(names)), name
        count = Counter(r.doc_id for r in rows)
        assert count[1] == count[2] == 2 and count[3] == 1 and count[None] == 1, name  # whole rows stay, as often as they come
        assert name == "repeated_substrings" or all(r.text == texts.get(r.doc_id, r.text) for r in rows), name
        assert step(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert C.STAGES[4][1](spark, docs.limit(0), str(tmp_path)).count() == 0
    assert C.STAGES[4][1](spark, docs, str(tmp_path)).where("doc_id is null").count() > 0


def cut(rows, length=50):
    """What repeated strings leave of each text; texts that lose all go."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            least[b[i : i + length]] = min(least.get(b[i : i + length], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        if not b or not all(gone):
            out.append((d, t and bytes(x for x, g in zip(b, gone) if not g).decode(errors="replace")))
    return out


def test_whole_pipeline_against_plain_stages(spark, tmp_path):
    from test_decontaminate import plain as contaminated
    from test_jaccard_join import plain as classes
    from tokenizers import Tokenizer

    write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in C.quality(spark, docs, str(tmp_path)).collect()]
    least = {d: c for d, _, c in classes(rows)}
    rows = cut([(d, t) for d, t in rows if least[d] == d])
    bad = {d for d, *_, flag in contaminated(rows, bench, 13) if flag}
    rows = [(d, t) for d, t in rows if d not in bad]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}
    got, fill = {}, {}
    for r in C.run(spark, str(tmp_path)).collect():
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids.tobytes())
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert got == {d: len(x) for d, x in want.items()} and all(n <= 1024 for n in fill.values())

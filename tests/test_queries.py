"""Registered alignment queries against plain versions on small tables."""

import numpy as np

from strandlab.plans import queries as Q

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def sequence(text):
    return "".join("ACGT"[LETTERS.index(c) % 4] for c in (text or "").lower() if c in LETTERS)


def targets(ordinal, seq):
    places = [j for j, b in enumerate(seq, 1) if b == ("G" if ordinal % 2 else "C")]
    return [(j, i) for i, j in enumerate(places[::-1] if ordinal % 2 else places, 1)]


def tables(spark, folder):
    rng = np.random.default_rng(4)
    letters = np.array(list(LETTERS + "XYZ 0.\n"))
    docs = [(i, "".join(rng.choice(letters, n))) for i, n in enumerate([0, 40, 105, 111, 300, 420, 421, 900, 901, 5000, 5001])] + [(11, None)]
    vectors = [(i, rng.normal(size=64).round(3).tolist()) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return docs, vectors


def test_whole_texts_are_exploded_and_placed(spark, tmp_path):
    docs, vectors = tables(spark, tmp_path)
    want, placed = [], []
    for (ordinal, text), (_, vector) in zip(docs, vectors):
        found = targets(ordinal, sequence(text))
        want += [(ordinal, j, i) for j, i in found]
        size = [int(np.floor(abs(float(np.float32(x))) * 1000)) for x in vector]
        called = dict(zip(np.cumsum([x % 4 + 1 for x in size[:32]]).tolist(), [size[2 * i + 1] % 256 for i in range(32)]))
        if max(called) > len(found):
            continue
        for j, i in found:
            code = called.get(i, None if ordinal % 2 == 0 else 0)
            if code is not None and (j <= 100 or j > 110):
                placed.append((ordinal, 1000 + j if j <= 100 else 1007 + j, code))
    assert max(j for _, j, _ in want) > 3000 and max(r for _, r, _ in placed) > 3000
    assert sorted(tuple(r) for r in Q.target_bases(spark, str(tmp_path)).collect()) == sorted(want)
    assert sorted(tuple(r) for r in Q.base_to_ref(spark, str(tmp_path)).collect()) == sorted(placed)

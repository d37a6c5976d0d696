"""Near-duplicate classes against all pairs of plain sets."""

import random
import re

import pytest

from strandlab.llm import jaccard_join as J

SCHEMA = "doc_id long, text string, component string, token int"


def plain(rows):
    sets = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            if a is not None and b is not None and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets)), key=str)


def corpus(seed, extra=True):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "The", "of", "x%d" % rng.randint(0, 300), "É%d" % rng.randint(0, 99)])
    line = " ".join(word() for _ in range(12))
    bases = [[word() for _ in range(rng.randint(3, 120))] for _ in range(8)]
    rows = []
    for i in range(160):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = word()
        if i % 3 == 0:
            w = [word() for _ in range(rng.randint(1, 60))] + [line]
        rows.append((i * 37 % 211, rng.choice([" ", "\n", "\t "]).join(w)))
    if extra:
        rows += [(300, ""), (301, None), (302, " \n "), (None, rows[0][1]), (303, rows[0][1]), (303, rows[0][1]), (304, "one"), (305, "ONE "), (306, "two words"), (307, "word " * 300)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], SCHEMA).repartition(3)
    got = J.near_duplicate_classes(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_one_id_with_several_texts_and_no_stars(spark, monkeypatch):
    monkeypatch.setattr(J, "STAR_ROUNDS", 0)
    rows = corpus(3)
    rows += [(5, rows[10][1]), (5, rows[11][1])]
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], SCHEMA)
    got = J.near_duplicate_classes(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain(rows)


def test_empty_table(spark):
    assert J.near_duplicate_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_text_of_an_id_is_searched(spark):
    rng = random.Random(7)
    text = lambda: [f"w{rng.randint(0, 10**6)}" for _ in range(80)]
    rows = []
    for i in range(20):
        texts = [text() for _ in range(4)]
        rows += [(i, " ".join(t)) for t in texts]
        rows += [(100 + 10 * i + k, " ".join([*t[:-1], "other"])) for k, t in enumerate(texts)]  # near
        rows += [(500 + 10 * i, " ".join(texts[2]))]  # equal
    rows += [(0, ""), (None, rows[0][1]), (3, rows[12][1]), (4, None)]
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], SCHEMA).repartition(3)
    got = J.near_duplicate_classes(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain(rows)


def test_a_large_component_meets_others_without_meeting_itself(spark):
    import time

    members = spark.range(20_000).selectExpr("7L token", "id doc_id", "100L n", "1 ell", "100 rest", "0L comp")
    others = spark.createDataFrame([(7, 50_000 + k, n, 1, 100, 50_000 + k) for k, n in enumerate((100, 90, 20))], "token long, doc_id long, n long, ell int, rest int, comp long")
    begin = time.monotonic()
    pairs = J._met_pairs(members.unionByName(others), 75)
    # two fit in size: each with all members and with one another; the third is too small for any
    assert pairs.count() == 2 * 20_000 + 1 and time.monotonic() - begin < 60
    joins = [x for x in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert any("comp_a" in x and "comp_b" in x and "<" in x and "doc_id" not in x for x in joins) and not any("doc_id_a" in x and "<" in x for x in joins)

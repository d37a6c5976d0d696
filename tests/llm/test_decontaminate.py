"""Decontamination against plain scanning of words."""

import random
import re

import pytest

from strandlab.llm import decontaminate as D


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, bench, size):
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for item, btext in bench:
            v = words(btext)
            if item is None or not v:
                continue
            wins = [v] if len(v) < size else [v[i : i + size] for i in range(len(v) - size + 1)]
            for x in wins:
                for i in range(len(w) - len(x) + 1):
                    if w[i : i + len(x)] == x:
                        hit.update(range(i, i + len(x)))
                        items.add(item)
        out.append((doc, len(w), len(hit), len(items), D.sha_of(list(items)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, bench, **kw):
    left = spark.createDataFrame([(d, t, "x", 3) for d, t in docs], "doc_id long, text string, contamination string, item_id int")
    right = spark.createDataFrame([(i, t, "y") for i, t in bench], "item_id long, text string, doc_id string")
    out = D.find_contamination(left, right, keep=["doc_id"], **kw)
    c = out["contamination"]
    return sorted((tuple(r) for r in out.select("doc_id", c["n_words"], c["n_hit"], c["n_items"], D.item_digest(c["items"]), D.contaminated(c)).collect()), key=str)


def data(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "of", "Öl", "été", "x9", "the", "longerword", "z" * 30, "7"]
    text = lambda n: rng.choice([" ", ", ", "\n-"]).join(rng.choice(vocabulary) for _ in range(n))
    bench = [(i, text(rng.choice([1, 2, 5, 13, 14, 25]))) for i in range(9)] + [(20, None), (21, ""), (None, "a of"), (22, "a " * 30)]
    docs = [(i, " ".join(filter(None, [text(rng.randint(0, 40)), rng.choice(bench)[1] if i % 2 else None, text(rng.randint(0, 9))]))) for i in range(50)]
    docs += [(100, None), (101, ""), (102, "."), (103, "a " * 9000), (103, "a " * 40), (None, bench[0][1])]
    return docs, bench


@pytest.mark.parametrize("seed,passes", [(1, 100_000), (2, 20)])
def test_matches_plain_scan(spark, seed, passes):  # of many passes several stages
    docs, bench = data(seed)
    assert run(spark, docs, bench, patterns_per_pass=passes) == plain(docs, bench, 13)


def test_empty_tables(spark):
    docs, bench = data(3)
    assert run(spark, docs, []) == plain(docs, [], 13)
    assert run(spark, [], bench) == []


def test_item_ids_of_any_type_and_clashing_columns(spark):
    docs, bench = data(5)
    bench = [(None if i is None else f"item-{i}", t) for i, t in bench] + [("item-1", bench[2][1])]
    names = ["doc_id", "text", "_text", "row", "hits", "items", "result", "window", "item", "block", "a.b"]
    left = spark.createDataFrame([(d, t, *range(9)) for d, t in docs], " long, ".join(f"`{n}`" for n in names).replace("`text` long", "`text` string") + " long")
    right = spark.createDataFrame(bench, "item_id string, text string")
    out = D.find_contamination(left, right, result_col="found")
    assert out.columns == [*names, "found"]
    got = sorted(((r.doc_id, r.found.n_words, r.found.n_hit, r.found.n_items, D.sha_of(r.found["items"]), bool(r.found.n_hit) and 20 * r.found.n_hit >= r.found.n_words) for r in out.collect()), key=str)
    assert got == plain(docs, bench, 13) and all(tuple(r[2:11]) == tuple(range(9)) for r in out.collect())


def test_shift_tables_find_every_occurrence():
    rng = random.Random(4)
    text = bytes(rng.choice(b"ab ") for _ in range(20_000))
    patterns = sorted({text[i : i + rng.randint(9, 15)] for i in rng.sample(range(19_000), 40)})
    found = D.WuManber(patterns).find(text)
    want = [(i, k) for i in range(len(text)) for k, p in enumerate(patterns) if text.startswith(p, i)]
    assert sorted(found) == want


def test_many_passes_write_texts_once(spark, monkeypatch):
    staged, real = [], D.stage
    monkeypatch.setattr(D, "stage", lambda df, name, by=None: (staged.append((name, by)), real(df, name, by))[1])
    docs, bench = data(6)
    assert run(spark, docs, bench, patterns_per_pass=4) == plain(docs, bench, 13)
    names = [name for name, _ in staged]
    assert names.count("texts") == 1 and names.count("hits") >= 3 and staged.count(("windows", "block")) == 1
    staged.clear()
    assert run(spark, docs, bench) == plain(docs, bench, 13)
    assert staged == [("windows", None)]

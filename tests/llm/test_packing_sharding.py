"""Packing: exact round trip. Sharding: its law, mixture and slots against plain ranks."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from strandlab.llm import packing as P
from strandlab.llm import sharding as H
from strandlab.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, start string, shard string, n long"


def rows(n=150):
    rng = random.Random(2)
    pieces = ["word", "Hello,", "  two", "\n\n", "tab\t x", "éàü", "it's", " ", "123", "<|endoftext|>", "日本", "end. ", " ", "  x"]
    out = [(i, "".join(rng.choice(pieces) + rng.choice(["", " ", "  "]) for _ in range(rng.choice([3, 40, 900]))), f"s{min(i % 5, 2)}") for i in range(n)]
    return out + [(900, "", "s0"), (901, None, None), (902, "x " * 9000, "s1"), (None, "null id", "s1"), (3, out[3][1], out[3][2]), (3, out[3][1], out[3][2])]


def frame(spark, data):
    return spark.createDataFrame([(d, t, s, "x", "y", 1) for d, t, s in data], SCHEMA)


def test_pieces_give_back_every_document(spark):
    from tokenizers import Tokenizer

    data = rows()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for d, t, _ in data:
        want[(d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())] += 1
    got = P.pack_documents(frame(spark, data).repartition(3), tokenizer_path(), with_ids=True).collect()
    fill, docs = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length > 0
        fill[r.sequence_id].append((r.offset, r.length))
        docs[(r.doc_id, r.doc_tokens)].append((r.start, bytes(r.ids)))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)  # nothing is padded here
    found = Counter()
    for (doc, total), pieces in docs.items():
        pieces.sort()
        copies = len({s for s, _ in pieces}) and sum(s == 0 for s, _ in pieces)
        if copies == 1:
            found[(doc, b"".join(b for _, b in pieces))] += 1
        else:  # repeated rows: their pieces come in equal numbers of tokens
            assert sum(len(b) for _, b in pieces) == 4 * total * copies
            found.update({k: v for k, v in want.items() if k[0] == doc})
    assert found == want


def test_sum_of_squares_prefers_perfect_fits():
    rule = P.SumOfSquares(10)
    assert [rule.place(x) for x in (6, 6, 4, 4)] == [(0, 0), (1, 0), (1, 6), (0, 6)]
    assert rule.count.sum() == 0


def test_places_as_the_plain_rule_does():
    rng = random.Random(5)
    rule, fill = P.SumOfSquares(32), {}
    for _ in range(3000):
        n = rng.choice([rng.randint(1, 31), rng.randint(1, 6)])
        counts = Counter(x for x in fill.values() if x < 32)
        squares = lambda a, b: sum(v * v for k, v in (counts + Counter({b: 1} if b < 32 else {}) - Counter({a: 1} if a else {})).items() if k)
        cost = {level: squares(level, level + n) for level in {0, *counts} if level + n <= 32}
        window, level = rule.place(n)
        assert cost[level] == min(cost.values()) and fill.get(window, 0) == level
        fill[window] = level + n
    assert sorted(Counter(x for x in fill.values() if x < 32).items()) == [(k, int(v)) for k, v in enumerate(rule.count) if v and 0 < k < 32]


def test_packing_of_nothing(spark):
    assert P.pack_documents(frame(spark, []), tokenizer_path()).count() == 0


def test_shards_match_the_mixture(spark):
    data = [(i, f"text {i % 7}", "hot" if i % 3 else f"s{i % 4}") for i in range(3000)] + rows(20)
    got = H.shard_rows(frame(spark, data).repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in data)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    sizes = [len(by[k]) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1 and {r.law for r in got} == {"rows"}
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    total = Counter(r.source for r in got)
    for x in by.values():
        mine = Counter(r.source for r in x)
        assert all(abs(mine[s] - total[s] * len(x) / len(data)) <= 3 for s in total)


def test_sharding_of_nothing(spark):
    assert H.shard_rows(frame(spark, [])).count() == 0


def test_long_runs_of_white_space_keep_the_ids_of_the_library(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    same = lambda e, t: np.frombuffer(e.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    n, encoder = 2_000_000, P.Encoder(tokenizer_path())
    assert all(same(encoder, t) for t in (" " * n, "\n" * n, "a" + " \n" * (n // 2) + "b", " " * n + "'s x", "\t" * n + "<|endoftext|>y", "\u3000" * (n // 3) + "1"))
    monkeypatch.setattr(P, "LONG_BLANK", 3)  # every run is cut out
    encoder, rng = P.Encoder(tokenizer_path()), random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "\x85", "\xa0", "\u3000", "\x1c", "'s", "<|endoftext|>", "1", "!", "é", "\u200b", "\ufeff"]
    assert all(same(encoder, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for _ in range(5000))

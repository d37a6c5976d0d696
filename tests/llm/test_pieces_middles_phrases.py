"""SentencePiece ids against the library, fill-in-middle against plain slicing, phrases against plain counting."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strandlab.llm import fill_middle as M
from strandlab.llm import phrases as H
from strandlab.llm import sentence_pieces as S
from strandlab.llm.queries import op11_sentence_pieces, op12_fill_in_middle, op13_phrase_collocations, piece_model_path

SCHEMA = "doc_id long, text string, lang string, n long, row string, found string, form string"


def table(spark, data):
    return spark.createDataFrame([(d, t, lang, 1, "x", "y", "z") for d, t, lang in data], SCHEMA)


def texts(seed=1, n=300):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "   ", "▁", "▁▁", "\n", "\t", "é", "日本", "😀", "ing", "hello", " world", "<s>", "</s>", "<P>", "<S>", "<0x0A>", ".", "x, y"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def rows():
    data = [(i, t, ["en", "de", None, "und"][i % 4]) for i, t in enumerate(texts())]
    long = ["x" * 70_000, " " * 50_000, "ab " * 40_000, "é" * 30_000 + " " * 777 + "end"]
    return data + [(1000 + k, t, "en") for k, t in enumerate(long)] + [(None, "null id", "en"), (2000, None, None), (2001, "", "fr"), (3, data[3][1], "en"), (3, data[3][1], "en")]


# SentencePiece


def test_ids_and_texts_are_those_of_the_library(spark, tmp_path):
    from sentencepiece import SentencePieceProcessor

    model, data = SentencePieceProcessor(model_file=piece_model_path()), rows()
    docs = table(spark, data).repartition(3)
    want = Counter()
    for d, t, _ in data:
        ids = model.encode(t or "")
        want[(d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())] += 1
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(tuple(r) for r in op11_sentence_pieces(spark, str(tmp_path)).collect()) == want
    # clashing names are passed on, and ids decode by themselves
    out = S.encode_texts(docs, piece_model_path(), result_col="form")
    assert out.columns == [c for c in docs.columns if c != "form"] + ["form"]
    back = S.decode_ids(out.select("doc_id", "form.*"), piece_model_path(), result_col="again").where("text <> again").count()
    assert back == 0
    assert S.encode_texts(docs.limit(0), piece_model_path()).count() == 0


def test_common_words_come_from_the_shared_table(spark):
    docs = table(spark, [(i, "common words are here" + f" rare{i}", "en") for i in range(200)]).repartition(4)
    found = S.chunk_table(docs, piece_model_path(), bits=5)
    assert set(found) == {b"common", b"words", b"are", b"here"}  # the others make up less than one in 32
    segmenter = S.Segmenter(piece_model_path())
    assert all(np.frombuffer(v, np.int32).tolist() == segmenter.model.encode(k.decode()) for k, v in found.items())

    class Once(S.Segmenter):
        def segment(self, words):
            assert len(words) == len(set(words)) and not set(words) & set(found)
            return super().segment(words)

    for _, sizes, ids in S.encoded(S.ChunkTable(Once(piece_model_path()), found), pa.array(["common rare rare here"] * 3)):
        assert ids.tolist() == 3 * segmenter.model.encode("common rare rare here") and len(set(sizes)) == 1


def test_any_ids_decode_as_the_library_does():
    segmenter, rng = S.Segmenter(piece_model_path()), random.Random(5)
    for _ in range(2000):
        ids = [rng.randrange(32_000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 8))]
        assert S.decoded(segmenter, np.array(ids, np.int32), np.array([len(ids)])) == [segmenter.model.decode(ids)]


# Fill in the middle


def plain_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles_against_plain_slices(spark, tmp_path):
    data = rows()
    docs = table(spark, data).repartition(3)
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want, forms = Counter(), Counter()
    for d, t, _ in data:
        n, form, p, m, out = plain_middle(d, t)
        want[(d, n, form, p, m, sha(out), sha(t or ""))] += 1
        forms[form] += 1
    assert min(forms[f] for f in ("plain", "spm", "psm")) > 10
    assert Counter(tuple(r) for r in op12_fill_in_middle(spark, str(tmp_path)).collect()) == want
    out = M.fill_in_middle(docs, result_col="form")
    assert out.columns == [c for c in docs.columns if c != "form"] + ["form"]
    assert Counter(r.t for r in out.select("form.text").toDF("t").collect()) == Counter(plain_middle(d, t)[4] for d, t, _ in data)
    assert M.fill_in_middle(docs.limit(0)).count() == 0


def test_pieces_split_and_come_back():
    whole = M.PieceTable((memoryview(b"abcdef"), memoryview(M.SENTINELS)), [(M.TEXT, 0, 6)])
    cut = whole.cut(2).cut(2).cut(6)
    assert cut.pieces == [(0, 0, 2), (0, 2, 0), (0, 2, 4), (0, 6, 0)] and cut.bytes() == b"abcdef"
    with pytest.raises(IndexError):
        whole.cut(7)
    with pytest.raises(ValueError):
        M.arrangement_of(b"<P>a<M>b", "psm")
    table = M.arrangement_of(b"<S>c<P>a<M>b", "spm")
    assert table.bytes() == b"<S>c<P>a<M>b" and table.restored(M.FORMS["spm"]).bytes() == b"abc"


# Phrases


def plain_phrases(data, least=10, top=2000):
    words, counts = Counter(), Counter()
    for _, text, lang in data:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                counts.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
            words[lang] += len(w)
    found = []
    for key, a in counts.items():
        lang, *w = key
        if len(w) < 2 or a < least:
            continue
        inside = (y for y, f in counts.items() if len(y) == 4 and y[0] == lang and f >= least and 100 * f >= 50 * a and (y[1:3] == key[1:] or y[2:] == key[1:]))
        if len(w) == 2 and next(inside, None):
            continue
        score, k = min((10**6 * a * a // (counts[(lang, *w[:k])] * counts[(lang, *w[k:])]), k) for k in range(1, len(w)))
        found.append((lang, -score, -a, " ".join(w), counts[(lang, *w[:k])], counts[(lang, *w[k:])]))
    out = []
    for lang in words:
        mine = sorted((f for f in found if f[0] == lang), key=lambda f: (f[1], f[2], f[3].encode()))[:top]
        out += [(lang, i, p, -a, left, right, words[lang], -s) for i, (_, s, a, p, left, right) in enumerate(mine, 1)]
    return sorted(out)


def phrase_data(seed=2):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "new", "york", "city", "big", "apple", "Éa", "éa", "日本", "x\x1cy", "a"]
    data = []
    for i in range(150):
        words = [rng.choice(vocabulary) if rng.random() < 0.8 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 60))]
        data.append((i, "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n"][: rng.choice([2, 6])]) for w in words), ["en", "de", None, "und"][i % 4]))
    same = "new york city of the big apple " * 3
    return data + [(500 + k, same, "en") for k in range(40)] + [(900, None, "en"), (901, "", None), (None, same, "de"), (902, "alone", "xx")]


@pytest.mark.parametrize("shards, bits", [(1, 23), (3, 16), (4, 6)])
def test_phrases_against_plain_counts(spark, shards, bits):
    data = phrase_data()
    docs = table(spark, data).repartition(3)
    got = sorted(tuple(r) for r in H.mine_phrases(docs, top=25, shards=shards, bits=bits).collect())
    assert got == plain_phrases(data, top=25) and any(len(r[2].split()) == 3 for r in got)


def test_long_texts_are_counted_across_slices(spark, monkeypatch):
    monkeypatch.setattr(H, "RUN_BYTES", 64)
    rng = random.Random(4)
    text = "".join(rng.choice(["aa", "b", "ccc", "d" * 150]) + rng.choice([" ", " " * 100, "\t", ". ", "\n" + " " * 200]) for _ in range(700))
    plain = {k: Counter() for k in (1, 2, 3)}
    for piece in re.split("[.\n]", text):
        w = re.findall("[^ \t]+", piece)
        for k in plain:
            plain[k].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    found = {k: Counter() for k in (1, 2, 3)}
    on = np.zeros(64, np.uint8)
    for lang, run in H._runs([pa.record_batch([pa.array(["en"]), pa.array([text])], names=["lang", "text"])]):
        names = dict(zip(H.word_keys(run, lang, 1).tolist(), run.words.to_pylist()))
        found[1].update(run.words[int(c)].as_py() for c in run.code[run.known :])
        for w1, w2, w3, _, n in H.phrase_rows(run, lang, 1, 0, 1, on, on):
            for a, b, c, x in zip(w1.tolist(), w2.tolist(), w3.tolist(), n.tolist()):
                found[3 if c else 2][" ".join(names[y] for y in (a, b, c) if y)] += x
    assert found == plain


def test_scans_are_interleaved_and_each_phrase_has_one_round(spark, monkeypatch):
    steps = []
    count = H._count_phrases

    def seen(shard, seed, step, shards, masks):
        out = count(shard, seed, step, shards, masks).persist()
        steps.append((step, {(r.two, r.since) for r in out.selectExpr("w3 = 0 two", "since").distinct().collect()}))
        return out

    monkeypatch.setattr(H, "_count_phrases", seen)
    H.phrase_counts(table(spark, phrase_data()), shards=3, bits=16)
    assert steps[0][0] == 1 and steps[-1][0] <= 8
    assert any({two for two, _ in kinds} == {True, False} for _, kinds in steps)  # pairs and triples in one scan
    assert all(since <= step < since + 3 for step, kinds in steps for _, since in kinds)


def test_words_that_share_a_hash_are_counted_again(spark, monkeypatch):
    keys = H.word_keys
    monkeypatch.setattr(H, "word_keys", lambda run, lang, seed: np.full(len(run.words), 7, np.uint64) if seed == 1 else keys(run, lang, seed))
    rng, data = random.Random(1), [(i, "one two one three", "en") for i in range(12)]
    words, _ = H.phrase_counts(table(spark, data), shards=1, bits=10)
    assert sorted(r.word for r in words.collect()) == ["one", "three", "two"]


def test_nothing_gives_no_phrases(spark, tmp_path):
    docs = table(spark, [(1, None, "en")])
    assert H.mine_phrases(docs.limit(0), bits=10).count() == 0 and H.mine_phrases(docs, bits=10).count() == 0
    table(spark, [(i, "Same words here. Same words", "en") for i in range(10)]).write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r.rank, r.phrase, r.a, r.score) for r in op13_phrase_collocations(spark, str(tmp_path)).orderBy("rank").collect()] == [(1, "same words here", 10, 500000)]  # the triple comes half as often as the pair within it

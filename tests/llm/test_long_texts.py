"""Texts longer than what a kernel takes at once, many rows without id, and repeated rows, against the plain versions."""

import collections
import math
import random
import re
import zlib

from test_decontaminate import plain as plain_hits
from test_jaccard_join import plain as plain_classes
from test_suffix_dedup import plain as plain_cuts

from strandlab.llm import decontaminate as D
from strandlab.llm import jaccard_join as J
from strandlab.llm import lm_score as M
from strandlab.llm import suffix_dedup as S
from strandlab.llm import toxicity as X
from strandlab.llm import url_filter as U
from strandlab.llm.common import CHUNK_BYTES

SCHEMA = "doc_id long, text string"


def corpus():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(3, 9)))
    small = [" ".join(word() for _ in range(60)) for _ in range(6)]
    words = [word() for _ in range(330_000)]
    long = " ".join(words)
    assert len(long.encode()) > CHUNK_BYTES
    rows = [(5, long), (9, long + " " + small[0]), (12, " ".join(words[-400:-300]) + " " + small[1]), (2, small[2]), (3, small[2]), (4, None), (6, "")]
    rows += [(None, small[k % 3]) for k in range(12)] + [(7, small[3])] * 4
    return rows, words


def frame(spark):
    rows, words = corpus()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows, words


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_classes(spark):
    df, rows, _ = frame(spark)
    got = J.near_duplicate_classes(df).select("doc_id", "n_shingles", "component_id").collect()
    assert key(got) == plain_classes(rows) and {r.component_id for r in got if r.doc_id in (5, 9)} == {5}


def test_repeats(spark):
    df, rows, _ = frame(spark)
    got = S.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert key(got) == plain_cuts(rows)


def test_hits(spark):
    df, rows, words = frame(spark)
    bench = [(1, " ".join(words[-350:-320])), (1, " ".join(words[200_000:200_014])), (2, "not there at all")]
    out = D.find_contamination(df, spark.createDataFrame(bench, "item_id long, text string"), keep=["doc_id"])
    c = out["contamination"]
    got = out.select("doc_id", c["n_words"], c["n_hit"], c["n_items"], D.item_digest(c["items"]), D.contaminated(c)).collect()
    assert key(got) == plain_hits(rows, bench, 13)


def test_base_scores(spark):
    df, rows, _ = frame(spark)
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", t or ""), None]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    counts = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = key((d, len(tokens(t)), sum(w in counts for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 3)) for d, t in rows)
    got = M.score_texts(df).collect()
    assert key((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want and all(r.score < 0 for r in got)


def test_an_insult_at_the_end(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bdgkrtu") for _ in range(rng.randint(2, 6)))
    text = lambda n, *extra: " ".join([*(word() for _ in range(n)), *extra])
    rows = [(i, text(30, "pathetic", word(), "pathetic") if i % 4 == 0 else text(30)) for i in range(160)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    model = X.fit_toxicity(spark.createDataFrame(rows, SCHEMA), labels)
    long = text(600_000)
    assert len(long) > CHUNK_BYTES
    odd = spark.createDataFrame([(1, long), (2, long + " pathetic." * 4000), (None, "pathetic"), (None, "pathetic"), (3, None)], SCHEMA)
    got = sorted(((r.doc_id or 0, r.toxicity) for r in X.with_toxicity(odd, model).collect()))
    assert got[0] == got[1] and got[0][1] >= 0.3 and got[2][1] < 0.3 <= got[3][1] and got[4][1] < 0.3


def test_repeated_pages_and_labels(spark):
    pages = [(i, f"http://a.org/x/{i}") for i in range(60)] * 2 + [(None, "http://a.org/x/1"), (None, None), (61, "http://a.org/" + "y" * 200_000)]
    pages += [(100 + i, f"http://b.org/z/{i}") for i in range(300)]
    labels = [(i, 0, 0) for i in range(60)] + [(i, 1, 0) for i in range(60)] + [(None, 0, 1), (61, None, None)] + [(100 + i, 1, 0) for i in range(300)]
    df = spark.createDataFrame([(p, u, 1, 2) for p, u in pages], "page_id long, url string, n int, template int")
    got = U.filter_urls(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(pages) and all((r.verdict == "block") == (r.host == "a.org" and r.path.startswith("/x/")) for r in got if r.page_id != 61)

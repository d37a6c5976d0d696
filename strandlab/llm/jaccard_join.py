"""N-gram Jaccard join with adaptive multi-match prefixes, for classes of near duplicates.

Documents with equal shingle sets are one class from the start. Each class's shingles are put in one global order: rare
before frequent by the exact number of classes that hold them, then by hash. Two documents with Jaccard similarity of at
least t share at least l shingles among their first n - ceil(t n) + l ones, for any l. A document picks its own l by the
estimated cost of its candidates, from the exact lengths of its shingles' lists: a longer prefix is looked up in more lists,
but a pair must meet in min(l, l') of them before it is verified. No true pair can miss that.

The counts are corpus-wide: batches of documents send the hashes of their shingles to hash buckets, which answer with those
that another class has too and in how many. A document that shares fewer than ceil(t n) shingles with all others together
has no partner and goes no further.

As only classes are asked for, pairs that are already connected need no test: each list first tests all members against
one leader, the links found are contracted, and then only members of different components are paired. Every pair so left
is counted and tested; no list is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_count, column, deltas, message_rows, mix64, pack, range_split, stage, unpack, unstage
from .components import connected_components
from .shingles import SHINGLE_WORDS, shingle_sets

PERCENT = 75
#: Choices of l, the prefix shingles to be shared.
MATCHES = (1, 2, 4, 8, 16, 32)
#: Cost of verifying a candidate, in list entries read.
VERIFY_COST = 2
#: Rounds that test lists against one leader, and the share of links among tested pairs below which they end.
STAR_ROUNDS, STAR_YIELD = 4, 0.05
#: Bits of a shingle's hash by which lists are found; full hashes decide.
TOKEN_BITS = 48
#: Input of a batch; a task holds the shingles of one.
BATCH_MB = 5

_SPEC = "bucket int, pid int, message binary"


def _signatures(batches):
    """doc_id, shingle count and a 128-bit order-free hash of each set."""
    for batch in batches:
        n_out, a_out, b_out = [], [], []
        for _, n, hashes in shingle_sets(batch.column(1)):
            past = np.cumsum(n)
            for out, values in ((a_out, mix64(hashes)), (b_out, mix64(hashes ^ np.uint64(0xABCDEF0123456789)))):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
                out.append(sums[past] - sums[past - n])
            n_out.append(n)
        if n_out:
            yield pa.record_batch(
                [batch.column(0), pa.array(np.concatenate(n_out)), pa.array(np.concatenate(a_out).view(np.int64)), pa.array(np.concatenate(b_out).view(np.int64))],
                names=["doc_id", "n_shingles", "sig_a", "sig_b"],
            )


def needed(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles that a partner must share."""
    return -(-percent * n // 100)


def choose_matches(n: np.ndarray, text: np.ndarray, size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """l of each set from the lengths of its shingles' lists (1: no other class), in the global order, set after set.

    The cost is that of a partner of equal size: later places of the prefix leave it too little to share and make no pair."""
    first = np.searchsorted(text, np.arange(len(n)))
    total = np.concatenate([[0], np.cumsum(np.where(size > 1, size - 1, 0))])
    common = -(-2 * percent * n // (100 + percent))
    best, ell = np.full(len(n), np.inf), np.ones(len(n), np.int64)
    for k in MATCHES:
        allowed = k <= np.maximum(1, needed(n, percent))
        past = first + np.where(allowed, np.minimum(n, n - common + k), 0)
        read = (total[past] - total[first]).astype(float)
        cost = read + VERIFY_COST * read / k
        better = allowed & (cost < best)
        best, ell = np.where(better, cost, best), np.where(better, k, ell)
    return ell


def _token(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - TOKEN_BITS)


def _shared_tokens(table: pa.Table) -> pa.Table:
    """Answers of a bucket: which of each batch's shingles are in two classes or more, and in how many."""
    bucket = table.column("bucket")[0].as_py()
    parts = [unpack(m) for m in table.column("message").to_pylist()]
    tokens = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
    distinct, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(distinct)).astype(np.uint32)
    rows, at = [], 0
    for pid, own in zip(table.column("pid").to_pylist(), tokens):
        n = total[inverse[at : at + len(own)]]
        at += len(own)
        if (n >= 2).any():
            rows.append((bucket, pid, pack(deltas(own[n >= 2]), n[n >= 2])))
    return message_rows(rows)


def _answers(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted tokens of a batch that other classes have too, and their numbers of classes."""
    tokens, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for bucket, message in sorted(zip(table.column("bucket").to_pylist(), table.column("message").to_pylist())):
        if bucket >= 0:
            t, n = unpack(message)
            tokens.append(np.cumsum(t, dtype=np.uint64))
            sizes.append(n)
    return np.concatenate(tokens), np.concatenate(sizes).astype(np.int64)


def _sets_of(docs: pa.Table, mine: set):
    """(ids, counts, hashes) of the class representatives in a batch, the first row of each id."""
    ids = column(docs, "doc_id").to_pylist()
    seen: set = set()
    rows = [i for i, d in enumerate(ids) if d in mine and not (d in seen or seen.add(d))]
    if not rows:
        return
    chosen = column(docs, "text").take(pa.array(rows))
    ids = np.array([ids[i] for i in rows])
    for row, n, hashes in shingle_sets(chosen):
        yield ids[row : row + len(n)], n, hashes


def _own(table: pa.Table) -> set:
    return {d for b, m in zip(table.column("bucket").to_pylist(), table.column("message").to_pylist()) if b == -1 for d in unpack(m)[0].tolist()}


_CANDIDATES = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("ell", pa.int32()), ("places", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int64())), ("shingles", pa.list_(pa.int64()))]
)


def candidate_rows(sets, tokens: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> pa.Table:
    """Of sets that share enough with all others together: l, the places and tokens of the l-prefix that other classes have
    too, and all such shingles."""
    out: list[list] = [[] for _ in _CANDIDATES]
    for ids, n, hashes in sets if len(tokens) else ():
        text = np.repeat(np.arange(len(n)), n)
        token = _token(hashes)
        at = np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)
        size = np.where(tokens[at] == token, sizes[at], 1)
        alive = np.bincount(text, size > 1, len(n)) >= np.maximum(1, needed(n, percent))
        keep = alive[text]
        text, token, size, hashes, ids, n = np.cumsum(alive)[text[keep]] - 1, token[keep], size[keep], hashes[keep], ids[alive], n[alive]
        order = np.lexsort((hashes, size, text))
        text, token, size, hashes = text[order], token[order].view(np.int64), size[order], hashes[order].view(np.int64)
        ell = choose_matches(n, text, size, percent)
        place = np.arange(len(text)) - (np.cumsum(n) - n)[text]
        shared = size > 1
        prefix = shared & (place < (n - needed(n, percent) + ell)[text])
        cut = np.searchsorted(text[prefix], np.arange(len(n) + 1)).tolist()
        whole = np.searchsorted(text[shared], np.arange(len(n) + 1)).tolist()
        place, token, hashes = place[prefix].astype(np.int32), token[prefix], hashes[shared]
        for k in range(len(n)):
            row = (int(ids[k]), int(n[k]), int(ell[k]), place[cut[k] : cut[k + 1]], token[cut[k] : cut[k + 1]], hashes[whole[k] : whole[k + 1]])
            for values, x in zip(out, row):
                values.append(x)
    return pa.table([pa.array(c, f.type) for c, f in zip(out, _CANDIDATES)], schema=_CANDIDATES)


def near_duplicate_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT, one_text: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links, itself included) of every row.

    Null, empty and blank texts have no shingles and no links: component_id is their own id. Rows with a null id have
    no links either, and a null component. Repeated rows are linked as equal texts are; where one id comes with several
    texts, rows with the same id are one node of the graph. Very long texts are whole sets like any other. An empty table
    gives no rows. Only the two named columns are read. ``one_text`` says that no id has several texts.
    """
    batches = batch_count(docs, text_col, BATCH_MB)
    buckets = max(8, batches // 2)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    signatures = stage(rows.mapInArrow(_signatures, "doc_id long, n_shingles long, sig_a long, sig_b long"), "signatures")
    mixed = signatures.where("doc_id is not null").groupBy("doc_id").agg(F.min("sig_a").alias("x"), F.max("sig_a").alias("y")).where("x <> y")
    if not one_text and mixed.limit(1).count() > 0:
        return _by_text(rows, words, percent)
    linked = signatures.where("n_shingles > 0 and doc_id is not null")
    classes = stage(linked.groupBy("sig_a", "sig_b").agg(F.min("doc_id").alias("rep")), "classes")

    pid = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    batch = rows.where("doc_id is not null and text is not null").withColumn("pid", pid)

    def own_list(table):
        ids = table.column("doc_id").to_numpy()
        return message_rows([(-1, table.column("pid")[0].as_py(), pack(np.unique(ids)))])

    representatives = classes.select(F.col("rep").alias("doc_id")).distinct().withColumn("pid", pid).groupBy("pid").applyInArrow(own_list, _SPEC)

    def send(key, left, right):
        found = [np.zeros(0, np.uint64), *(_token(hashes) for _, _, hashes in _sets_of(left, _own(right)))]
        tokens, counts = np.unique(np.concatenate(found), return_counts=True)
        return message_rows([(b, key[0].as_py(), pack(deltas(tokens[s]), counts[s].astype(np.uint32))) for b, s in range_split(tokens, buckets, TOKEN_BITS)])

    def candidates(key, left, right):
        return candidate_rows(_sets_of(left, _own(right)), *_answers(right), percent)

    sent = batch.groupBy("pid").cogroup(representatives.groupBy("pid")).applyInArrow(send, _SPEC)
    shared = sent.groupBy("bucket").applyInArrow(lambda t: _shared_tokens(t), _SPEC)
    found = stage(
        batch.groupBy("pid").cogroup(representatives.unionByName(shared).groupBy("pid")).applyInArrow(
            candidates, "doc_id long, n long, ell int, places array<int>, tokens array<bigint>, shingles array<bigint>"
        ),
        "candidates",
    )
    labels = _components(found, percent)
    member = signatures.join(classes, ["sig_a", "sig_b"], "left").where("n_shingles > 0 and doc_id is not null")
    alone = signatures.where("n_shingles <= 0 or doc_id is null").withColumn("rep", F.col("doc_id"))
    out = member.select("doc_id", "n_shingles", "rep").unionByName(alone.select("doc_id", "n_shingles", "rep"))
    if labels is not None:
        out = out.join(labels, out["rep"] == labels["id"], "left").withColumn("rep", F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", F.col("rep").alias("component_id"))


def _by_text(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Classes where ids come with several texts: those of (id, text) keys first, then components that share an id are one."""
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    keyed = rows.select("doc_id", key.alias("key"), "text")
    found = stage(near_duplicate_classes(keyed, id_col="key", words=words, percent=percent, one_text=True), "keys")
    nameless = found.where("doc_id is null").select("doc_id", "n_shingles", "component_id")
    found = found.where("doc_id is not null").distinct().withColumnRenamed("doc_id", "key")
    member = stage(keyed.where("key is not null").select("doc_id", "key").join(found, "key").select("doc_id", "n_shingles", "component_id"), "members")
    first = member.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    labels = connected_components(member.join(first, "doc_id").where("a <> component_id").select("a", F.col("component_id").alias("b")).distinct())
    merged = member.join(labels, member["component_id"] == labels["id"], "left").select("doc_id", "n_shingles", F.coalesce("component", "component_id").alias("label"))
    least = merged.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return merged.join(least, "label").select("doc_id", "n_shingles", "component_id").unionByName(nameless)


def _components(found: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of the candidates that have links, or None without any."""
    lists = found.select("doc_id", "n", "ell", F.posexplode("tokens").alias("i", "token"), "places")
    # its i-th list entry is at a place p of n, which leaves n - p shingles that can be shared from there on
    postings = lists.select("doc_id", "n", "ell", "token", (F.col("n") - F.get("places", F.col("i"))).cast("int").alias("rest"))
    alone = postings.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    postings = stage(postings.join(alone, "token"), "postings")
    sets = found.select("doc_id", "n", "shingles")
    labels, rounds = None, [*range(STAR_ROUNDS), None]
    while rounds:
        round_no = rounds.pop(0)
        here = postings.withColumn("comp", F.col("doc_id"))
        if labels is not None:
            here = postings.join(labels, postings["doc_id"] == labels["id"], "left").withColumn("comp", F.coalesce("component", "doc_id"))
        here = here.select("token", "doc_id", "n", "ell", "rest", "comp")
        pairs = _met_pairs(here, percent) if round_no is None else _star_pairs(here, round_no, percent)
        tested = stage(_verified(pairs, sets, percent), "tested")
        new = tested.where("linked").select("a", "b")
        pairs, links = tested.agg(F.count("*"), F.count_if("linked")).first()
        if links:
            labels = _contracted(new, labels)
        if round_no is not None and links <= STAR_YIELD * pairs:
            rounds = [None]
        unstage(tested)
        if round_no is None:
            unstage(postings)
    return labels


def _contracted(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(id, component) after more links; only components that get links are labelled anew."""
    if labels is None:
        return connected_components(links)
    comp = labels.select("id", "component")
    for side in "ab":
        links = links.join(comp.select(F.col("id").alias(side), F.col("component").alias(f"{side}_comp")), side, "left")
    merged = connected_components(links.select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")).where("a <> b").distinct())
    fresh = merged.select(F.col("id").alias("was"), F.col("component").alias("now"))
    old = labels.join(fresh, labels["component"] == fresh["was"], "left").select("id", F.coalesce("now", "component").alias("component"))
    new = merged.join(labels.select("id"), "id", "left_anti").select("id", "component")
    out = stage(old.unionByName(new), "labels")
    unstage(labels, merged)
    return out


def _star_pairs(here: DataFrame, round_no: int, percent: int) -> DataFrame:
    """Each document with the leader of most of its lists, where their components differ.

    From the second round on leaders are random members, so mostly of a list's largest component."""
    order = F.col("doc_id") if round_no == 0 else F.xxhash64("doc_id", F.lit(round_no))
    lead = here.groupBy("token").agg(F.min(F.struct(order.alias("o"), "doc_id", "comp", "n")).alias("lead"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    pair = here.join(lead, "token").where(F.col("comp") != F.col("lead.comp")).where(_sizes("n", "lead.n", percent))
    count = pair.groupBy("doc_id", F.col("lead.doc_id").alias("leader")).agg(F.count("*").alias("k"))
    best = count.groupBy("doc_id").agg(F.max(F.struct("k", "leader")).alias("best"))
    return best.select(F.least("doc_id", "best.leader").alias("a"), F.greatest("doc_id", "best.leader").alias("b")).distinct()


def _sizes(x: str, y: str, percent: int):
    return (100 * F.col(x) >= percent * F.col(y)) & (100 * F.col(y) >= percent * F.col(x))


def _met_pairs(here: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet in at least min(l, l') lists, at places that leave enough to share.

    Components meet list by list first, by their ranges of sizes, and then only members of those that meet: a list that a large
    component shares with a few others costs its members times the others, never the members among themselves."""
    side = lambda t, x: t.select("token", *[F.col(c).alias(f"{c}_{x}") for c in t.columns if c != "token"])
    comps = here.groupBy("token", "comp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest"), F.max("ell").alias("ell"))
    # a list of one component has no pairs
    several = comps.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    comps = comps.join(several, "token")
    # sizes that fit; and the m-th shared token of a pair leaves enough for needed - m + 1 more, where m is at most the other l.
    # For components, and for a document beside one, these hold if they may hold for any of their documents.
    fit = lambda n, low, high: f"100 * {n} >= {percent} * {low} and {percent} * {n} <= 100 * {high}"
    reach = lambda x, y: f"{100 + percent} * (least(rest_a, rest_b) + least(ell_a, ell_b) - 1) >= {percent} * ({x} + {y})"
    meet = side(comps, "a").join(side(comps, "b"), "token").where("comp_a < comp_b").where(f"100 * high_a >= {percent} * low_b and 100 * high_b >= {percent} * low_a").where(reach("low_a", "low_b"))
    meet = meet.select("token", "comp_a", "comp_b", "low_b", "high_b", "rest_b", "ell_b")
    near = meet.join(side(here, "a"), ["token", "comp_a"]).where(fit("n_a", "low_b", "high_b")).where(reach("n_a", "low_b")).drop("low_b", "high_b", "rest_b", "ell_b")
    met = near.join(side(here, "b"), ["token", "comp_b"]).where(_sizes("n_a", "n_b", percent)).where(reach("n_a", "n_b"))
    counted = met.groupBy("doc_id_a", "doc_id_b").agg(F.count("*").alias("k"), F.max(F.least("ell_a", "ell_b")).alias("ell"))
    return counted.where("k >= ell").select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("k", F.size(F.array_intersect("s_a", "s_b")))
    return both.select("a", "b", F.expr(f"100 * k >= {percent} * (n_a + n_b - k)").alias("linked"))

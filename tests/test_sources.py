"""BAM, bigWig and RDS: round trips over files built here byte by byte."""

import gzip
import io
import math
import random
import re
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

from strandlab.functions.params import Params
from strandlab.plans import progress as G
from strandlab.plans import run as R
from strandlab.sources import bam as B
from strandlab.sources import bigwig as W
from strandlab.sources import files as L
from strandlab.sources import rds as D


def block(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    head = b"\x1f\x8b\x08\x04" + b"\0" * 6 + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def record(name, ref, pos, flag, cigar, seq, tags=b""):
    packed = b"".join(struct.pack("<I", n << 4 | B.OPERATIONS.index(o)) for o, n in cigar)
    codes = [B.BASES.index(c) for c in seq] + [0]
    bases = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + packed + bases + b"\xff" * len(seq) + tags
    return struct.pack("<i", len(body)) + body


def text_tag(name, value):
    return name.encode() + b"Z" + value.encode() + b"\0"


def bytes_tag(name, values):
    return name.encode() + b"BC" + struct.pack("<I", len(values)) + bytes(values)


REFS = [("chrI", 5000), ("chrII", 900), ("chrM", 300)]


def header():
    return b"BAM\1" + struct.pack("<i", 3) + b"@HD" + struct.pack("<i", len(REFS)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<I", s) for n, s in REFS)


def write(path, records, size=700):
    data = header() + b"".join(records)
    path.write_bytes(b"".join(block(data[i : i + size]) for i in range(0, len(data), size)) + block(b""))
    return str(path)


def reads(n=120):
    rng = random.Random(4)
    out = []
    for i in range(n):
        size = rng.randint(5, 60)
        seq = "".join(rng.choice("ACGT") for _ in range(size))
        mm = text_tag("MM", "T+B?,0;") + bytes_tag("ML", [rng.randrange(256)])
        out.append(record(f"read{i % 90}", rng.choice([0, 0, 1, -1]), rng.randint(0, 800), rng.choice([0, 16, 0, 4, 256, 2048]), [("M", size)], seq, mm if i % 3 else text_tag("XX", "y")))
    return out


def test_splits_give_every_record_once(spark, tmp_path):
    path = write(tmp_path / "a.bam", reads())
    whole = B.read_bam(spark, path).collect()
    assert len(whole) == 120 and whole[1].mm == "T+B?,0;" and len(whole[1].ml) == 1 and whole[0].mm is None
    for size in (900, 2500):
        part = B.read_bam(spark, path, splitBytes=str(size)).collect()
        assert sorted(r.ordinal for r in part) == sorted(r.ordinal for r in whole)
    assert B.read_bam(spark, path, mapped="true").count() == sum(r.flag & 0x104 == 0 and r.ref_id >= 0 for r in whole)
    assert [tuple(r) for r in B.references(spark, path).collect()] == [(0, "chrI", 5000), (1, "chrII", 900), (2, "chrM", 300)]


def test_long_cigar_and_tag_pairs():
    long = b"CGBI" + struct.pack("<III", 2, 3 << 4, 2 << 4 | 4)
    body = record("r", 0, 5, 0, [("S", 5), ("N", 3)], "ACGTA", long + text_tag("Mm", "T+B;") + bytes_tag("Ml", [7]) + text_tag("MM", "C+m;"))[4:]
    one = lambda b, names: B.decode_records(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]), np.array([9]), names).to_pylist()
    row = one(body, ["chrI"])[0]
    assert row["cigar"] == [{"op": "M", "len": 3}, {"op": "S", "len": 2}] and (row["mm"], row["ml"], row["seq"], row["ordinal"]) == ("T+B;", [7], "ACGTA", 9)
    with pytest.raises(B.FormatError):
        one(body[:20], [])
    with pytest.raises(B.FormatError):
        one(body[:45], ["chrI"])


def plain_record(body, names):
    """One record, field by field."""
    ref, pos, l_name, _, _, n_ops, flag, size = struct.unpack_from("<iiBBHHHi", body)
    at = 32 + l_name
    cigar = [{"op": B.OPERATIONS[x & 15], "len": x >> 4} for x in struct.unpack_from(f"<{n_ops}I", body, at)]
    at += 4 * n_ops
    seq = "".join(B.BASES[b >> 4] + B.BASES[b & 15] for b in body[at : at + (size + 1) // 2])[:size]
    at += (size + 1) // 2 + size
    tags, widths = {}, {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
    while at + 3 <= len(body):
        name, kind, at = body[at : at + 2].decode(), chr(body[at + 2]), at + 3
        if kind in "ZH":
            if (end := body.find(b"\0", at)) < 0:
                break
            tags.setdefault(name, body[at:end].decode("latin-1"))
            at = end + 1
        elif kind == "B" and at + 5 <= len(body) and chr(body[at]) in "cCsSiIf":
            letter, n = chr(body[at]), struct.unpack_from("<I", body, at + 1)[0]
            if at + 5 + n * widths[letter] > len(body):
                break
            tags.setdefault(name, (letter, list(body[at + 5 : at + 5 + n])))
            at += 5 + n * widths[letter]
        elif kind in widths:
            tags.setdefault(name, None)
            at += widths[kind]
        else:
            break
    mm = ml = None
    for a, b in (("MM", "ML"), ("Mm", "Ml")):
        if isinstance(tags.get(a), str) and isinstance(tags.get(b), tuple) and tags[b][0] == "C":
            mm, ml = tags[a], tags[b][1]
            break
    sa = tags.get("SA")
    return {
        "ref_id": ref, "chrom": names[ref] if 0 <= ref < len(names) else None, "pos": pos, "flag": flag, "read_id": body[32 : 31 + l_name].decode(errors="replace"), "l_seq": size, "seq": seq,
        "cigar": cigar, "mm": mm, "ml": ml, "sa": sa if isinstance(sa, str) else None,
    }


def test_records_decoded_by_columns_equal_plain_ones():
    rng = random.Random(6)
    tags = [
        text_tag("MM", "T+B?,0;"), text_tag("MM", "later"), bytes_tag("ML", [1, 255]), bytes_tag("ML", []), text_tag("Mm", "C+m;"), bytes_tag("Ml", [9]), text_tag("SA", "chrI,1,+,5M,60,0;"), b"SAi\1\0\0\0",
        b"NMC\5", b"ASs\1\0", b"XAAq", b"XFf\0\0\0\0", b"ZZBS" + struct.pack("<IHH", 2, 7, 8), b"MLBs" + struct.pack("<Ih", 1, 3), b"XH" + b"H0A\0", text_tag("XX", "caf\xe9"), b"QQ?", b"MMZopen", b"YYBI\xff\0\0\0", b"BB" + b"BA\1\0\0\0q",
    ]
    bodies = []
    for i in range(400):
        size = rng.randint(0, 40)
        cigar = [(rng.choice(B.OPERATIONS), rng.randint(0, 1 << 27)) for _ in range(rng.randint(0, 5))]
        bodies.append(record(f"ré{i}" if i % 7 == 0 else f"r{i}", rng.choice([-1, 0, 1, 5]), rng.randint(-1, 1 << 30), rng.choice([0, 4, 16, 256, 2064]), cigar, "".join(rng.choice(B.BASES) for _ in range(size)), b"".join(rng.sample(tags, rng.randint(0, 9))))[4:])
    # names are counted in bytes
    bodies = [b[:8] + bytes([len(f"ré{i}".encode()) + 1]) + b[9:] if i % 7 == 0 else b for i, b in enumerate(bodies)]
    size = np.array([len(b) for b in bodies])
    got = B.decode_records(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum(size) - size, size, np.arange(400), ["chrI", "chrII"]).to_pylist()
    assert got == [{"ordinal": i} | plain_record(b, ["chrI", "chrII"]) for i, b in enumerate(bodies)]
    assert B.decode_records(np.zeros(0, np.uint8), size[:0], size[:0], size[:0], ["chrI"]).num_rows == 0


def test_conditions_are_tested_before_records_are_decoded(spark, tmp_path):
    path = write(tmp_path / "a.bam", reads())
    whole = B.read_bam(spark, path).collect()
    some = B.read_bam(spark, path).where("ref_id >= 0 and flag in (0, 16) and pos < 400 and chrom = 'chrI'")
    assert sorted(r.ordinal for r in some.collect()) == sorted(r.ordinal for r in whole if r.ref_id >= 0 and r.flag in (0, 16) and r.pos < 400 and r.chrom == "chrI")
    reader = B.BamReader([path], 1 << 20, False)
    left = list(reader.pushFilters([EqualTo(("flag",), 4), In(("pos",), (1, 2)), EqualTo(("chrom",), "chrI"), GreaterThan(("ref_id",), 0)]))
    assert [f.attribute for f in left] == [("chrom",)] and len(reader.pushed) == 3
    with pytest.raises(B.FormatError):
        other = tmp_path / "b.bam"
        other.write_bytes(block(b"BAM\1" + struct.pack("<iii", 0, 1, 2) + b"x\0" + struct.pack("<I", 5)) + block(b""))
        B.references(spark, f"{path},{other}")


def test_damaged_blocks_are_errors(spark, tmp_path):
    path = write(tmp_path / "a.bam", reads(20))
    data = bytearray(open(path, "rb").read())
    data[60] ^= 1
    (tmp_path / "b.bam").write_bytes(bytes(data))
    with pytest.raises((B.FormatError, zlib.error)):
        while B.read_block(stream := B.open_file(str(tmp_path / "b.bam"))) is not None and stream.tell() < 60:
            break
    (tmp_path / "c.bam").write_bytes(bytes(data[:-40]))
    with pytest.raises(Exception):
        B.read_bam(spark, str(tmp_path / "c.bam")).count()


def test_bigwig_round_trip(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, 50 * i, 50 * i + 50, float(rng.randint(0, 9))) for k, n in ((0, 3000), (1, 18)) for i in range(n)]
    track = spark.createDataFrame(rows, "ref_id int, start long, end long, value float").repartition(3)
    refs = spark.createDataFrame([(0, "chrI", 150_000), (1, "chrII", 900), (2, "chrM", 0)], "ref_id int, chrom string, length long")
    path = str(tmp_path / "t.bw")
    assert W.write_bigwig(track, refs, path) == len(rows)
    got = W.read_bigwig(spark, path, sectionsPerTask="2").orderBy("chrom", "start").collect()
    assert [(r.chrom, r.start, r.end, r.value) for r in got] == [(["chrI", "chrII"][k], s, e, v) for k, s, e, v in rows]
    other = [(k, s, e, v + 1 if (k, s) == (0, 500) else v) for k, s, e, v in rows]
    W.write_bigwig(spark.createDataFrame(other, track.schema), refs, str(tmp_path / "u.bw"))
    found, total = R.bw_compare(spark, path, str(tmp_path / "u.bw"))
    assert total == 50 and {r.chrom: (r.diff_bases, r.first_diff) for r in found.collect()} == {"chrI": (50, 500), "chrII": (0, None), "chrM": (0, None)}


def test_a_whole_run(spark, tmp_path):
    path = write(tmp_path / "a.bam", reads())
    counts = R.run(spark, path, Params(bin_size=100), rds=str(tmp_path / "a.rds"), bw=str(tmp_path / "a.bw"), parquet=str(tmp_path / "out"))
    raw = gzip.open(tmp_path / "a.rds").read()
    assert raw[:2] == b"X\n" and struct.unpack_from(">i", raw, 2)[0] == 3 and raw.count(b"data.frame") >= counts["mappings"] > 0
    maps = spark.read.parquet(f"{tmp_path}/out/mappings")
    assert maps.count() == counts["mappings"] and all(r.signalbin for r in maps.collect())
    track = W.read_bigwig(spark, str(tmp_path / "a.bw"))
    assert {r.chrom: r.n for r in track.selectExpr("chrom", "end - start as w").groupBy("chrom").agg({"w": "sum"}).withColumnRenamed("sum(w)", "n").collect()} == dict(REFS)


class Parser:
    """Reads serialised items back: (value, attributes) of vectors and lists."""

    def __init__(self, raw):
        self.raw, self.at, self.symbols = raw, 2, []
        assert raw[:2] == b"X\n" and self.ints(4) == [3, 0x00040403, 0x00030500, 5] and self.take(5) == b"UTF-8"

    def take(self, n):
        self.at += n
        return self.raw[self.at - n : self.at]

    def ints(self, n=1):
        return list(struct.unpack(f">{n}i", self.take(4 * n)))

    def item(self):
        flags = self.ints()[0]
        kind = flags & 255
        if kind == 254:
            return None
        if kind == 255:
            return self.symbols[(flags >> 8) - 1]
        if kind == 1:
            self.symbols.append(self.item())
            return self.symbols[-1]
        if kind == 9:
            text = self.take(self.ints()[0]).decode()
            assert flags & (0x40000 if text.isascii() else 0x8000)
            return text
        if kind == 2:
            out = {}
            while flags & 255 == 2:
                assert flags & 0x400
                name = self.item()
                out[name] = self.item()
                flags = self.ints()[0]
            assert flags == 254
            return out
        n = self.ints()[0]
        value = self.ints(n) if kind == 13 else list(struct.unpack(f">{n}d", self.take(8 * n))) if kind == 14 else [self.item() for _ in range(n)]
        assert kind in (13, 14, 16, 19) and bool(flags & 0x200) == bool(flags & 0x100)
        return (value, self.item()) if flags & 0x200 else value


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_rds_layout(spark, tmp_path, parts):
    rows = [(i, f"réad{i}" if i else "r", 16 * (i % 2), i % 2, "+-"[i % 2], 10.0 + i, 20.0 + i, [(1, 0.5, None), (1001, 0.25, 1.0)][: 1 + i % 2], 0.5, None) for i in range(5)]
    df = spark.createDataFrame(rows, "ordinal long, read_id string, flag int, ref_id int, strand string, start double, end double, signalbin array<struct<positions:bigint,signalB:double,signala:double>>, med_signalB double, med_signalbinB double")
    refs = spark.createDataFrame([(0, "chrI", 50), (1, "chrII", 60), (2, "chrM", 9)], "ref_id int, chrom string, length long")
    path = str(tmp_path / "t.rds")
    R.write_rds(df.repartitionByRange(parts, "ordinal").sortWithinPartitions("ordinal"), refs, path)
    assert not list(tmp_path.glob("*.part"))
    parser = Parser(gzip.open(path).read())
    columns, attributes = parser.item()
    assert parser.at == len(parser.raw)
    names = ["read_id", "flag", "chrom", "strand", "start", "end", "signalbin", "med_signalB", "med_signalbinB"]
    assert attributes == {"row.names": [-(1 << 31), -5], "names": names, "class": ["tbl_df", "tbl", "data.frame"]}
    got = dict(zip(names, columns))
    assert got["read_id"] == [r[1] for r in rows] and got["flag"] == [r[2] for r in rows] and got["start"] == [r[5] for r in rows]
    assert got["chrom"] == ([1, 2, 1, 2, 1], {"levels": ["chrI", "chrII", "chrM"], "class": ["factor"]})
    assert got["strand"] == ([1, 2, 1, 2, 1], {"levels": ["+", "-", "*"], "class": ["factor"]})
    for row, (cells, extra) in zip(rows, got["signalbin"]):
        assert extra == {"row.names": [*range(1, len(row[7]) + 1)], "names": ["positions", "signalB", "signala"], "class": ["tbl_df", "tbl", "data.frame"]}
        assert [[None if math.isnan(x) else x for x in c] for c in cells] == [list(c) for c in zip(*row[7])]
    assert got["med_signalB"] == [0.5] * 5 and all(map(math.isnan, got["med_signalbinB"]))


def test_lengths_of_long_vectors():
    assert D.length(5) + D.length((1 << 32) + 7) == struct.pack(">iiii", 5, -1, 1, 7)


def mapping_rows(n=300):
    rng = random.Random(3)
    cells = lambda: [(float(1000 * k + 1), rng.random(), None if k % 3 else rng.random()) for k in range(rng.randint(1, 5))]
    return [(i, f"réad{i // 2}" if i % 5 else f"r{i}", 16 * (i % 2), i % 2, "+-"[i % 2], 10.0 + i, 20.0 + i, cells(), rng.random(), None if i % 9 else 0.25) for i in range(n)]


def saved(spark, path, rows, levels=("chrI", "chrII", "chrM"), names=("signalB", "signala")):
    cell = f"struct<positions:double,{names[0]}:double,{names[1]}:double>"
    df = spark.createDataFrame(rows, f"ordinal long, read_id string, flag int, ref_id int, strand string, start double, end double, signalbin array<{cell}>, med_signal double, med_signalbin double")
    R.write_rds(df.repartitionByRange(3, "ordinal").sortWithinPartitions("ordinal"), spark.createDataFrame([(i, n) for i, n in enumerate(levels)], "ref_id int, chrom string"), str(path))
    return str(path)


def test_saved_tables_are_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "MEMBER_BYTES", 2000)
    monkeypatch.setattr(D, "STEP_ROWS", 64)
    rows = mapping_rows()
    path = saved(spark, tmp_path / "a.rds", rows)
    index = D.index_rds(path)
    assert index.rows == 300 and len(index.members) > 20 and index.columns[2].attributes == {"levels": ["chrI", "chrII", "chrM"], "class": ["factor"]}
    for file in (path, str(tmp_path / "one.rds"), str(tmp_path / "plain.rds")):
        if file != path:  # a single member, and no compression at all
            raw = gzip.open(path).read()
            open(file, "wb").write(gzip.compress(raw) if "one" in file else raw)
        got = D.read_rds(spark, file).orderBy("row").collect()
        none = lambda x: None if x is None or math.isnan(x) else x
        assert [(r.row, r.read_id, r.flag, r.chrom, r.strand, r.start, r.end) for r in got] == [(i, n, f, ["chrI", "chrII"][c], s, a, b) for i, n, f, c, s, a, b, *_ in rows]
        assert [[tuple(map(none, x)) for x in r.signalbin] for r in got] == [r[7] for r in rows] and [(none(r.med_signal), none(r.med_signalbin)) for r in got] == [r[8:] for r in rows]
    empty = saved(spark, tmp_path / "none.rds", rows[:0])
    assert D.read_rds(spark, empty).count() == 0 and D.index_rds(empty).attributes["names"][6] == "signalbin"
    with pytest.raises(D.FormatError):
        open(tmp_path / "cut.rds", "wb").write(gzip.compress(gzip.open(path).read()[:-30]))
        D.index_rds(str(tmp_path / "cut.rds"))


def test_vectors_that_are_saved_in_short_forms(tmp_path):
    sym, chars = lambda n: struct.pack(">i", 1) + D.chars(n), struct.pack
    info = lambda n: chars(">i", 2) + sym(n) + chars(">i", 2) + sym("base") + chars(">i", 2) + D.begin(13, 1) + chars(">i", 13) + chars(">i", 254)
    sequence = chars(">i", 238) + info("compact_intseq") + D.begin(14, 3) + chars(">ddd", 4, 1, 1) + chars(">i", 254)
    wrapped = chars(">i", 238) + info("wrap_real") + D.begin(19, 2) + D.begin(14, 2) + chars(">dd", 1.5, 2.5) + D.begin(13, 1) + chars(">i", 0) + chars(">i", 254)
    (tmp_path / "x").write_bytes(sequence + wrapped + D.chars(None))
    parser = D.Parser(D.Inflated(str(tmp_path / "x")))
    assert parser.item().value.tolist() == [1, 2, 3, 4] and parser.item().value.tolist() == [1.5, 2.5] and parser.text() is None


def test_each_planted_difference_of_files_is_found(spark, tmp_path):
    rows = mapping_rows(60)
    left = saved(spark, tmp_path / "a.rds", rows)
    change = lambda k, **new: [tuple(new.get(n, v) for n, v in zip(("ordinal", "read_id", "flag", "ref_id", "strand", "start", "end", "signalbin", "med_signal", "med_signalbin"), r)) if i == k else r for i, r in enumerate(rows)]
    first = rows[7][7][0]
    files = {
        (): (rows, {}), ("keys", "rows"): (rows[:-1], {}), ("keys",): (change(7, read_id="other"), {}), ("strand",): (change(7, strand="*"), {}), ("end",): (change(7, end=99.0), {}), ("med_signal",): (change(7, med_signal=rows[7][8] * (1 + 1e-9)), {}),
        ("signalbin positions",): (change(7, signalbin=[(first[0] + 1, *first[1:]), *rows[7][7][1:]]), {}), ("signalB",): (change(7, signalbin=[(first[0], first[1] + 1e-6, first[2]), *rows[7][7][1:]]), {}),
        ("signala",): (change(7, signalbin=[(*first[:2], None if first[2] else 0.5), *rows[7][7][1:]]), {}), ("chrom levels",): (rows, {"levels": ("chrI", "chrII", "chrX")}), ("signalbin attributes",): (rows, {"names": ("signalB", "signalc")}),
    }
    for want, (data, extra) in files.items():
        checks = R.compare_files(spark, left, saved(spark, tmp_path / "b.rds", data, **extra))
        assert tuple(sorted(c.what for c in checks if not c.passed)) == tuple(sorted(want)), want
    tiny = saved(spark, tmp_path / "c.rds", change(7, med_signal=rows[7][8] * (1 + 1e-15)))
    assert all(c.passed for c in R.compare_files(spark, left, tiny)) and "DIFFERS" in str([c for c in R.compare_files(spark, left, tiny, tolerance=0.0) if not c.passed][0])
    other = saved(spark, tmp_path / "d.rds", change(7, strand="*"))
    assert rows[7][3] == 1 and all(c.passed for c in R.compare_files(spark, left, other, ["chrI"])) and R.main(["compare", left, other]) == 1 and R.main(["compare", left, left]) == 0
    raw = bytearray(gzip.open(left).read())
    at = raw.index(b"tbl_df", raw.rindex(b"med_signalbin"))
    raw[at : at + 6] = b"tbl_dx"
    open(tmp_path / "e.rds", "wb").write(gzip.compress(bytes(raw)))
    assert [c.what for c in R.compare_files(spark, left, str(tmp_path / "e.rds")) if not c.passed] == ["class"]


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    bad = F.when(F.col("ordinal") == 40, F.raise_error(F.lit("stop"))).otherwise(F.col("flag"))
    df = spark.createDataFrame(mapping_rows(60), "ordinal long, read_id string, flag int, ref_id int, strand string, start double, end double, signalbin array<struct<positions:double,signalB:double,signala:double>>, med_signal double, med_signalbin double")
    with pytest.raises(Exception):
        R.write_rds(df.withColumn("flag", bad.cast("int")), spark.createDataFrame([(0, "x"), (1, "y")], "ref_id int, chrom string"), str(tmp_path / "f.rds"))
    assert not list(tmp_path.iterdir())


def made_track(spark):
    rng = random.Random(2)
    rows = [(k, 50 * i, 50 * i + 50, float(rng.randint(0, 9))) for k, n in ((0, 300_000), (1, 18), (2, 5000)) for i in range(0, n, rng.choice([1, 1, 2]) if n < 9000 else 11)]
    track = spark.createDataFrame(rows, "ref_id int, start long, end long, value float").repartition(3)
    return rows, track, spark.createDataFrame([(0, "chrI", 15_000_000), (1, "chrII", 900), (2, "chrM", 250_000)], "ref_id int, chrom string, length long")


def test_one_chromosome_reads_only_its_sections(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "SECTION_ITEMS", 16)
    rows, track, refs = made_track(spark)
    path = str(tmp_path / "t.bw")
    assert W.write_bigwig(track, refs, path) == len(rows)
    names = ["chrI", "chrII", "chrM"]

    def places(*filters):
        reader = W.BigWigReader(path, 1)
        assert len(list(reader.pushFilters(list(filters)))) == len(filters)  # rows are tested again
        return sum(len(p.places) for p in reader.partitions())

    whole = places()
    assert whole > 1900 and places(EqualTo(("chrom",), "chrII")) == -(-sum(r[0] == 1 for r in rows) // 16) and places(EqualTo(("chrom",), "none")) == 0
    assert places(EqualTo(("chrom",), "chrI"), GreaterThan(("end",), 1_000_000), LessThan(("start",), 1_010_000)) <= 4
    opened = []
    at = W._at
    monkeypatch.setattr(W, "_at", lambda stream, offset, layout: opened.append(layout) or at(stream, offset, layout))
    stream = W.open_file(path)
    W.sections(stream, W.Wanted({1}))
    assert opened.count("<BBH") == 2 < -(-whole // 256)  # the root and one leaf
    some = W.read_bigwig(spark, path).where("chrom = 'chrI' and end > 1000000 and start < 1010000 or chrom = 'chrII'")
    assert sorted((r.chrom, r.start) for r in some.collect()) == sorted((names[k], s) for k, s, e, _ in rows if (k == 0 and e > 1_000_000 and s < 1_010_000) or k == 1)
    some = W.read_bigwig(spark, path).where("chrom in ('chrM', 'chrII') and start >= 100 and value > 3")
    assert sorted((r.chrom, r.start) for r in some.collect()) == sorted((names[k], s) for k, s, _, v in rows if k and s >= 100 and v > 3)


def test_zoom_levels_add_up(spark, tmp_path):
    rows, track, refs = made_track(spark)
    path = str(tmp_path / "t.bw")
    W.write_bigwig(track, refs, path)
    levels = W.zoom_records(path)
    assert list(levels) == list(W.ZOOMS) and len(levels) >= 3
    for size, found in levels.items():
        want = {}
        for k, s, e, v in rows:
            own = want.setdefault((["chrI", "chrII", "chrM"][k], s // size), [s, e, 0, v, v, 0.0, 0.0])
            own[0], own[1], own[2], own[3], own[4], own[5], own[6] = min(own[0], s), max(own[1], e), own[2] + e - s, min(own[3], v), max(own[4], v), own[5] + 50 * v, own[6] + 50 * v * v
        assert {(r[0], r[1] // size): list(r[1:]) for r in found} == want and len(found) == len(want)
    summary = struct.unpack("<Qdddd", open(path, "rb").read()[struct.unpack_from("<Q", open(path, "rb").read(64), 44)[0] :][:40])
    assert summary == (50 * len(rows), 0.0, 9.0, 50 * sum(r[3] for r in rows), 50 * sum(r[3] ** 2 for r in rows))


def test_a_failed_track_leaves_no_file(spark, tmp_path, monkeypatch):
    _, track, refs = made_track(spark)
    bad = track.withColumn("value", F.when(F.col("start") == 5500, F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(Exception):
        W.write_bigwig(bad, refs, str(tmp_path / "t.bw"))
    monkeypatch.setattr(W, "_packed", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        W.write_bigwig(track, refs, str(tmp_path / "t.bw"))
    assert not list(tmp_path.iterdir())
    empty = W.write_bigwig(track.limit(0), refs, str(tmp_path / "e.bw")) if monkeypatch.undo() is None else None
    assert empty == 0 and W.read_bigwig(spark, str(tmp_path / "e.bw")).count() == 0


def test_a_stream_is_kept_in_pieces_and_read_like_a_file(spark, tmp_path):
    path = write(tmp_path / "a.bam", reads(), 300)
    raw = open(path, "rb").read()
    kept = L.spool(io.BytesIO(raw), str(tmp_path / "kept"), 1500)
    starts = L.piece_starts(kept)
    assert len(starts) > 3 and all(raw[a : a + 4] == b"\x1f\x8b\x08\x04" for a in starts)  # pieces are of whole blocks
    pieces = L.open_file(kept)
    pieces.seek(1000)
    assert pieces.size() == len(raw) and pieces.read(2000) == raw[1000:3000] and pieces.tell() == 3000
    plain = lambda p: sorted(map(str, B.read_bam(spark, p).drop("ordinal").collect()))
    assert plain(kept) == plain(path) and len(B.BamReader([kept], 1, False).partitions()) == len(starts)
    assert [r.ordinal for r in B.read_bam(spark, kept).orderBy("ordinal").collect()] == [r.ordinal for r in B.read_bam(spark, path).orderBy("ordinal").collect()]
    L.drop_pieces(kept)
    assert not (tmp_path / "kept.pieces").exists()
    for damaged in (raw[:-5], b"", b"plain text of some length"):
        with pytest.raises(B.FormatError):
            L.spool(io.BytesIO(damaged), str(tmp_path / f"bad{len(damaged)}"))


def test_standard_input_gives_the_results_of_the_file(spark, tmp_path, monkeypatch, capsys):
    path = write(tmp_path / "a.bam", reads(), 300)
    monkeypatch.setattr(R.sys, "stdin", type("In", (), {"buffer": io.BytesIO(open(path, "rb").read())}))
    assert R.main(["run", "-b", "-", "-o", str(tmp_path / "s"), "--bin-size", "100"]) == 0
    log = capsys.readouterr().err
    assert R.main(["run", "-b", path, "-o", str(tmp_path / "f"), "--bin-size", "100"]) == 0
    assert R.main(["compare", str(tmp_path / "s_nanoT_alldata.rds"), str(tmp_path / "f_nanoT_alldata.rds")]) == 0 and R.bw_compare(spark, str(tmp_path / "s.bw"), str(tmp_path / "f.bw"))[1] == 0
    assert "standard input: " in log and re.search(r"read 120 records in [0-9.]+ s \([0-9,]+ a second\)", log) and re.search(r"reading [0-9.]+ s, signal [0-9.]+ s, mappings [0-9.]+ s, coverage [0-9.]+ s, [0-9.]+ s in all", log)


def test_phases_tell_how_far_they_are(spark):
    lines = []
    phases = G.Phases(spark, lines.append, 0.2)
    with phases.phase("slow"):
        spark.range(0, 4, 1, 4).mapInArrow(lambda it: (time.sleep(0.5) or b for b in it), "id long").count()
    with pytest.raises(ValueError), phases.phase("broken"):
        raise ValueError
    assert 0.4 < phases.seconds["slow"] < 60 and any(re.fullmatch(r"slow: \d+ of \d+ tasks", x) for x in lines) and lines[-1].startswith("slow: ") and "broken" in phases.seconds
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_counts_of_a_run(spark, tmp_path):
    mm = text_tag("MM", "T+B?,0;") + bytes_tag("ML", [9])
    over = text_tag("MM", "T+B?,5;") + bytes_tag("ML", [9])
    sa = text_tag("SA", "chrI,1,+,5M,60,0")
    rows = [
        record("a", 0, 0, 0, [("M", 8)], "TTTTAAAA", mm), record("a", 0, 20, 2048, [("M", 8)], "TTTTAAAA", mm + sa), record("b", 0, 0, 0, [("M", 8)], "TTTTAAAA", over),
        record("c", 0, 0, 4, [("M", 8)], "TTTTAAAA", mm), record("d", 0, 0, 256, [("M", 8)], "TTTTAAAA", mm), record("e", -1, 0, 0, [("M", 8)], "TTTTAAAA", mm),
        record("f", 0, 0, 0, [("M", 8)], "TTTTAAAA"), record("g", 2, 0, 0, [("M", 8)], "TTTTAAAA", mm), record("h", 0, 0, 1024, [("M", 8)], "TTTTAAAA", mm), record("i", 0, 0, 0, [("I", 8)], "TTTTAAAA", mm),
    ]
    counts = R.run(spark, write(tmp_path / "a.bam", rows), parquet=str(tmp_path / "out"))
    # of "i" nothing lies on the reference: it is too short to be a candidate
    assert counts == {"records": 10, "mapped": 7, "candidates": 3, "extracted": 2, "mm_overflow": 1, "missing_query": 1, "mappings": 2}
    lines = R.messages(counts)
    assert "1 skipped" in lines[0] and lines[1].startswith("warning: 1") and lines[2].startswith("2 mappings")
    assert len(R.messages(counts | {"mm_overflow": 0, "missing_query": 0})) == 2
    assert spark.read.parquet(f"{tmp_path}/out/mappings").count() == 2


def test_tracks_that_lack_chromosomes(spark, tmp_path):
    for name, refs in (("a", [("x", 100), ("y", 200)]), ("b", [("y", 200), ("z", 300)])):
        table = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(refs)], "ref_id int, chrom string, length long")
        track = spark.createDataFrame([(i, 0, 50, float(ord(name)) if n == "y" else 1.0) for i, (n, _) in enumerate(refs)], "ref_id int, start long, end long, value float")
        W.write_bigwig(track, table, str(tmp_path / f"{name}.bw"))
    rows, total = R.bw_compare(spark, str(tmp_path / "a.bw"), str(tmp_path / "b.bw"))
    assert total == 50 and {r.chrom: (r.diff_bases, r.first_diff, r.only_in) for r in rows.collect()} == {"x": (None, None, "left"), "y": (50, 0, None), "z": (None, None, "right")}


def test_bedgraph(spark, tmp_path):
    R.write_bedgraph(spark.createDataFrame([("x", 0, 50, 1.5)], "chrom string, start long, end long, value float"), str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["x\t0\t50\t1.5"]


def test_command_line():
    args = R.parser().parse_args(["run", "-b", "x.bam", "--mod", "T+B,C+m", "--mod", "A+a"])
    assert args.mod == ["T+B,C+m", "A+a"] and args.max_dist == 15000 and R.main(["run", "-b", "x.bam"]) == 2

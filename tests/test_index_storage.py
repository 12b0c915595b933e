"""Ids and files of an index, FASTA by byte ranges, intervals, and stages that stay."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from phaseloom import storage
from phaseloom.plans import index
from phaseloom.plans.discovery import discover
from phaseloom.schemas import CALL_STATS
from phaseloom.sources import fasta, tables

SITES = f"contig string, position int, ref string, alt string, pop_freqs array<{CALL_STATS}>"


def _entries(spark, contig, n):
    sites = spark.range(n).select(F.lit(contig).alias("contig"), (F.col("id") * 3 + 50).cast("int").alias("position"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), F.lit(None).cast(f"array<{CALL_STATS}>").alias("pop_freqs"))
    freqs = F.array(F.struct(F.lit(1).alias("AC"), F.lit(0.5).alias("AF"), F.lit(2).alias("AN"), F.lit(0).alias("homozygote_count")))
    return index.single_entries(sites.withColumn("pop_freqs", freqs), ["afr"], ["afr"])


@pytest.fixture
def made(spark, tmp_path):
    lines = ["ACGTTGCAAC"] * 100
    (tmp_path / "r.fa").write_text("".join(f">{c} x\n" + "\n".join(lines) + "\n" for c in ("chr1", "chr2", "chr3")))
    head = len(">chr1 x\n")
    (tmp_path / "r.fa.fai").write_text("".join(f"chr{k + 1}\t1000\t{k * (head + 1100) + head}\t10\t11\n" for k in range(3)))
    ix = index.Index(spark, f"file://{tmp_path / 'ix'}")
    ix.create("1", 5, {}, {"chr1": ["afr"]})
    return ix, fasta.Reference(spark, str(tmp_path / "r.fa"), 64)


def test_contigs_are_appended_at_once(spark, made):
    ix, ref = made
    errors: list = []

    def add(contig, n):
        try:
            ix.append(contig, _entries(spark, contig, n), ref, 5)
        except Exception as e:  # noqa: BLE001 - told below
            errors.append(e)

    threads = [threading.Thread(target=add, args=a) for a in (("chr1", 40), ("chr2", 25), ("chr3", 0))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    log = ix.log()
    assert [x["first"] for x in log] == np.cumsum([0, *[x["rows"] for x in log[:-1]]]).tolist() and {x["contig"]: x["rows"] for x in log} == {"chr1": 40, "chr2": 25, "chr3": 0}
    numbers = {(r["contig"], int(r["sequence_id"].rpartition("-")[2])) for r in ix.sequences().collect()}
    assert numbers == {(x["contig"], x["first"] + k) for x in log for k in range(x["rows"])} and ix.count() == 65
    ix.finalize()


def test_a_broken_append_takes_up_its_ids(spark, made):
    ix, ref = made
    assert ix.reserve("chr1", 30) == 0 and ix.reserve("chr2", 7) == 30
    assert ix.reserve("chr1", 30) == 0  # as after a crash
    ix.append("chr2", _entries(spark, "chr2", 7), ref, 5)
    early = ix.sequences()
    with pytest.raises(ValueError, match="chr1"):
        ix.finalize()
    ix.append("chr1", _entries(spark, "chr1", 30), ref, 5)
    assert early.count() == 7 and ix.sequences().count() == 37  # a reader keeps to what was there
    assert {r["sequence_id"] for r in ix.sequences().where("contig = 'chr2'").collect()} == {f"DR-1-{k}" for k in range(30, 37)}


def test_put_if_absent(spark, tmp_path):
    at, won = f"file://{tmp_path}/log/1", []
    threads = [threading.Thread(target=lambda k=k: won.append(k) if storage.put_if_absent(spark, at, str(k)) else None) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and storage.read_text(spark, at) == str(won[0]) and storage.listed(spark, f"file://{tmp_path}/log") == ["1"]


def test_lookups_read_few_files(spark, made, monkeypatch):
    ix, ref = made
    monkeypatch.setattr(index, "BLOCK_ROWS", 8)
    ix.append("chr1", _entries(spark, "chr1", 200), ref, 5)
    assert len(ix.sequences().inputFiles()) == 25
    ids = spark.createDataFrame([(f"DR-1-{k}",) for k in (3, 5, 5, 100, 199, 7000)] + [("other",), (None,), ("DR-2-6",)], "sequence_id string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the scans are hidden in stages
    try:
        found = ix.lookup(ids)
        assert found.columns == ix.sequences().columns
        assert sorted(r["sequence_id"] for r in found.collect()) == ["DR-1-100", "DR-1-199", "DR-1-3", "DR-1-5"]
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        files = [m.get().value() for k in range(leaves.size()) if (m := leaves.apply(k).metrics().get("numFiles")).isDefined()]
        assert files == [3]  # of 25
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    monkeypatch.setattr(index, "BLOCKS_NAMED", 1)
    assert ix.lookup(ids).count() == 4


def test_fasta_by_ranges(spark, tmp_path):
    rng = np.random.default_rng(1)
    contigs = {f"c{k}": "".join(rng.choice(list("ACGTacgt"), n)) for k, (n) in enumerate([995, 1, 60, 61, 2000])}
    text, fai = b"", []
    for k, (name, seq) in enumerate(contigs.items()):
        end = b"\r\n" if k == 4 else b"\n"
        text += f">{name} of test".encode() + end
        fai.append(f"{name}\t{len(seq)}\t{len(text)}\t60\t{60 + len(end)}")
        text += b"".join(seq[j : j + 60].encode() + end for j in range(0, len(seq), 60))
    (tmp_path / "r.fa").write_bytes(text)
    needed = spark.createDataFrame([(c, k) for c in [*contigs, "none"] for k in (0, 1, 3, 3, 19, 40, -1)], "contig string, chunk int")
    without = fasta.Reference(spark, str(tmp_path / "r.fa"), 100)
    assert not without.indexed
    want = {(c, k): s[k * 100 : k * 100 + 100].upper() for c, s in contigs.items() for k in (0, 1, 3, 19) if k * 100 < len(s)}
    if "\r" not in text.decode():
        assert {(r["contig"], r["chunk"]): r["seq"] for r in without.chunks(needed).collect()} == want
    (tmp_path / "r.fa.fai").write_text("\n".join(fai) + "\n")
    ref = fasta.Reference(spark, str(tmp_path / "r.fa"), 100)
    assert ref.indexed and not fasta.Reference(spark, f"{tmp_path}/r.fa.gz").indexed
    rows = ref.chunks(needed).collect()
    assert {(r["contig"], r["chunk"]): r["seq"] for r in rows} == want and len(rows) == len(want)
    at = spark.createDataFrame([(0, "c0", 90, 320), (1, "c4", 1990, 2500), (2, "c1", 1, 1)], "row_id long, contig string, a int, b int")
    found = {r["row_id"]: r for r in fasta.with_bases(at, ref, "a", "b").collect()}
    assert contigs["c0"][89:320].upper() in found[0]["base"] and found[1]["base"] == contigs["c4"][1900:].upper() and found[2]["base"] == contigs["c1"].upper()
    (tmp_path / "r.fa").write_bytes(text[:-500])
    with pytest.raises(Exception, match="another file"):
        ref.chunks(needed).collect()


def test_one_fasta_file_by_tasks(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 50)), f"DR-{k}", "".join(rng.choice(list("ACGT"), rng.integers(0, 90)))) for k in range(700)]
    df = spark.createDataFrame(rows, "start long, sequence_id string, sequence string").repartition(6)
    fasta.write_fasta_file(df, f"file://{tmp_path}/a.fa")
    assert fasta.write_fasta(df, tmp_path / "b.fa") == 700
    whole = (tmp_path / "a.fa").read_bytes()
    assert whole == (tmp_path / "b.fa").read_bytes()
    seqs = {i: s for _, i, s in rows}
    told = [x.split("\t") for x in (tmp_path / "a.fa.fai").read_text().splitlines()]
    assert [t[0] for t in told] == [i for _, i, _ in sorted(rows, key=lambda r: (r[0], r[1]))]
    assert all(whole[int(o) : int(o) + int(n)].decode() == seqs[i] and n == a and int(b) == int(n) + 1 for i, n, o, a, b in told)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a.fa", "a.fa.fai", "b.fa"]
    with pytest.raises(Exception, match="no single file|No FileSystem|Mount table"):
        fasta.write_fasta_file(df, "viewfs://none/a.fa")


def test_masked_reference(spark, tmp_path):
    contigs = {"c0": "ACGTTGCAAC" * 50, "c1": "GATTACA", "c2": "A" * 123}
    text, fai = "", []
    for name, seq in contigs.items():
        text += f">{name}\n"
        fai.append(f"{name}\t{len(seq)}\t{len(text)}\t50\t51\n")
        text += "".join(seq[j : j + 50] + "\n" for j in range(0, len(seq), 50))
    (tmp_path / "r.fa").write_text(text)
    (tmp_path / "r.fa.fai").write_text("".join(fai))
    windows = [("c0", 5, 9), ("c0", 8, 300), ("c0", 290, 291), ("c0", 499, 700), ("c1", -5, 2), ("c1", 4, 3), ("c9", 1, 9), ("c0", 430, 440)]
    for chunk in (20, 45, 1000):
        out = fasta.masked(fasta.Reference(spark, str(tmp_path / "r.fa"), chunk), spark.createDataFrame(windows, "contig string, start long, end long"), 20)
        lines: dict = {}
        for r in out.orderBy("contig", "line_no").collect():
            lines.setdefault(r["contig"], []).append(r["text"])
            assert len(lines[r["contig"]]) == r["line_no"] + 1
        seen = {c: [any(w == c and a <= k + 1 <= b for w, a, b in windows) for k in range(len(s))] for c, s in contigs.items()}
        want = {c: "".join(x if ok else "N" for x, ok in zip(s, seen[c], strict=True)) for c, s in contigs.items()}
        assert {c: "".join(v) for c, v in lines.items()} == want and all(len(x) == 20 for v in lines.values() for x in v[:-1])


def test_many_intervals(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(f"c{rng.integers(0, 4)}", int(rng.integers(1, 200_000))) for _ in range(3000)] + [(None, 5), ("c1", None)]
    spans = [(f"c{rng.integers(0, 3)}", int(a), int(a + rng.integers(-2, 90))) for a in rng.integers(1, 200_000, 600)] + [("c0", 1, 60_000), (None, 1, 9), ("c1", None, 5), ("c1", 7, None)]
    df = spark.createDataFrame(rows, "contig string, position int")
    got = tables.in_intervals(df, spark.createDataFrame(spans, "contig string, start int, end int"))
    want = sorted(r for r in rows if None not in r and any(None not in s and s[0] == r[0] and s[1] <= r[1] <= s[2] for s in spans))
    assert sorted(map(tuple, got.collect())) == want
    monkeypatch.setattr(tables, "CONTIGS_NAMED", 1)
    assert sorted(map(tuple, tables.in_intervals(df, spark.createDataFrame(spans, "contig string, start int, end int")).collect())) == want
    assert tables.in_intervals(df, spark.createDataFrame([], "contig string, start int, end int")).count() == 0


def test_a_broken_run_goes_on(spark, tmp_path):
    """What was complete before a run broke is read again, and other inputs or parameters have other stages."""
    samples = spark.createDataFrame([(k, f"s{k}", "afr", "XX") for k in range(4)], "ordinal int, s string, pop string, sex_karyotype string")
    sites = spark.createDataFrame([("chr1", p, "A", "T", [(1, 0.5, 4, 0)]) for p in range(100, 160, 10)], SITES)
    calls = [("chr1", p, "A", "T", [((p // 10 + k) % 2, 1) for k in range(4)]) for p in range(100, 160, 10)]
    genotypes = spark.createDataFrame(calls, "contig string, position int, ref string, alt string, gt array<struct<a:tinyint,b:tinyint>>")
    (tmp_path / "in").write_text("x")
    key = storage.inputs_key(spark, [str(tmp_path / "in")], {"window": 25})
    assert key == storage.inputs_key(spark, [str(tmp_path / "i*")], {"window": 25}) != storage.inputs_key(spark, [str(tmp_path / "in")], {"window": 26})
    stages = storage.Stages(spark, f"file://{tmp_path}/stages", key)

    def breaks(make, name):
        if name == "metrics":
            raise RuntimeError("lost")
        return stages(make, name)

    with pytest.raises(RuntimeError, match="lost"):
        discover(genotypes, samples, sites, ["afr"], 25, 0.1, 0.0, breaks)
    done = {n: storage.listed(spark, f"file://{tmp_path}/stages/{key}/{n}") for n in ("variants", "calls", "carriers", "blocks")}
    assert all("_SUCCESS" in files for files in done.values())
    broken = genotypes.withColumn("position", F.raise_error(F.lit("read again")).cast("int"))
    again = discover(broken, samples, sites, ["afr"], 25, 0.1, 0.0, stages)
    whole = discover(genotypes, samples, sites, ["afr"], 25, 0.1, 0.0)
    assert sorted(map(str, again.select(whole.columns).collect())) == sorted(map(str, whole.collect())) and again.count() > 0
    assert done == {n: storage.listed(spark, f"file://{tmp_path}/stages/{key}/{n}") for n in done}
    (tmp_path / "in").write_text("longer")
    assert key != storage.inputs_key(spark, [str(tmp_path / "in")], {"window": 25})
    storage.delete(spark, f"file://{tmp_path}/stages/{key}/found/_SUCCESS")
    assert discover(broken, samples, sites, ["afr"], 25, 0.1, 0.0, stages).count() == whole.count()

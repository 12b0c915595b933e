"""Block-gzipped text: splits, lines over members and splits, chance occurrences of a member's first bytes, broken files."""

import glob
import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from phaseloom.sources import bgzf, vcf


@pytest.fixture
def splits_of(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def _lines(spark, path):
    return sorted(r[0] for r in bgzf.read_lines(spark, str(path)).collect())


@pytest.mark.parametrize(("n", "longest", "step"), [(0, 1, 9), (1, 1, 9), (50, 5, 7), (1000, 300, 3000), (200, 9000, 1000), (12, 90_000, 20_000)])
@pytest.mark.parametrize("end", ["", "\n"])
def test_lines_meet_over_splits(spark, splits_of, tmp_path, n, longest, step, end):
    rng = random.Random(n)
    lines = [f"line {k} " + "".join(rng.choices("abcdefghé", k=rng.randrange(longest))) for k in range(n)]
    data = ("\n".join(lines) + (end if n else "")).encode()
    whole = b"".join(bgzf.member(data[k : k + step]) for k in range(0, len(data), step)) + bgzf.EMPTY
    assert gzip.decompress(whole) == data
    (tmp_path / "a.bgz").write_bytes(whole)
    for part in (10**6, max(150, len(whole) // 40)):
        splits_of(part)
        assert _lines(spark, tmp_path / "a.bgz") == sorted(lines)
    splits_of(len(whole) // 8 + 1)
    if n >= 1000:
        assert bgzf.read_lines(spark, str(tmp_path / "a.bgz")).select(F.spark_partition_id()).distinct().count() > 6


def test_first_bytes_within_members(spark, splits_of, tmp_path):
    def odd(data, times):
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(data) + packer.flush()
        extra = b"ZZ" + struct.pack("<H", 4 * times + 13) + bgzf.MAGIC * times + b"x" * 13 + b"BC\2\0"
        size = 12 + len(extra) + 2 + len(body) + 8
        return bgzf.MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H", len(extra) + 2) + extra + struct.pack("<H", size - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))

    data = "".join(f"line {k} {k * k}\n" for k in range(400)).encode()
    whole = b"".join(odd(data[k : k + 100], 1 + k // 100 % 7) for k in range(0, len(data), 100)) + bgzf.EMPTY
    assert gzip.decompress(whole) == data
    (tmp_path / "a.bgz").write_bytes(whole)
    for part in (10**6, 1000, 333, 61):
        splits_of(part)
        assert _lines(spark, tmp_path / "a.bgz") == sorted(data.decode().splitlines())


@pytest.mark.parametrize("whole", [b"plain text\n", gzip.compress(b"a\nb\n"), bgzf.member(b"a\nb\n" * 99)[:-9] + bgzf.EMPTY, (bgzf.member(b"a\nb\n" * 99) * 3)[:-4]])
def test_broken_files(spark, tmp_path, whole):
    (tmp_path / "a.bgz").write_bytes(whole)
    with pytest.raises(Exception, match=r"block-gzipped|broken|decompressing|incorrect"):
        _lines(spark, tmp_path / "a.bgz")


def test_written_by_tasks(spark, splits_of, tmp_path):
    rows = spark.range(30_000).select(F.concat(F.lit("row "), "id").alias("t")).repartition(3)
    bgzf.write_lines(rows, "t", f"{tmp_path}/w", "#head\n#more")
    want = sorted([f"row {k}" for k in range(30_000)] + ["#head", "#more"] * 3)
    files = glob.glob(f"{tmp_path}/w/part*")
    assert len(files) == 3 and all(open(f, "rb").read().endswith(bgzf.EMPTY) for f in files)
    assert sorted(x for f in files for x in gzip.decompress(open(f, "rb").read()).decode().splitlines()) == want
    splits_of(20_000)
    assert _lines(spark, tmp_path / "w") == want


def test_calls_in_splits_equal_those_of_the_whole(spark, splits_of, tmp_path):
    head = "##fileformat=VCFv4.2\n" + "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *[f"s{k}" for k in range(50)]]) + "\n"
    body = "".join(f"chr1\t{k}\t.\tA\tC\t.\t.\t.\tGT\t" + "\t".join(f"{(k + j) % 2}|{k * j % 2}" for j in range(50)) + "\n" for k in range(1, 1500))
    data = (head + body).encode()
    (tmp_path / "a.vcf.bgz").write_bytes(b"".join(bgzf.member(data[k : k + 5000]) for k in range(0, len(data), 5000)) + bgzf.EMPTY)
    (tmp_path / "a.vcf.gz").write_bytes(gzip.compress(data))
    splits_of(1500)
    got, names = vcf.read_vcf(spark, f"{tmp_path}/a.vcf.bgz")
    want, _ = vcf.read_vcf(spark, f"{tmp_path}/a.vcf.gz", 3)
    assert got.select(F.spark_partition_id()).distinct().count() > 5 and names.count() == 50
    assert sorted(got.collect()) == sorted(want.collect())

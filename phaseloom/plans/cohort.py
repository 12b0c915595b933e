"""A phased cohort on the driver's tables, as the files that discovery and index start from: nations are samples, parts variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phaseloom.plans.discovery import discover
from phaseloom.plans.model import POPS, WINDOW, table
from phaseloom.sources import bgzf
from phaseloom.sources.vcf import read_vcf
from phaseloom.sources.fasta import write_at
from phaseloom.storage import by_shuffle, file_system, listed, new_path, stored, write_text

THRESHOLD, N_SAMPLES = 0.05, 25

#: A part's variant, in both dialects; those of p % 13 = 0 have two alternate alleles in the VCF and are no sites.
VARIANT = {
    "contig": "CASE WHEN p % 2 = 0 THEN 'chr1' ELSE 'chrX' END",
    "position": "CAST(CASE WHEN p % 2 = 0 THEN 100 ELSE 3000000 END + (p // 2) * 10 AS INT)",
    "ref": "substr('ACGTACG', CAST(1 + p % 4 AS INT), CAST(1 + p % 3 AS INT))",
    "alt": "CASE WHEN p % 5 = 0 THEN substr('ACGTACG', CAST(1 + p % 4 AS INT), CAST(1 + p % 3 AS INT)) || 'TT' ELSE 'N' END",
}
AF = "CASE WHEN (p + k) % 11 > 0 THEN CAST((p * 7 + k * 13) % 50 AS DOUBLE) / 100 END"


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("p"))
    return parts.selectExpr("p", *[f"{e.replace('p // 2', 'p div 2')} AS {n}" for n, e in VARIANT.items()])


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of parts with statistics in the order of POPS; two in nine parts and those of p % 13 = 0 have none."""
    freqs = [F.expr(f"named_struct('AC', cast(p % 100 as int), 'AF', {AF.replace('k', str(k))}, 'AN', 100, 'homozygote_count', 0)") for k in range(len(POPS))]
    rows = _variants(spark, sf_dir).where("p % 9 > 1 AND p % 13 > 0")
    return rows.select("contig", "position", "ref", "alt", F.array(*freqs).alias("pop_freqs"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s, pop and sex_karyotype of the nations."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("n"), F.col("n_regionkey").cast("int").alias("k"))
    name = F.get(F.array(*[F.lit(p) for p in POPS]), F.col("k"))
    return nations.select(F.concat(F.lit("s"), F.col("n").cast("string")).alias("s"), name.alias("pop"), F.when(F.col("n") % 2 == 1, "XY").otherwise("XX").alias("sex_karyotype"))


def write_vcf(spark: SparkSession, sf_dir: str) -> str:
    """Block-gzipped VCF files, each with its header, of what nations' customers ordered: large line items are alternate alleles. Returns their glob."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 25").select("l_orderkey", F.col("l_partkey").cast("long").alias("p"), (F.col("l_linenumber") % 2).cast("int").alias("strand"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("int").alias("n"))
    carried = lines.join(by_shuffle(orders), F.col("l_orderkey") == F.col("o_orderkey")).join(by_shuffle(people), F.col("o_custkey") == F.col("c_custkey"))
    sets = carried.groupBy("p").agg(F.collect_set(F.col("n") * 2 + F.col("strand")).alias("alts"))  # 50 at most
    has = lambda k: F.coalesce(F.array_contains("alts", k), F.lit(False)).cast("int").cast("string")
    missing = lambda n: (F.col("p") + n) % 17 == 0
    calls = [F.concat(has(2 * n), F.lit("|"), F.when(missing(n), ".").otherwise(has(2 * n + 1))) for n in range(N_SAMPLES)]
    dot = F.lit(".")
    alt = F.when(F.col("p") % 13 == 0, "C,G").otherwise(F.col("alt"))
    row = F.concat_ws("\t", "contig", F.col("position").cast("string"), dot, "ref", alt, dot, dot, dot, F.lit("GT"), *calls)
    rows = _variants(spark, sf_dir).join(by_shuffle(sets), "p", "left").select((F.col("p") % 4).cast("int").alias("file"), F.col("p").alias("at"), row.alias("value"))
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *[f"s{n}" for n in range(N_SAMPLES)]])
    path = new_path(spark, "vcf")
    bgzf.write_lines(rows.repartitionById(4, F.col("file")).sortWithinPartitions("at"), "value", path, "##fileformat=VCFv4.2\n" + head)
    return f"{path}/part-*"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Haplotypes found in the VCF files, stored."""
    genotypes, names = read_vcf(spark, write_vcf(spark, sf_dir), block_gzip=True)
    people = names.join(samples(spark, sf_dir), "s")
    return stored(discover(genotypes, people, sites(spark, sf_dir), POPS, WINDOW, THRESHOLD, 0.0), "catalog")


#: Bases of the made reference, 60 a line.
BASES, LINE = "CAST(ord(substr('ACGTTGCAACGTGATTACA', CAST(1 + (i * i + i // 5) % 19 AS INT), 1)) AS INT)", 60


def write_fasta(spark: SparkSession, sf_dir: str) -> str:
    """A FASTA file of chr1, long enough for all parts, and a short contig, with its .fai. Tasks write the lines at their places where disks are shared."""
    n = (table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] // 2) * 10 + 300
    lines_n = -(-n // LINE)
    line = "array_join(transform(sequence(0, 59), j -> substr('ACGTTGCAACGTGATTACA', cast(1 + ((id * 60 + j) * (id * 60 + j) + (id * 60 + j) div 5) % 19 as int), 1)), '')"
    head, after = ">chr1 made\n", len(">chr1 made\n") + lines_n * (LINE + 1)
    lines = spark.range(0, lines_n).selectExpr(f"{len(head)}L + id * {LINE + 1} AS at", f"concat({line}, '\\n') AS record")
    heads = spark.createDataFrame([(0, head), (after, ">chrS\nACGTN\n")], "at long, record string")
    folder = new_path(spark, "fasta")
    path = f"{folder}/reference.fa"
    fai = f"chr1\t{lines_n * LINE}\t{len(head)}\t{LINE}\t{LINE + 1}\nchrS\t5\t{after + 6}\t5\t6\n"
    write_text(spark, f"{path}.fai", fai)
    fs, at = file_system(spark, path)
    if fs.getScheme() == "file":
        write_at(lines.unionByName(heads), "record", after + 12, at.toUri().getPath())
    else:  # a store without files that tasks share
        parts = lines.unionByName(heads).orderBy("at").select(F.expr("substring(record, 1, length(record) - 1)"))
        parts.coalesce(1).write.text(f"{path}.parts")
        name = next(x for x in listed(spark, f"{path}.parts") if x.startswith("part-"))
        fs.rename(file_system(spark, f"{path}.parts/{name}")[1], at)
    return path

"""Commands over Parquet tables: python -m phaseloom.cli COMMAND --help."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phaseloom import storage
from phaseloom.plans import compare, extract, index, remap
from phaseloom.plans.discovery import discover
from phaseloom.schemas import HITS
from phaseloom.session import session
from phaseloom.sources import fasta, tables, vcf

POPS = ["afr", "amr", "eas", "sas", "nfe"]


def _legend(spark: SparkSession, path: str) -> list[str]:
    """The legend beside a table, read without its rows."""
    return list(spark.read.parquet(f"{path}.legend").first()["pops"])


def _save(df: DataFrame, path: str, files: int | None, pops: list[str] | None = None) -> None:
    (df.coalesce(files) if files else df).write.mode("overwrite").parquet(path)
    if pops is not None:
        df.sparkSession.createDataFrame([(pops,)], "pops array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}.legend")


def extract_sites(spark, a) -> None:
    meta = json.loads(a.freq_meta)
    _save(extract.extract_sites(spark.read.parquet(a.table), meta, a.populations, a.contig, a.freq_threshold), a.out, 4, a.populations)


def extract_single(spark, a) -> None:
    if not (a.out or a.out_tsv):
        raise ValueError("no output given")
    out = extract.extract_single(spark.read.parquet(a.table), json.loads(a.freq_meta), extract.RELEASES[a.release], a.populations, a.contig, a.freq_threshold, not a.no_apply_filters)
    if a.out:
        _save(out, a.out, 4, a.populations)
    if a.out_tsv:
        tables.write_tsv(extract.single_tsv(out, a.populations), a.out_tsv, block_gzip=a.out_tsv.endswith(".bgz"))


def extract_samples(spark, a) -> None:
    _save(extract.extract_samples(spark.read.parquet(a.table)), a.out, 1)


def compute_haplotypes(spark, a) -> None:
    pops = _legend(spark, a.sites)
    genotypes, names = vcf.read_vcf(spark, a.vcfs, a.min_partitions, a.block_gzip or None)
    people = names.join(spark.read.parquet(a.samples), "s", "left")
    counts = extract.sample_counts(people, pops).first()
    print(f"dropped {counts['dropped']} of {counts['total']} samples whose population is none of {pops}")
    people = people.where(F.col("pop").isin(pops))
    stage = storage.unnamed
    if a.stages:  # these stay, so that a run that broke goes on
        settings = [pops, a.window_size, a.variant_freq_threshold, a.haplotype_freq_threshold]
        stage = storage.Stages(spark, a.stages, storage.inputs_key(spark, [a.vcfs, a.sites, a.samples], {"settings": settings}))
    found = discover(genotypes, people, spark.read.parquet(a.sites), pops, a.window_size, a.variant_freq_threshold, a.haplotype_freq_threshold, stage)
    _save(found, a.out, None, pops)


def init_index(spark, a) -> None:
    pairs = tables.read_table_pairs(spark, a.table_pairs)
    haplotypes = {c: _legend(spark, h) if h else None for c, h, _ in pairs}
    index.Index(spark, a.index).create(a.version, a.window_size, haplotypes, {c: _legend(spark, s) for c, _, s in pairs}, a.force)


def append_contig(spark, a) -> None:
    pairs = {c: (h, s) for c, h, s in tables.read_table_pairs(spark, a.table_pairs)}
    if a.contig not in pairs:
        raise ValueError(f"{a.contig} is not in {a.table_pairs}")
    haplotypes, sites = pairs[a.contig]
    ix = index.Index(spark, a.index)
    joint, site_pops = ix.legend("joint_pops_legend"), _legend(spark, sites)
    entries = index.single_entries(spark.read.parquet(sites).where(F.col("contig") == a.contig), site_pops, joint)
    own = _legend(spark, haplotypes) if haplotypes else None
    if haplotypes:
        entries = index.haplotype_entries(spark.read.parquet(haplotypes), own, joint).unionByName(entries)
    ix.append(a.contig, entries, fasta.Reference(spark, a.reference_fasta), a.window_size, own, site_pops)
    if a.out_tsv:
        ix.export_tsv(a.contig, a.out_tsv)


def finalize_index(spark, a) -> None:
    index.Index(spark, a.index).finalize()


def create_fasta(spark, a) -> None:
    index.Index(spark, a.index).export_fasta(a.contigs, a.out, a.how)


def remap_hits(spark, a) -> None:
    ix = index.Index(spark, a.index or index.find_index())
    hits = spark.read.option("sep", a.separator).option("header", True).csv(a.hits)
    numbered = tables.checked(hits, HITS).withColumn("_row", F.monotonically_increasing_id())
    meta = ix.meta()
    out = remap.remap(numbered, ix.lookup(numbered, "chromosome"), meta["window_size"], json.loads(meta["joint_pops_legend"]))
    tables.write_tsv(out.orderBy("_row").drop("_row"), a.out, quoted=True)


def compare_indexes(spark, a) -> None:
    """Metrics of two indexes' haplotypes as a tab-separated table."""
    old, new = (compare.haplotypes_of(index.Index(spark, path).sequences(), a.contigs) for path in (a.old, a.new))
    on_x = index.Index(spark, a.new).sequences().where((F.col("source") == index.HAPLOTYPE) & (F.col("contig") == "chrX"))
    tables.write_tsv(compare.summary(old, new, old.select(F.explode("haplotype").alias("member")), new_on_x=on_x), a.out, one_file=True)


def subsample(spark, a) -> None:
    targets = {(p, k): n for p, k, n in json.loads(a.targets)}
    picked = extract.stratified_sample(spark.read.parquet(a.samples), targets, a.seed)
    _save(picked, a.out, 1)
    tables.write_lines(picked, "s", a.out_ids)
    if a.sites:
        _save(spark.read.parquet(a.sites).where(tables.in_interval(a.interval)), a.out_sites, 4)


#: Command: function and arguments (name, type, default; no default: required).
COMMANDS = {
    "extract-sites": (extract_sites, [("table", str), ("freq-meta", str), ("contig", str), ("out", str), ("freq-threshold", float, 0.001), ("populations", list, POPS)]),
    "extract-single": (
        extract_single,
        [("table", str), ("freq-meta", str), ("release", str), ("contig", str), ("freq-threshold", float, 0.0), ("no-apply-filters", bool, False), ("populations", list, POPS), ("out", str, None), ("out-tsv", str, None)],
    ),
    "extract-samples": (extract_samples, [("table", str), ("out", str)]),
    "compute-haplotypes": (
        compute_haplotypes,
        [("vcfs", str), ("sites", str), ("samples", str), ("window-size", int), ("variant-freq-threshold", float), ("haplotype-freq-threshold", float), ("out", str), ("min-partitions", int, 64), ("block-gzip", bool, False), ("stages", str, None)],
    ),
    "init-index": (init_index, [("table-pairs", str), ("index", str), ("version", str), ("window-size", int), ("force", bool, False)]),
    "append-contig": (append_contig, [("table-pairs", str), ("contig", str), ("index", str), ("reference-fasta", str), ("window-size", int), ("out-tsv", str, None)]),
    "finalize-index": (finalize_index, [("index", str)]),
    "create-fasta": (create_fasta, [("index", str), ("out", str), ("contigs", list), ("how", str, "parts")]),
    "remap": (remap_hits, [("hits", str), ("out", str), ("index", str, None), ("separator", str, "\t")]),
    "compare": (compare_indexes, [("old", str), ("new", str), ("contigs", list), ("out", str)]),
    "subsample": (subsample, [("samples", str), ("targets", str), ("out", str), ("out-ids", str), ("seed", int, 0), ("sites", str, None), ("interval", str, None), ("out-sites", str, None)]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="phaseloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name, (_, arguments) in COMMANDS.items():
        own = commands.add_parser(name)
        own.add_argument("--driver-gb", type=int, default=1)
        own.add_argument("--executor-gb", type=int, default=1)
        own.add_argument("--gcs-key-file")
        own.add_argument("--store", choices=["s3", "gcs"])
        own.add_argument("--connector-jars")
        for arg, kind, *default in arguments:
            how = {"action": "store_true"} if kind is bool else {"nargs": "+"} if kind is list else {"type": kind}
            own.add_argument(f"--{arg}", required=not default, **how, **({"default": default[0]} if default and kind is not bool else {}))
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = session("phaseloom", driver_gb=a.driver_gb, executor_gb=a.executor_gb, gcs_key_file=a.gcs_key_file, store=a.store, jars=a.connector_jars)
    try:
        COMMANDS[a.command][0](spark, a)
    finally:
        storage.clear(spark)


if __name__ == "__main__":
    main()

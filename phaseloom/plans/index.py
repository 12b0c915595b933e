"""The sequence index: a Parquet folder with one partition a contig and a metadata table."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phaseloom import legends, schemas
from phaseloom.functions.variants import coordinates, compose, haplotype_filter, render, render_all
from phaseloom.operators.ordering import numbered
from phaseloom.sources.fasta import CHUNK, Reference, with_bases, write_fasta, write_fasta_file, write_fasta_parts
from phaseloom.sources.tables import id_number, write_tsv
from phaseloom.storage import delete, exists, listed, put_if_absent, read_text, stored, write_text

HAPLOTYPE, SINGLE = "HGDP_haplotype", "gnomAD_variant"
LEGENDS = ("hgdp_haplotype_pops_legend", "gnomad_variant_pops_legend", "joint_pops_legend")


def _moved(freqs: Column, places: list[int]) -> Column:
    """A positional array in the joint legend's order; places it lacks are null."""
    return F.array(*[F.get(freqs, F.lit(k)) if k >= 0 else F.lit(None) for k in places])


def haplotype_entries(haplotypes: DataFrame, pops: list[str], joint: list[str]) -> DataFrame:
    """Index entries of haplotypes (gnomad_freqs and metrics by the haplotypes' own legend), populations moved to the joint legend."""
    to_joint = F.array(*[F.lit(k) for k in legends.positions(pops, joint)])
    at_joint = legends.positions(joint, pops)
    entry = lambda f: F.struct(
        F.get(to_joint, f["pop"]).alias("pop"), f["empirical_AC"], f["empirical_AF"], f["fraction_phased"], f["estimated_gnomad_AF"]
    )
    return haplotypes.select(
        F.lit(HAPLOTYPE).alias("source"),
        "variants",
        F.transform("gnomad_freqs", lambda f: _moved(F.transform(f, lambda x: x["AF"]), at_joint)).alias("afs"),
        F.get(to_joint, F.col("max_pop")).alias("max_pop"),
        F.col("max_empirical_AF").alias("popmax_empirical_AF"),
        F.col("max_empirical_AC").alias("popmax_empirical_AC"),
        F.col("fraction_phased").alias("popmax_fraction_phased"),
        F.col("estimated_gnomad_AF").alias("popmax_estimated_gnomad_AF"),
        F.transform("all_pop_freqs", entry).alias("all_pop_freqs"),
    )


def single_entries(sites: DataFrame, site_pops: list[str], joint: list[str]) -> DataFrame:
    """Single variants as one-member haplotypes: all phased, estimated at their own frequency."""
    at_joint = legends.positions(joint, site_pops)
    to_joint = legends.positions(site_pops, joint)
    afs = F.transform("pop_freqs", lambda f: f["AF"])
    best = (F.array_position(F.col("_afs"), F.array_max("_afs")) - 1).cast("int")
    top = lambda s: F.get("pop_freqs", F.col("_best"))[s]
    each = [
        F.struct(
            F.lit(k).alias("pop"),
            F.get("pop_freqs", F.lit(i))["AC"].cast("long").alias("empirical_AC"),
            F.get("pop_freqs", F.lit(i))["AF"].alias("empirical_AF"),
            F.lit(1.0).alias("fraction_phased"),
            F.get("pop_freqs", F.lit(i))["AF"].alias("estimated_gnomad_AF"),
        )
        for i, k in enumerate(to_joint)
    ]
    return sites.withColumn("_afs", afs).withColumn("_best", best).select(
        F.lit(SINGLE).alias("source"),
        F.array(F.struct("contig", "position", "ref", "alt")).alias("variants"),
        F.array(_moved(F.col("_afs"), at_joint)).alias("afs"),
        F.get(F.array(*[F.lit(k) for k in to_joint]), F.col("_best")).alias("max_pop"),
        top("AF").alias("popmax_empirical_AF"),
        top("AC").cast("long").alias("popmax_empirical_AC"),
        F.lit(1.0).alias("popmax_fraction_phased"),
        top("AF").alias("popmax_estimated_gnomad_AF"),
        F.array(*each).alias("all_pop_freqs"),
    )


def af_text(afs: Column) -> Column:
    """Frequencies with five digits, NA where missing, joined by commas."""
    return F.array_join(F.transform(afs, lambda x: F.when(x.isNull(), "NA").otherwise(F.format_string("%.5f", x))), ",")


def sequences(entries: DataFrame, reference: DataFrame | Reference, joint: list[str], window: int, version: str, offset: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The index rows of one contig: total order (first position, source, variants), ids from offset, sequence, window and flags."""
    named = entries.withColumn("contig", F.element_at("variants", 1)["contig"]).withColumn("_names", render_all(F.col("variants")))
    first = F.array_min(F.transform("variants", lambda v: v["position"]))
    rows = numbered(named.withColumn("_first", first), ["_first", "source", "_names"], "idx", offset, by=("contig",))
    start, end = coordinates(F.col("variants"), window)
    placed = rows.withColumn("start", start).withColumn("end", end).withColumn("row_id", F.col("idx"))
    based = with_bases(placed.withColumn("_from", F.col("start") + 1).withColumn("_to", F.col("end")), reference, "_from", "_to", chunk)
    by_pop = F.map_from_entries(F.transform("all_pop_freqs", lambda f: F.struct(f["pop"], f)))
    rows = based.withColumn("sequence", compose(F.col("variants"), window, F.col("base"), F.col("base_start"))).withColumn("_by", by_pop)
    of = lambda k: F.transform("afs", lambda a: F.get(a, F.lit(k)))
    cells = [af_text(of(k)).alias(f"gnomAD_AF_{p}") for k, p in enumerate(joint)]
    for k, p in enumerate(joint):
        f = F.try_element_at("_by", F.lit(k))
        cells += [
            f["empirical_AC"].alias(f"empirical_AC_{p}"),
            f["empirical_AF"].alias(f"empirical_AF_{p}"),
            f["fraction_phased"].alias(f"fraction_phased_{p}"),
            f["estimated_gnomad_AF"].alias(f"estimated_gnomAD_haplotype_AF_{p}"),
        ]
    one = (F.col("source") == SINGLE) | (F.size("variants") < 2)
    rows = rows.withColumn("_n", F.size("variants")).withColumn("_filter", F.when(one, "PASS").otherwise(haplotype_filter(F.col("variants"))))
    return rows.select(
        "sequence",
        F.length("sequence").cast("long").alias("sequence_length"),
        F.concat(F.lit(f"DR-{version}-"), F.col("idx").cast("string")).alias("sequence_id"),
        F.col("idx").alias("id_number"),
        F.col("_n").cast("long").alias("n_variants"),
        "contig",
        "start",
        "end",
        "popmax_empirical_AF",
        "popmax_empirical_AC",
        "source",
        "popmax_estimated_gnomad_AF",
        "popmax_fraction_phased",
        F.get(F.array(*[F.lit(p) for p in joint]), F.col("max_pop")).alias("max_pop"),
        F.col("_names").alias("variants"),
        *cells,
        F.col("_filter").alias("haplotype_filter"),
    )


#: Rows of consecutive ids that lie in one folder (and file), and folders that a lookup names one by one.
BLOCK_ROWS, BLOCKS_NAMED = 1 << 16, 4096


@dataclass(frozen=True)
class Index:
    """A folder: meta (one row), log/<k>, sequences/contig=.../block=..., committed/<contig> and FINALIZED once it is complete.

    Contigs may be appended by several sessions at once. Each first takes the next ids by a log record, which is made only if
    its number is free; records never change, so the order of contigs is that of the log. A contig counts once its
    commit is there, which is made after its rows are written: it is read whole or not at all, and a reader keeps to the
    contigs that were there when it began. What a broken run has left is overwritten by the next, which takes up its ids.
    Rows lie in blocks of consecutive ids, sorted, with a Bloom filter on the id, so a lookup reads few files.
    """

    spark: SparkSession
    path: str

    def _there(self, at: str) -> bool:
        return exists(self.spark, f"{self.path}/{at}")

    def commits(self) -> dict[str, tuple[int, int]]:
        """First id and number of rows of each contig that is in the index, by contig."""
        told = {unquote(name): json.loads(read_text(self.spark, f"{self.path}/committed/{name}")) for name in listed(self.spark, f"{self.path}/committed") if not name.startswith(".")}
        return {c: (x["first"], x["rows"]) for c, x in sorted(told.items())}

    def contigs(self) -> list[str]:
        """The contigs that are in the index."""
        return sorted(self.commits())

    def log(self) -> list[dict]:
        """Who took which ids, in order."""
        return [json.loads(read_text(self.spark, f"{self.path}/log/{name}")) for name in listed(self.spark, f"{self.path}/log") if not name.startswith(".")]

    def reserve(self, contig: str, rows: int) -> int:
        """The first of as many ids as the contig has rows: those that a broken run of the same contig took, or else the next free ones."""
        while True:
            taken = self.log()
            for own in taken:
                if (own["contig"], own["rows"]) == (contig, rows):
                    return own["first"]
            first = taken[-1]["first"] + taken[-1]["rows"] if taken else 0
            if put_if_absent(self.spark, f"{self.path}/log/{len(taken):08d}", json.dumps({"contig": contig, "first": first, "rows": rows})):
                return first

    def create(self, version: str, window: int, haplotype_pops: dict[str, list[str] | None], site_pops: dict[str, list[str] | None], force: bool = False) -> None:
        """An index without rows. The joint legend has the sites' populations in their order, then what only the haplotypes have."""
        if self._there("meta/_SUCCESS") and not force:
            raise FileExistsError(self.path)
        for own in ("FINALIZED", "committed", "log", "sequences", "meta"):  # nothing else that lies there
            delete(self.spark, f"{self.path}/{own}")
        ours, theirs = legends.agreed(haplotype_pops), legends.agreed(site_pops)
        values = [json.dumps(x) for x in (ours, theirs, legends.joint(theirs, ours))]
        row = self.spark.createDataFrame([(version, window, *values)], "VERSION string, window_size int, " + ", ".join(f"{x} string" for x in LEGENDS))
        row.coalesce(1).write.parquet(f"{self.path}/meta")

    def meta(self) -> dict:
        if not self._there("meta/_SUCCESS"):
            raise RuntimeError(f"no index metadata in {self.path}")
        return self.spark.read.parquet(f"{self.path}/meta").first().asDict()

    def legend(self, name: str) -> list[str]:
        if name not in LEGENDS:
            raise ValueError(f"no legend called {name}")
        return json.loads(self.meta()[name])

    def exists(self) -> bool:
        return bool(self.contigs())

    def _rows(self, commits: dict[str, tuple[int, int]]) -> DataFrame:
        """All columns, id_number and block too."""
        if not commits:
            raise ValueError(f"no sequences in {self.path}")
        schema = self.spark.createDataFrame([], schemas.sequences(self.legend("joint_pops_legend")) + ", id_number bigint, block bigint").schema
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/sequences").where(F.col("contig").isin(list(commits)))
        return rows.select(schema.names)  # partition columns come last else

    def sequences(self) -> DataFrame:
        """The rows of the contigs that are committed now; what is appended later does not change them."""
        return self._rows(self.commits()).drop("id_number", "block")

    def count(self) -> int:
        return sum(n for _, n in self.commits().values())

    def append(self, contig: str, entries: DataFrame, reference: DataFrame | Reference, window: int, haplotype_pops: list[str] | None = None, site_pops: list[str] | None = None, chunk: int = CHUNK) -> int:
        """Adds a contig's entries; window and legends must be the index's, and the contig must be new. Returns the index's rows."""
        meta = self.meta()
        if meta["window_size"] != window:
            raise ValueError(f"the index has window size {meta['window_size']}, not {window}")
        for name, own in zip(LEGENDS[:2], (haplotype_pops, site_pops), strict=True):
            legends.agreed({contig: own}, json.loads(meta[name]))
        if contig in self.contigs():
            raise ValueError(f"{contig} is in the index already")
        joint = json.loads(meta["joint_pops_legend"])
        entries = stored(entries, "index-entries")
        n = entries.count()
        first = self.reserve(contig, n)
        schema = self.spark.createDataFrame([], schemas.sequences(joint) + ", id_number bigint").schema
        rows = sequences(entries, reference, joint, window, meta["VERSION"], first, chunk).select([F.col(f.name).cast(f.dataType) for f in schema])
        at = f"{self.path}/sequences/contig={quote(contig, safe='')}"
        blocks = rows.drop("contig").withColumn("block", F.expr(f"id_number div {BLOCK_ROWS}")).repartition("block").sortWithinPartitions("block", "id_number")
        bloom = {"parquet.bloom.filter.enabled#sequence_id": "true", "parquet.bloom.filter.expected.ndv#sequence_id": str(BLOCK_ROWS)}
        blocks.write.mode("overwrite").partitionBy("block").options(**bloom).parquet(at)
        write_text(self.spark, f"{self.path}/committed/{quote(contig, safe='')}", json.dumps({"first": first, "rows": n}))
        return self.count()

    def lookup(self, ids: DataFrame, column: str = "sequence_id") -> DataFrame:
        """The rows of some ids (one row an id, however often it is asked for; unknown ids have none).

        The blocks of the ids are named to the scan, so no other folder is read; where there are very many, the join alone decides.
        """
        commits = self.commits()
        asked = ids.select(F.col(column).cast("string").alias("sequence_id")).distinct().withColumn("id_number", id_number("sequence_id"))
        rows = self._rows(commits)
        blocks = [r[0] for r in asked.select(F.expr(f"id_number div {BLOCK_ROWS}").alias("block")).where("block is not null").distinct().limit(BLOCKS_NAMED + 1).collect()]
        if len(blocks) <= BLOCKS_NAMED:
            rows = rows.where(F.col("block").isin(blocks))
        return rows.join(asked, ["id_number", "sequence_id"], "left_semi").select(rows.columns).drop("id_number", "block")

    def finalize(self) -> None:
        """Marks the index as complete, once all that took ids are committed; again is harmless."""
        commits = self.commits()
        if not commits:
            raise ValueError(f"no sequences in {self.path}")
        if open_ := sorted({x["contig"] for x in self.log()} - set(commits)):
            raise ValueError(f"still being appended, or broken: {open_}")
        if not self.count():
            warnings.warn(f"{self.path} has no rows", stacklevel=2)
        write_text(self.spark, f"{self.path}/FINALIZED", "")

    def _contig(self, contig: str) -> DataFrame:
        rows = self.sequences().where(F.col("contig") == contig)
        if rows.isEmpty():
            warnings.warn(f"no sequences on {contig}", stacklevel=3)
        return rows

    def export_fasta(self, contigs: list[str], base: str, how: str = "parts") -> list[str]:
        """FASTA of contigs, base.<contig>.fasta each: a folder of parts in order (any store), one file that tasks write together, with its
        .fai ("file": disks that all share, or HDFS), or one local file through the driver ("driver").
        """
        if not contigs:
            raise ValueError("no contigs")
        writers = {"parts": write_fasta_parts, "file": write_fasta_file, "driver": lambda rows, path: write_fasta(rows, Path(path))}
        out = [f"{base}.{contig}.fasta" for contig in contigs]
        for contig, path in zip(contigs, out, strict=True):
            writers[how](self._contig(contig), path)
        return out

    def export_tsv(self, contig: str, path: str) -> None:
        """All columns of a contig's sequences as a tab-separated folder in id order, missing values NA."""
        write_tsv(self._contig(contig).orderBy(id_number("sequence_id")), path, one_file=False)


def find_index(root: str = ".") -> str:
    """The first index folder below root, in sorted order."""
    for p in sorted(Path(root).rglob("meta")):
        if (p.parent / "sequences").is_dir():
            return str(p.parent)
    raise RuntimeError(f"no index below {root}")


def variant_names(entries: DataFrame) -> DataFrame:
    """All variants of a catalog, once each."""
    return entries.select(F.explode("variants").alias("v")).select(render(F.col("v")).alias("variant")).distinct()

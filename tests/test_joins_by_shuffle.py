"""Tables that grow with the cohort are not collected for broadcast, however small their files are."""

import re

from conftest import SF

from phaseloom.plans import cohort
from phaseloom.plans.discovery import discover
from phaseloom.sources.fasta import Reference, with_bases
from phaseloom.sources.vcf import read_vcf
from phaseloom.storage import unnamed


def _broadcast_keys(df):
    plan = str(df._jdf.queryExecution().sparkPlan())
    assert not re.search(r"BroadcastHashJoin \[ordinal.*BuildLeft", plan)  # calls
    return {re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)}


def test_discovery_broadcasts_samples_alone(spark):
    plans = {}

    def stage(make, name):
        df = make() if callable(make) else make
        plans[name] = _broadcast_keys(df)
        return unnamed(df, name)

    genotypes, names = read_vcf(spark, cohort.write_vcf(spark, SF), block_gzip=True)
    people = names.join(cohort.samples(spark, SF), "s")
    found = discover(genotypes, people, cohort.sites(spark, SF), cohort.POPS, cohort.WINDOW, cohort.THRESHOLD, 0.0, stage)
    plans["members"] = _broadcast_keys(found)
    assert set(plans) == {"variants", "calls", "carriers", "blocks", "metrics", "found", "members"}
    keys = set().union(*plans.values())
    assert keys <= {"ordinal", "s", "pop", "contig, _range", "_range", "cast(contig as string), _range"}, plans


def test_bases_are_not_broadcast(spark, tmp_path):
    """Chunks of a reference grow with it, and rows with their bases grow with the index."""
    lines = ["ACGTTGCAAC"] * 40
    (tmp_path / "r.fa").write_text("\n".join([">chr1", *lines, ""]))
    (tmp_path / "r.fa.fai").write_text("chr1\t400\t6\t10\t11\n")
    rows = spark.range(50).selectExpr("id AS row_id", "'chr1' AS contig", "id * 7 + 1 AS a", "id * 7 + 30 AS b")
    for path in ("r.fa", "plain.fa"):
        (tmp_path / path).write_text((tmp_path / "r.fa").read_text())
        based = with_bases(rows, Reference(spark, str(tmp_path / path), 50), "a", "b")
        found = {r["row_id"]: r["base"][r["a"] - r["base_start"] :][:30] for r in based.collect()}
        text = "".join(lines)
        assert found == {k: text[7 * k : 7 * k + 30] for k in range(50)}
        plan = based._jdf.queryExecution().executedPlan().toString()  # the one that ran, after adaptive changes
        joins = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan.partition("== Initial Plan ==")[0])
        assert not [x for x in joins if "chunk" in x or "row_id" in x], joins

"""Schemas of the stages, in DDL, and those that follow a population legend."""

from __future__ import annotations

VARIANT = "struct<contig:string,position:int,ref:string,alt:string>"
CALL_STATS = "struct<AC:int,AF:double,AN:int,homozygote_count:int>"
SAMPLES = "s string, pop string, sex_karyotype string"
SITES = f"contig string, position int, ref string, alt string, pop_freqs array<{CALL_STATS}>"
GENOTYPES = "contig string, position int, ref string, alt string, gt array<struct<a:tinyint,b:tinyint>>"
CARRIERS = "s string, pop int, strand int, contig string, position int, ref_len int, row_idx bigint"
HAPLOTYPES = (
    "haplotype array<bigint>, per_pop_AC array<bigint>, max_pop int, max_empirical_AF double, max_empirical_AC bigint, "
    "min_variant_frequency double, fraction_phased double, estimated_gnomad_AF double, "
    "all_pop_freqs array<struct<pop:int,empirical_AC:bigint,empirical_AF:double,fraction_phased:double,estimated_gnomad_AF:double>>"
)
HITS = ["chromosome", "coordinate_start", "coordinate_end", "strand", "padded_target", "unpadded_target_sequence"]


def sequences(pops: list[str]) -> str:
    """The index table's schema for a joint legend; the filter comes last."""
    head = (
        "sequence string, sequence_length bigint, sequence_id string, n_variants bigint, contig string, start bigint, end bigint, "
        "popmax_empirical_AF double, popmax_empirical_AC bigint, source string, popmax_estimated_gnomad_AF double, "
        "popmax_fraction_phased double, max_pop string, variants string"
    )
    freqs = [f"gnomAD_AF_{p} string" for p in pops]
    by_pop = [
        f"empirical_AC_{p} bigint, empirical_AF_{p} double, fraction_phased_{p} double, estimated_gnomAD_haplotype_AF_{p} double" for p in pops
    ]
    return ", ".join([head, *freqs, *by_pop, "haplotype_filter string"])

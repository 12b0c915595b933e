"""Predicates over sites, callsets and genotypes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of GRCh38: the pseudoautosomal regions of chrX end and start here.
PAR1_END, PAR2_START = 2_781_479, 155_701_383


def any_population_at(freqs: Column, threshold: float) -> Column:
    return F.exists(freqs, lambda f: f["AF"] >= threshold)


def max_population_at(freqs: Column, threshold: float) -> Column:
    return F.array_max(F.transform(freqs, lambda f: f["AF"])) >= threshold


def passes(filters: Column) -> Column:
    """No filter applies; a missing set counts as none."""
    return F.coalesce(F.size(filters) == 0, F.lit(True))


def passes_both(exome_filters: Column, genome_filters: Column) -> Column:
    """Genomes without filters, exomes with none but AC0; missing sets count as empty."""
    others = F.array_except(exome_filters, F.array(F.lit("AC0")))
    return passes(genome_filters) & F.coalesce(F.size(others) == 0, F.lit(True))


def in_x_nonpar(contig: Column, position: Column) -> Column:
    return (contig == "chrX") & (position > PAR1_END) & (position < PAR2_START)


def not_in(column: Column, values: list) -> Column:
    """True for every value outside the list, null included."""
    return ~F.coalesce(column.isin(values), F.lit(False))

"""Population legends: ordered lists of codes that positional arrays follow."""

from __future__ import annotations


def joint(first: list[str], second: list[str]) -> list[str]:
    """The first legend's order, then what only the second has."""
    return [*first, *(p for p in second if p not in first)]


def positions(of: list[str], within: list[str]) -> list[int]:
    """For each code of one legend its place in another; -1 where it has none."""
    place = {p: k for k, p in enumerate(within)}
    return [place.get(p, -1) for p in of]


def agreed(legends: dict[str, list[str] | None], stored: list[str] | None = None) -> list[str]:
    """The one legend that all contigs (and the stored one) have, order included."""
    seen = {k: v for k, v in legends.items() if v is not None}
    if stored is not None:
        seen["the index"] = stored
    if len({tuple(v) for v in seen.values()}) > 1:
        raise ValueError(f"population legends differ: {seen}")
    return next(iter(seen.values()), [])


def frequency_index(freq_meta: list[dict[str, str]], key: str, pops: list[str], group: str = "adj") -> list[int]:
    """Places of the populations in a frequency array: entries whose keys are exactly the group and the population."""
    place = {m[key]: k for k, m in reversed(list(enumerate(freq_meta))) if set(m) == {"group", key} and m["group"] == group}
    if missing := [p for p in pops if p not in place]:
        raise ValueError(f"populations without frequencies: {missing}")
    return [place[p] for p in pops]

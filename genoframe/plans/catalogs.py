"""Catalogs of filters, callers and metrics as plain data, and how entries are chosen."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Filter:
    """One entry: a missing field matches any wish."""

    name: str
    value: float | None = None
    analysis: str | None = None
    caller: str | None = None
    exome: bool | None = None


# Names and thresholds that results depend on.
CALLER_FILTERS = tuple(
    [Filter(n, caller="vardict") for n in "Cluster0bp InGap InIns MSI12 NM4.5 SN1.5 f0.001 p8 pSTD q22.5 Bias AMPBIAS LongMSI Q10 d3 v2 DIFF0.2 LongAT P0.9 d5 v3 Q0".split()]
    + [Filter(n, caller="tnscope") for n in "t_lod_fstar low_t_alt_frac germline_risk".split()]
)
NORMAL_FILTERS = ("germline_risk", "in_normal")
NEVER_HARD = ("HighOccurrenceFrq",)
#: Filters whose names begin with a prefix of the project that writes them.
PREFIXED = frozenset("low_tumor_ad low_tumor_dp low_af low_mq low_quality_scores low_strand_read_counts high_strand_oddsratio high_tnscope_rpa high_pop_freq".split())
SNV_FILTERS: dict[str, dict[str, tuple[Filter, ...]]] = {
    "wgs": {
        "research": (Filter("SWEGENAF", 0.01), Filter("high_pop_freq", 0.001)),
        "clinical": (Filter("Frq", 0.007), Filter("ArtefactFrq", 0.1)),
        "quality": (
            Filter("in_normal", 0.3, "paired"), Filter("low_tumor_ad", 3), Filter("low_tumor_dp", 10), Filter("low_af", 0.05), Filter("low_quality_scores", 10, "single"),
            Filter("low_strand_read_counts", 0, "single"), Filter("high_strand_oddsratio", 4),
        ),
    },
    "tga": {
        "research": (Filter("MERGED"), Filter("SWEGENAF", 0.01), Filter("high_pop_freq", 0.005)),
        "clinical": (Filter("Frq", 0.01), Filter("ArtefactFrq", 0.1), Filter("HighOccurrenceFrq", 0.3)),
        "quality": (
            Filter("in_normal", 0.3, "paired"), Filter("low_af", 0.005), Filter("low_tumor_ad", 5), Filter("low_tumor_dp", 50, exome=False), Filter("low_tumor_dp", 20, exome=True),
            Filter("low_mq", 30, caller="vardict"), Filter("low_quality_scores", 20, "single", "tnscope"), Filter("high_strand_oddsratio", 2.7, "single", "tnscope"),
            Filter("high_strand_oddsratio", 3, "paired", "tnscope"), Filter("high_tnscope_rpa", 12, caller="tnscope"),
        ),
    },
    "umi": {
        "research": (Filter("SWEGENAF", 0.01), Filter("high_pop_freq", 0.02)),
        "clinical": (Filter("Frq", 0.01), Filter("ArtefactFrq", 0.1)),
        "quality": (Filter("in_normal", 0.3, "paired"),),
    },
}
SV_FILTERS = {"research": (Filter("SWEGENAF", 0.02),), "clinical": (Filter("Frq", 0.02), Filter("ArtefactObs", 4)), "quality": (Filter("low_pr_sr_count", 4),)}
ZOOM = {"wgs": {"o": 135, "a": 30, "b": 8, "c": 3, "d": 1}, "targeted": {"o": 0, "a": 0, "b": 0, "c": 0, "d": 0}}
REGION_SIZES = {"o": 100_000, "a": 25_000, "b": 5_000, "c": 1_000, "d": 100}
GENOME_MB = 3101.78817
SHARES = "MEAN_INSERT_SIZE PERCENT_DUPLICATION MEDIAN_TARGET_COVERAGE PCT_TARGET_BASES_20X PCT_TARGET_BASES_50X PCT_TARGET_BASES_100X PCT_TARGET_BASES_250X PCT_TARGET_BASES_500X PCT_TARGET_BASES_1000X MEAN_TARGET_COVERAGE FOLD_80_BASE_PENALTY PCT_OFF_BAIT AT_DROPOUT".split()
PANEL_METRICS: dict[str, dict[str, tuple[str, float] | None]] = {
    "default": {n: None for n in SHARES} | {"GC_DROPOUT": ("lt", 1.0)},
    "gicfdna": {"PCT_TARGET_BASES_1000X": ("gt", 0.95)},
    "gmcksolid": {"PCT_TARGET_BASES_250X": ("gt", 0.95)},
    "gmslymphoid": {"GC_DROPOUT": ("lt", 3.0), "PCT_TARGET_BASES_500X": ("gt", 0.95)},
    "gmsmyeloid": {"GC_DROPOUT": ("lt", 3.0), "PCT_TARGET_BASES_500X": ("gt", 0.95)},
    "hdcfdna": {"PCT_TARGET_BASES_1000X": ("gt", 0.95)},
    "gmssolid": {"PCT_TARGET_BASES_250X": ("gt", 0.95)},
    "lymphoma": {"PCT_TARGET_BASES_500X": ("gt", 0.9)},
    "lymphomatic": {"PCT_TARGET_BASES_500X": ("gt", 0.9)},
    "lymphoma_MRD": {"PCT_TARGET_BASES_1000X": ("gt", 0.95)},
    "probio": {"PCT_TARGET_BASES_250X": ("gt", 0.95)},
    "probioC4": {"PCT_TARGET_BASES_250X": ("gt", 0.95)},
    "swep53cfDNA": {"PCT_TARGET_BASES_1000X": ("gt", 0.95)},
    "twistexome": {"PCT_TARGET_BASES_20X": ("gt", 0.95)},
    "twistexomerefseq": {"PCT_TARGET_BASES_20X": ("gt", 0.95)},
    "twistexomecomprehensive": {"GC_DROPOUT": ("lt", 10.0), "AT_DROPOUT": ("lt", 10.0), "PCT_TARGET_BASES_20X": ("gt", 0.95)},
}
GENOME_METRICS: dict[str, tuple[str, float] | None] = {
    "MEAN_INSERT_SIZE": None, "MEDIAN_TARGET_COVERAGE": ("gt", 25), "PERCENT_DUPLICATION": None, "PCT_15X": None, "PCT_30X": None, "PCT_60X": ("gt", 0.8), "PCT_100X": None,
    "FOLD_80_BASE_PENALTY": None, "PCT_PF_READS_IMPROPER_PAIRS": ("le", 0.05), "GC_DROPOUT": ("lt", 5.0), "AT_DROPOUT": ("lt", 5.0),
}
CASE_METRICS = {"NUMBER_OF_SITES": ("lt", 50_000), "RELATEDNESS": ("gt", 0.8)}


class CatalogError(LookupError):
    """Not exactly one entry has the wanted name."""


def choose(filters: Iterable[Filter], analysis: str | None = None, caller: str | None = None, exome: bool | None = None) -> list[Filter]:
    """Entries whose fields match; a missing field or wish matches everything."""
    fits = lambda has, want: has is None or want is None or has == want
    return [f for f in filters if fits(f.analysis, analysis) and fits(f.caller, caller) and fits(f.exome, exome)]


def unique(filters: Iterable[Filter], name: str) -> Filter:
    """B38."""
    found = [f for f in filters if f.name == name]
    if len(found) != 1:
        raise CatalogError(f"{len(found)} filters are called {name}")
    return found[0]


def hard_names(filters: Iterable[Filter], soft_normals: bool = False, callers: bool = True) -> list[str]:
    """Names that drop a row; matched-normal names don't if they are to stay soft."""
    names = [f.name for f in (*filters, *(CALLER_FILTERS if callers else ()))]
    return [n for n in dict.fromkeys(names) if n not in NEVER_HARD and not (soft_normals and n in NORMAL_FILTERS)]


def requested_metrics(kit: str | None) -> dict[str, tuple[str, float] | None]:
    """The default metrics overlaid by the kit's; without a kit the genome's."""
    return dict(GENOME_METRICS) if kit is None else PANEL_METRICS["default"] | PANEL_METRICS.get(kit, {})


def kit_of(bait_set: str) -> str | None:
    """The first catalog name that stands before ``_<digit>`` in a bait set's name."""
    return next((k for k in PANEL_METRICS if re.search(rf"{re.escape(k)}(?=_\d)", bait_set)), None)


def full_name(name: str, prefix: str) -> str:
    """The name as it stands in FILTER texts."""
    return prefix + name if name in PREFIXED else name

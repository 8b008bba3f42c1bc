"""Every parameter of the plans, typed, with the values that the plans use where none is given."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Stages:
    classify: bool = True
    hqfilter: bool = True
    hcfilter: bool = True
    taxonomy: bool = True
    phist: bool = True
    crisprhost: bool = True
    function: bool = True
    lifestyle: bool = True
    anicluster: bool = True
    aaicluster: bool = False
    update: bool = True


@dataclass(frozen=True)
class BatchSizes:
    url: int = 1000
    genomad: int = 10_000
    checkv: int = 5000
    hmm: int = 250
    taxonomy: int = 10_000
    bacphlip: int = 1000
    crispr: int = 20_000
    iphop: int = 250
    hosts: int = 20_000
    proteins: int = 100_000


@dataclass(frozen=True)
class Thresholds:
    virus_score: float = 0.95
    verify_score: float = 15.0
    hallmarks: int = 3
    duplicity: float = 1.2
    dtr_completeness: float = 80.0
    complete: float = 90.0
    agreement: float = 0.7
    mismatches: int = 1
    containment: float = 0.2
    shared_kmers: int = 20
    integration: float = 0.9
    min_score: float = 5.5
    uncertain_length: int = 10_000
    min_length: int = 2000
    classifier: float = 7.0
    ladder: tuple[float, ...] = (5.5, 32.0, 65.0, 80.0)


@dataclass(frozen=True)
class Config:
    release: str = "1"
    previous: str | None = None
    output: str = "release"
    rank: str = "Class"
    segmented: bool = False
    stages: Stages = field(default_factory=Stages)
    batches: BatchSizes = field(default_factory=BatchSizes)
    thresholds: Thresholds = field(default_factory=Thresholds)

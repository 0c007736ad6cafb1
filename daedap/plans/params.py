"""The settings that tell the pipeline variants apart."""

from __future__ import annotations

from dataclasses import dataclass

# Markers of bad answers, and the particles that may be trimmed.
SENTENCE_END = ("다.",)
UNKNOWN = ("unk",)
STRICT_MARKERS = ("며,", "데,", "뿐,", "라,", "unk")
RELAXED_MARKERS = ("며,", "데,", "뿐,", "unk")
TRIMMED_PARTICLES = ("의", "을", "를", "이")


@dataclass(frozen=True)
class CutParams:
    """Pooled candidates of the documents close to the best one, then of all."""

    cut: float
    end_weight: float
    documents: int = 10
    spans: int = 10
    inside: tuple[str, ...] = SENTENCE_END
    strict: tuple[str, ...] = STRICT_MARKERS
    relaxed: tuple[str, ...] = RELAXED_MARKERS
    particles: tuple[str, ...] = TRIMMED_PARTICLES
    min_len: int = 2
    max_len: int = 29
    end_source: str = "start"
    # A model's longest sequence; the lexical reader has no limit and reads all.
    max_tokens: int | None = None


@dataclass(frozen=True)
class RankParams:
    """The best span of one context at a time, the first acceptable one wins."""

    documents: int = 30
    anywhere: tuple[str, ...] = ()
    min_len: int = 2
    max_len: int | None = None
    # The particle to trim where it is tagged as a genitive; none: no trimming.
    genitive: str | None = None
    windows: bool = False
    end_source: str = "start"
    max_tokens: int | None = None


# The six variants. The first three read the top 30 in rank order.
P0 = RankParams(max_len=99)
P1 = RankParams(anywhere=SENTENCE_END, genitive="의")
P2 = RankParams(anywhere=SENTENCE_END + UNKNOWN, genitive="의", windows=True)
P3 = CutParams(cut=0.95, end_weight=1.0)
P4 = CutParams(cut=0.90, end_weight=0.5)
P5 = CutParams(cut=0.90, end_weight=0.1)

"""Evaluation settings (the evaluator's command-line flags as a dataclass)."""
from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the evaluator (must equal the reference for equal results).
RELVALUE_NONPOOL = -1        # retrieved document absent from the judgements
RELVALUE_UNJUDGED = -2       # judged with a negative value: pooled, not judged
MIN_GEO_MEAN = 0.00001       # floor inside gm_map / gm_bpref logarithms
INFAP_EPSILON = 0.00001      # smoothing in infAP
MISSING_ZSCORE_VALUE = -1000000.0
MAX_DOCS_DEFAULT = 2147483647


@dataclass(frozen=True)
class EvalConfig:
    level: int = 1                 # -l: relevant means code >= level
    max_docs: int | None = None    # -M: keep the first M documents per topic
    judged_only: bool = False      # -J: drop non-pool / unjudged rows, re-rank
    complete: bool = False         # -c: average over every judged topic
    num_docs: int = 0              # -N: collection size (utility only)
    topic: str | None = None       # -D style single-topic filter
    skew_safe: bool | int = False  # measure rankings and topics, and split those too
    #                                large for one task over many (a distributed prefix
    #                                scan): of over a million rows, or of over the number
    strict: bool = True            # raise on duplicate documents (J4/J5) and
    #                                inconsistent preferences (P3), as the evaluator does

    @property
    def cut(self) -> int | None:
        if self.max_docs is None or self.max_docs >= MAX_DOCS_DEFAULT:
            return None
        return self.max_docs

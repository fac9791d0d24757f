"""Thresholds of the transcript pipeline, from defaults or environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Params:
    """Every threshold in one frozen place; ``compat`` switches keep behaviour that is otherwise repaired."""

    main_speaker: str = "MAIN"
    overlap_min_ms: int = 500
    gap_marker_ms: int = 108_000
    gap_text: str = "[KIRTAN]"
    max_chars: int = 2800
    window_ms: int = 30_000
    hop_ms: int = 15_000
    window_min_ms: int = 500
    chunk_ms: int = 54_000
    chunk_min_ms: int = 1_000
    energy_min: float = 0.02
    centroid_high: float = 3000.0
    zcr_high: float = 0.1
    word_ms: int = 300
    perfect_score: float = 9.99
    align_block_ms: int = 3_600_000  # not read any more: recordings are aligned as a whole
    local_distance: float = 0.3
    global_distance: float = 0.35
    match_f1: float = 0.6
    keep_groups: bool = False
    repeat_before_long: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "VOXLOOM_") -> Params:
        """Defaults overridden by ``VOXLOOM_<FIELD>`` variables, cast to the field's type."""
        env, given = os.environ if env is None else env, {}
        for f in fields(cls):
            if (raw := env.get(prefix + f.name.upper())) is not None:
                kind = type(f.default)
                given[f.name] = raw.strip().lower() in ("1", "true", "yes") if kind is bool else kind(raw)
        return cls(**given)

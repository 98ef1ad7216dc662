"""Options shared by the table plans. Defaults are those of a cautious load."""

from __future__ import annotations

from dataclasses import dataclass

# The pandas default null tokens, which a plain CSV load would drop.
NA_TOKENS = (
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

LEVELS = ("none", "basic", "aggressive")


@dataclass(frozen=True)
class Options:
    level: str = "basic"
    strict_membership: bool = True
    gates: bool = True
    gate_changed_ratio: float = 0.3
    gate_null_delta_ratio: float = 0.3
    gate_min_rows: int = 20
    gate_log_level: str = "WARNING"
    postal_enrichment: bool = False
    correct_state_only_if_null: bool = True
    skip_invalid_ids: bool = False
    backfill: bool = True
    skip_integrity: bool = False
    partition_by_state: bool = False
    cluster_by_state: bool = False
    allow_overwrite: bool = False
    encoding: str = "ISO-8859-1"
    multi_line: bool = False
    na_tokens: tuple[str, ...] = NA_TOKENS
    chunk_size: int = 200_000
    json_max_bytes: int = 10_000_000
    daily_rotation: bool = True
    metrics: bool = False
    stage: bool = True

    def __post_init__(self) -> None:
        if self.level not in LEVELS:
            raise ValueError(f"level must be one of {LEVELS}, got {self.level!r}")

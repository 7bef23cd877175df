"""Run switches."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from sluice.functions.pii import QUASI_PATTERNS, VALUE_PATTERNS

KEY_COLUMNS = ("facility", "uid", "uniquekey")
SYSTEM_TIMES = ("ingestedat", "startedat", "completedat")
DISCHARGE_TIMES = ("startedatdischarge", "completedatdischarge", "ingestedatdischarge")


@dataclass(frozen=True)
class RunConfig:
    """Settings of one run; immutable, so every step sees the same values."""

    country: str = ""
    dataset: str = ""
    uid_separators: tuple[str, ...] = (",", "/")
    reserved_renames: Mapping[str, str] = field(default_factory=dict)
    metadata_columns: tuple[str, ...] = ()
    timestamp_columns: tuple[str, ...] = SYSTEM_TIMES
    label_rules: Mapping[str, str] = field(default_factory=dict)      # field -> rule name
    value_patterns: Mapping[str, str] = field(default_factory=lambda: dict(VALUE_PATTERNS))
    name_patterns: tuple[str, ...] = ()                               # added to the defaults
    quasi_patterns: tuple[str, ...] = QUASI_PATTERNS
    aliases: Mapping[str, Mapping[str, tuple[str, ...]]] = field(default_factory=dict)
    delete_values: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    mixed_date_columns: tuple[str, ...] = ("hepbdate",)
    dedup_mode: str = "episode"                                       # or "current"
    skip_patient_dedup: bool = False
    episode_role: str | None = None                                   # admissions/discharges/births
    outcome_column: str = "outcome.value"
    save_deidentified: bool = False
    save_checkpoint: bool = False
    save_harmonised: bool = False
    save_na_coded: bool = True
    save_na_long: bool = False

    def __post_init__(self) -> None:
        if self.dedup_mode not in ("current", "episode"):
            raise ValueError(f"dedup_mode must be 'current' or 'episode', not '{self.dedup_mode}'")

    @property
    def episodes(self) -> bool:
        return (self.dedup_mode == "episode" and self.episode_role is not None
                and not self.skip_patient_dedup)

    @property
    def record_keys(self) -> tuple[str, ...]:
        """Row key after deduplication."""
        return (("uid", "facility", "uniquekey") if self.skip_patient_dedup or self.episodes
                else ("uid", "facility"))

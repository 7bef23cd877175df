"""The data dictionary on the driver: feature lists, ranges, value maps."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.pii import NAME_PATTERNS
from sluice.functions.text import any_base
from sluice.functions.values import ValueMap, build_value_map
from sluice.plans.config import KEY_COLUMNS, RunConfig
from sluice.session import bounded_rows

TYPES = ("numeric", "boolean", "categorical", "object", "datetime")


@dataclass(frozen=True)
class Dictionary:
    variables: tuple[Mapping, ...]
    value_map_rows: tuple[Mapping, ...] = ()
    pii_patterns: tuple[str, ...] = ()

    @staticmethod
    def from_tables(variables: DataFrame, value_maps: DataFrame | None = None,
                    pii_patterns: DataFrame | None = None) -> Dictionary:
        maps = bounded_rows(value_maps, what="value maps") if value_maps is not None else []
        patterns = bounded_rows(pii_patterns, what="name patterns") if pii_patterns is not None else []
        return Dictionary(tuple(bounded_rows(variables, what="variables")), tuple(maps),
                          tuple(p["pattern"] for p in patterns if p.get("pattern")))

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Dictionary:
        """Variables, value maps and name patterns from one folder of Parquet tables."""
        return Dictionary.from_tables(*[spark.read.parquet(f"{folder}/{t}")
                                        for t in ("variables", "value_maps", "pii_patterns")])

    def columns_of(self, r_type: str) -> tuple[str, ...]:
        return tuple(dict.fromkeys(
            v["raw_value_column"] for v in self.variables
            if v.get("r_type") == r_type and v.get("use_in_analysis") and v.get("raw_value_column")))

    @cached_property
    def weight_keys(self) -> frozenset[str]:
        return frozenset(v["question_key"] for v in self.variables
                         if (v.get("weight_unit") or "").lower() == "grams")

    @cached_property
    def ranges(self) -> dict[str, tuple[float | None, float | None]]:
        return {v["question_key"]: (v.get("suggested_plausible_min"), v.get("suggested_plausible_max"))
                for v in self.variables
                if v.get("r_type") == "numeric"
                and (v.get("suggested_plausible_min") is not None
                     or v.get("suggested_plausible_max") is not None)}

    @cached_property
    def confidential_columns(self) -> frozenset[str]:
        return frozenset(x for v in self.variables if v.get("confidential")
                         for x in (v.get("raw_value_column"), v.get("raw_label_column")) if x)

    @cached_property
    def confidential_keys(self) -> frozenset[str]:
        return frozenset(any_base(x) for x in self.confidential_columns) | frozenset(
            v["harmonised_variable_name"] for v in self.variables
            if v.get("confidential") and v.get("harmonised_variable_name"))

    @cached_property
    def harmonised(self) -> dict[str, str]:
        return {v["question_key"]: v["harmonised_variable_name"] for v in self.variables
                if v.get("harmonised_variable_name") and v.get("use_in_analysis")}

    @cached_property
    def known_columns(self) -> frozenset[str]:
        return frozenset(x for v in self.variables
                         for x in (v.get("raw_value_column"), v.get("raw_label_column")) if x)

    @cached_property
    def value_maps(self) -> dict[str, ValueMap]:
        rows: dict[str, list[Mapping]] = {}
        for r in self.value_map_rows:
            rows.setdefault(r["question_key"], []).append(r)
        return {k: build_value_map(v) for k, v in rows.items()}

    def name_patterns(self, cfg: RunConfig) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.pii_patterns + NAME_PATTERNS + cfg.name_patterns))

    def type_lists(self, cfg: RunConfig) -> dict[str, frozenset[str]]:
        lists = {t: frozenset(self.columns_of(t)) for t in TYPES}
        lists["datetime"] |= frozenset(cfg.timestamp_columns)
        return {t: cols - frozenset(KEY_COLUMNS) for t, cols in lists.items()}

    @cached_property
    def checksum(self) -> str:
        rows = sorted(json.dumps(dict(r), sort_keys=True, default=str)
                      for r in (*self.variables, *self.value_map_rows))
        return hashlib.sha256("\n".join([*rows, *self.pii_patterns]).encode()).hexdigest()

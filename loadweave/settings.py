"""Engine settings: one frozen dataclass, overridable from ``LOADWEAVE_*`` variables."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass
from typing import Any

ENV_PREFIX = "LOADWEAVE_"


@dataclass(frozen=True)
class Settings:
    # Column names, horizons and constants of the load data set
    # and of the price curve. They must keep these values for equal results.
    data_path: str = "data/zone_load_hourly.csv"
    datetime_col: str = "Datetime"
    target_zone: str = "PJME"
    other_zones: tuple[str, ...] = ("PJMW", "AEP", "DAYTON", "DOM", "DUQ")
    train_ratio: float = 0.80
    target_lags: tuple[int, ...] = (*range(1, 25), 48, 168)
    cross_lags: tuple[int, ...] = (1, 24)
    target_windows: tuple[int, ...] = (24, 48, 168)
    cross_windows: tuple[int, ...] = (24,)
    history_rows: int = 168
    walk_forward_folds: int = 5
    price_intercept: float = 15.0
    price_linear: float = 0.005
    price_quadratic: float = 0.000002
    price_noise_sd: float = 2.0
    noise_seed: int = 42
    bucket_capacity: float = 10.0
    bucket_refill_rate: float = 5.0
    snapshot_every: int = 24

    # Learner (boosted Spark ML trees that grow by depth; folds stop by patience on held-out rows,
    # ``trees`` is the most they may take).
    model_path: str = "artifacts/load_model"
    trees: int = 2000
    patience: int = 50
    tree_depth: int = 5
    learning_rate: float = 0.1
    model_seed: int = 42

    @property
    def zones(self) -> tuple[str, ...]:
        return (self.target_zone, *self.other_zones)

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "Settings":
        """Defaults overridden by ``LOADWEAVE_<FIELD>``; tuples are JSON lists."""
        env = dict(os.environ) if env is None else env
        given: dict[str, Any] = {}
        for field in dataclasses.fields(cls):
            raw = env.get(ENV_PREFIX + field.name.upper())
            if raw is None:
                continue
            default = field.default
            if isinstance(default, tuple):
                given[field.name] = tuple(json.loads(raw))
            else:
                given[field.name] = type(default)(raw)
        return cls(**given)


@dataclass(frozen=True)
class PanelSpec:
    """Which columns of a panel table mean what. The first ratio partner is ``others[0]``."""

    target: str
    others: tuple[str, ...]
    panel: str = "panel_id"
    ts: str = "ts"

    @property
    def zones(self) -> tuple[str, ...]:
        return (self.target, *self.others)

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.panel,)

    @classmethod
    def from_settings(cls, settings: Settings) -> "PanelSpec":
        return cls(
            target=settings.target_zone.lower(),
            others=tuple(z.lower() for z in settings.other_zones),
        )

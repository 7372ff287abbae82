"""Settings of the engine, with the published defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Tunables; every operator that needs one takes it as an argument with this default."""

    first_year: int = 2017
    api_from_code: int = 656
    patch_m: int = 2560
    stride_m: int = 2560
    fine_m: int = 10
    least_valid: float = 0.1
    nodata: float = 9999.0
    buffer_deg: float = 0.6
    s1_days: tuple = (15, 30, 45, 60)
    s1_coverage: float = 99.0
    s2_clouds: tuple = (30, 40, 50, 60, 70)
    s2_coverage: float = 98.0
    s2_days: int = 30
    targets: dict = field(default_factory=lambda: {"train": 0.70, "val": 0.15, "test": 0.15})
    tie_weight: float = 0.25
    fine_deg: float = 0.0001
    nearest_deg: float = 0.5
    m_per_deg_lon: float = 111320.0
    m_per_deg_lat: float = 110540.0


DEFAULTS = Settings()

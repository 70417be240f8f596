"""Parameters of every step as frozen dataclasses, with the defaults of the method."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

# Soil group code to texture class.
WRB_TO_TEXTURE = MappingProxyType({
    1: "clay_loam", 2: "clay", 3: "loam", 4: "sand", 5: "loam",
    6: "clay_loam", 7: "loam", 8: "clay_loam", 9: "loam", 10: "loam",
    11: "clay", 12: "loam", 13: "clay_loam", 14: "sandy_loam", 15: "loam",
    16: "clay_loam", 17: "sandy_loam", 18: "sandy_loam", 19: "clay_loam",
    20: "clay", 21: "clay_loam", 22: "clay_loam", 23: "clay", 24: "sandy_loam",
    25: "loam", 26: "sandy_loam", 27: "clay", 28: "clay_loam", 29: "loam", 30: "clay",
})
# Textures to fall back on, nearest first.
TEXTURE_FALLBACK = MappingProxyType({
    "sand": ("sand", "sandy_loam", "loam", "clay_loam", "clay"),
    "sandy_loam": ("sandy_loam", "sand", "loam", "clay_loam", "clay"),
    "loam": ("loam", "sandy_loam", "clay_loam", "sand", "clay"),
    "clay_loam": ("clay_loam", "loam", "clay", "sandy_loam", "sand"),
    "clay": ("clay", "clay_loam", "loam", "sandy_loam", "sand"),
})
# Columns that every caliper needs, and names a tenure column may have.
MANDATORY_COLUMNS = ("WRB2_CODE", "SOC_g_kg", "NDVI_t0", "elevation", "slope_deg", "dist_roads_km")
TENURE_COLUMNS = ("tenure_status", "Tenure", "TENURE", "legal_status", "LegalStatus", "LEGAL_STATUS")
#: Columns of a pixel table that are never covariates.
NOT_COVARIATES = ("ndvi_valid_years", "pixel_area_ha", "is_project", "is_donor", "WRB2_CODE")

TC_TO_TCO2E = 44.0 / 12.0
Z90 = 1.645


@dataclass(frozen=True)
class Grid:
    """North-up affine grid: cell (row, col) is centred on (x0 + (col + .5) dx, y0 - (row + .5) dy)."""

    x0: float = 0.0
    y0: float = 0.0
    dx: float = 30.0
    dy: float = 30.0
    crs: str = "EPSG:32734"

    @property
    def cell_ha(self) -> float:
        return self.dx * self.dy / 1e4


@dataclass(frozen=True)
class ExtractConfig:
    edge_pixels: int = 1
    exclude_edges: bool = True
    sample_spatially: bool = False
    sample_above: int = 150_000
    sample_cell_m: float = 150.0
    extent_km: float | str = "full"
    #: The documented rule removes pixels inside the forest mask; "keep_inside" keeps only those.
    forest_mode: str = "remove_inside"
    seed: int = 42


@dataclass(frozen=True)
class MatchConfig:
    matches_per_pixel: int = 1
    candidates: int = 150
    #: Donors kept at most, by a stratified draw (an opt-in; 300_000 is the method's value on one machine).
    donor_cap: int | None = None
    fallback: bool = False
    max_reuse: int = 1
    fit_rows: int | None = None
    ridge: float = 1e-6
    smd_threshold: float = 0.1
    soc_fraction: float = 0.10
    ndvi_fraction: float = 0.10
    elevation_m: float = 200.0
    slope_deg: float = 10.0
    roads_km: float = 1.0
    low_quantile: float = 0.01
    high_quantile: float = 0.99
    buffer_fraction: float = 0.20
    buffer_floor: float = 1e-6
    #: "reference" takes the nearest candidates before calipers, "caliper_first" after them.
    mode: str = "reference"
    require_mandatory: bool = True
    seed: int = 42


@dataclass(frozen=True)
class TrendConfig:
    p_threshold: float = 0.05
    slope_threshold: float = 0.005
    min_fraction: float = 0.30
    min_pairs: int = 30
    fractions: tuple[float, ...] = tuple(round(0.95 - 0.05 * i, 2) for i in range(14))
    min_valid_share: float = 0.60


@dataclass(frozen=True)
class AreaConfig:
    mode: str = "pixel"
    pixel_m: float = 30.0
    block_m: float = 150.0
    buffer_cells: int = 0
    closing_cells: int = 0
    min_polygon_ha: float = 0.0
    #: Tolerance of the reference area's outlines; its cells and hectares stay.
    simplify_m: float = 0.0
    monitoring: str = "matched_pixels"
    spacing_m: float = 500.0
    validity_years: int = 10


@dataclass(frozen=True)
class CarbonSpec:
    """Where carbon change comes from: a change table, two stock tables, or one with years."""

    mode: str = "two_stock"
    units: str = "AGB_Mg_ha"
    carbon_fraction: float = 0.47
    root_shoot: float = 0.4
    delta_units: str = "tC_ha_yr"


@dataclass(frozen=True)
class BaselineConfig:
    t0_year: int = 2018
    monitoring_year: int = 2024
    period_years: float | None = None
    min_period: int = 4
    use_blocks: bool = True
    block_m: float = 500.0
    z: float = Z90
    allow_negative: bool = True
    decimals: int = 7
    min_controls: int = 2
    daf: float = 0.0125
    br_gov: float = 0.0


@dataclass(frozen=True)
class SweepConfig:
    extents: tuple[float | str, ...] = ("full", 5, 10, 20, 30)
    ratio: float = 3.0
    coverage_pct: float = 90.0
    twin_pct: float = 30.0
    smd: float = 0.10


@dataclass(frozen=True)
class SceneConfig:
    t0_year: int = 2018
    trend_years: int = 5
    max_cloud: float = 10.0
    start_month: int = 4
    min_valid_years: int = 4
    water_occurrence: float = 60.0
    buffer_km: float = 50.0
    exclusion_km: float = 5.0


@dataclass(frozen=True)
class RunConfig:
    run_id: str = "run"
    root: str = ""
    grid: Grid = field(default_factory=Grid)
    extract: ExtractConfig = field(default_factory=ExtractConfig)
    match: MatchConfig = field(default_factory=MatchConfig)
    trend: TrendConfig = field(default_factory=TrendConfig)
    area: AreaConfig = field(default_factory=AreaConfig)
    baseline: BaselineConfig = field(default_factory=BaselineConfig)
    carbon: CarbonSpec = field(default_factory=CarbonSpec)
    project_area_ha: float | None = None
    allow_noncompliant_twin: bool = False

    @property
    def effective_id(self) -> str:
        km = self.extract.extent_km
        return f"{self.run_id}_extfull" if km == "full" else f"{self.run_id}_ext{float(km):g}km"

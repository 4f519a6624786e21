"""The job specification: columns, split, grids, bands, scenarios.

One frozen dataclass drives every job, so a declared value is always a used one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

# --- Fixed values: feature catalogue (name, icon, group, min, max, help), in model order. ---
FEATURE_CATALOGUE = (
    ("MonsoonIntensity", "🌧️", "Climate", 1, 10, "Intensity of monsoon rainfall season"),
    ("TopographyDrainage", "⛰️", "Terrain", 1, 10, "Natural drainage capacity of terrain"),
    ("RiverManagement", "🏞️", "Infrastructure", 1, 10, "Quality of river management systems"),
    ("Deforestation", "🌲", "Environment", 1, 10, "Level of deforestation in the region"),
    ("Urbanization", "🏙️", "Development", 1, 10, "Rate of urban expansion"),
    ("ClimateChange", "🌡️", "Climate", 1, 10, "Impact of long-term climate change"),
    ("DamsQuality", "🏗️", "Infrastructure", 1, 10, "Structural quality of dams"),
    ("Siltation", "💧", "Terrain", 1, 10, "Silt buildup in rivers and channels"),
    ("AgriculturalPractices", "🌾", "Environment", 1, 10, "Flood-risk impact of farming methods"),
    ("Encroachments", "🏠", "Development", 1, 10, "Flood plain encroachment level"),
    ("IneffectiveDisasterPreparedness", "🚨", "Governance", 1, 10,
     "Weakness of disaster response systems"),
    ("DrainageSystems", "🔩", "Infrastructure", 1, 10, "Quality of drainage network"),
    ("CoastalVulnerability", "🌊", "Terrain", 1, 10, "Exposure to coastal flood events"),
    ("Landslides", "⛏️", "Terrain", 1, 10, "Landslide risk in the region"),
    ("Watersheds", "🗺️", "Environment", 1, 10, "Watershed health and management"),
    ("DeterioratingInfrastructure", "🧱", "Infrastructure", 1, 10, "State of existing flood defences"),
    ("WetlandLoss", "🌿", "Environment", 1, 10, "Loss of natural wetland buffers"),
)
DEFAULT_ICON = "•"
DEFAULT_VALUE = 5

# --- Fixed values: target, dropped columns and the sample row in model order. ---
TARGET = "FloodProbability"
DROPPED = ("PoliticalFactors", "InadequatePlanning", "PopulationScore")
SAMPLE_VALUES = (1, 3, 4, 5, 3, 2, 8, 9, 3, 2, 9, 8, 6, 2, 1, 1, 4)

# --- Fixed values: risk bands as (lower bound, band, advice); a band ends where the next starts. ---
BANDS = (
    (float("-inf"), "LOW", "Minimal flood risk. Normal monitoring advised."),
    (0.3, "MODERATE", "Moderate risk. Precautionary measures recommended."),
    (0.5, "HIGH", "High risk. Activate flood preparedness protocols."),
    (0.7, "CRITICAL", "Critical risk. Immediate evacuation may be required."),
)

# --- Fixed values: what-if scenarios as overrides of a base row. ---
SCENARIOS = {
    "Low Risk Area": {name: 2 for name, *_ in FEATURE_CATALOGUE},
    "Urban Flood Zone": {"Urbanization": 9, "DrainageSystems": 2, "Encroachments": 8},
    "Coastal High Risk": {"CoastalVulnerability": 10, "MonsoonIntensity": 8, "Landslides": 7},
    "Rural Monsoon Zone": {"MonsoonIntensity": 9, "Deforestation": 8, "WetlandLoss": 8},
}

# --- Fixed values: hyper-parameter grids per model, in tournament order. ---
GRIDS = {
    "LinearRegression": {"regParam": (0.01, 0.1), "elasticNetParam": (0.0, 0.5, 1.0)},
    "DecisionTreeRegressor": {"maxDepth": (3, 5, 7), "minInstancesPerNode": (1, 5, 10)},
    "RandomForestRegressor": {
        "numTrees": (50, 100), "maxDepth": (5, 10), "minInstancesPerNode": (1, 5)},
    "GradientBoostingRegressor": {"maxDepth": (3, 5), "maxIter": (20, 50)},
}

# --- Fixed values: declared single-setting presets (the last one imitates a library Spark lacks). ---
PRESETS = {
    "Ridge": ("LinearRegression", {"regParam": 1.0, "elasticNetParam": 0.0}),
    "Lasso": ("LinearRegression", {"regParam": 1.0, "elasticNetParam": 1.0}),
    "XGBRegressor": ("GradientBoostingRegressor", {
        "maxIter": 500, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8"}),
}

# --- Fixed values: fit diagnosis limits. ---
OVERFIT_GAP = 0.1
UNDERFIT_R2 = 0.7

# --- Fixed values: serving limits. ---
REQUESTS_PER_WINDOW = 10
WINDOW_SECONDS = 60
REUSE_SECONDS = 60
COOLDOWN_SECONDS = 60


@dataclass(frozen=True)
class JobSpec:
    """Columns, split, model search and interpretation rules of one scoring job."""

    features: tuple[str, ...]
    target: str
    dropped: tuple[str, ...] = ()
    test_size: float = 0.2
    seed: int = 42
    folds: int = 3
    grids: dict[str, dict[str, tuple]] = field(default_factory=lambda: GRIDS)
    bands: tuple = BANDS
    scenarios: dict[str, dict[str, float]] = field(default_factory=dict)
    # (name, icon, group, min, max, help) rows
    catalogue: tuple = ()

    def __post_init__(self):
        if not self.features:
            raise ValueError("a job needs at least one feature")
        if self.target in self.features:
            raise ValueError(f"target {self.target!r} is also a feature")
        if not 0.0 < self.test_size < 1.0:
            raise ValueError("test_size must lie between 0 and 1")

    @property
    def kept(self) -> tuple[str, ...]:
        """Features in model order, then the target."""
        return (*self.features, self.target)

    def grid_points(self, model: str) -> list[dict]:
        """Cartesian product of a model's grid; the last parameter varies fastest."""
        grid = self.grids[model]
        return [dict(zip(grid, values)) for values in product(*grid.values())]


REGIONAL = JobSpec(
    features=tuple(row[0] for row in FEATURE_CATALOGUE),
    target=TARGET,
    dropped=DROPPED,
    scenarios=SCENARIOS,
    catalogue=FEATURE_CATALOGUE,
)

"""Grid-search presets."""

from __future__ import annotations

from dataclasses import dataclass, field

from barograph.operators.split import BUCKETS


@dataclass(frozen=True)
class Preset:
    """Parameter grid and how to search it.

    ``fraction`` is the share of training rows a quick mode uses. With
    ``train_ratio`` the search is a single split instead of ``folds`` folds.
    """

    family: str
    grid: dict[str, list]
    folds: int = 3
    parallelism: int = 4
    fraction: float = 1.0
    train_ratio: float | None = None
    fixed: dict[str, object] = field(default_factory=dict)

    @property
    def fold_count(self) -> int:
        """Number of values a fold column has: hundredths for a single split."""
        return self.folds if self.train_ratio is None else BUCKETS


# Grids, folds and concurrency by preset name.
PRESETS = {
    "rf-test": Preset(
        "rf", {"numTrees": [10, 20], "maxDepth": [5, 10], "minInstancesPerNode": [1]},
        folds=2, fraction=0.1),
    "rf-full": Preset(
        "rf", {"numTrees": [50, 100, 150], "maxDepth": [10, 15, 20], "minInstancesPerNode": [1, 5]}),
    "rf-simplified": Preset(
        "rf", {"numTrees": [10, 20], "maxDepth": [5, 10], "minInstancesPerNode": [1]},
        folds=2, parallelism=1),
    "rf-final": Preset(
        "rf", {"numTrees": [50, 100], "maxDepth": [10, 12], "minInstancesPerNode": [1, 5]},
        parallelism=2),
    "rf-optimized": Preset(
        "rf", {"numTrees": [50, 100], "maxDepth": [10, 15], "minInstancesPerNode": [1, 5]},
        parallelism=2),
    "rf7-cv-full": Preset(
        "rf", {"numTrees": [100, 200], "maxDepth": [12, 16],
               "featureSubsetStrategy": ["sqrt", "log2"]}),
    "rf7-cv-fast": Preset(
        "rf", {"numTrees": [100, 150], "maxDepth": [10, 12], "featureSubsetStrategy": ["sqrt"]}),
    "rf7-single": Preset(
        "rf", {"numTrees": [120], "maxDepth": [12], "featureSubsetStrategy": ["sqrt"]}),
    "gbt-test": Preset(
        "gbt", {"maxIter": [10, 20], "maxDepth": [3, 5], "stepSize": [0.1]},
        folds=2, fraction=0.1),
    "gbt-full": Preset(
        "gbt", {"maxIter": [50, 100, 150], "maxDepth": [5, 7, 10], "stepSize": [0.05, 0.1, 0.2]}),
    "gbt-simplified": Preset(
        "gbt", {"maxIter": [20, 50], "maxDepth": [3, 5], "stepSize": [0.1]},
        folds=2, parallelism=1),
    "gbt7-cv-full": Preset(
        "gbt", {"maxIter": [100, 200], "maxDepth": [6, 8], "stepSize": [0.05, 0.1]},
        fixed={"subsamplingRate": 0.8}),
    "gbt7-cv-fast": Preset(
        "gbt", {"maxIter": [100, 200], "maxDepth": [6, 8], "stepSize": [0.1]},
        fixed={"subsamplingRate": 0.8}),
    "gbt7-tvs-fast": Preset(
        "gbt", {"maxIter": [100, 200], "maxDepth": [6, 8], "stepSize": [0.1]},
        train_ratio=0.8, fixed={"subsamplingRate": 0.8}),
}

"""Feature specifications: expected types and constraints of a dataset."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Feature:
    """Constraints of one feature. ``None`` switches a check off."""

    name: str
    type: str = "string"
    single: bool = True
    min_fraction: float | None = None
    min_count: int | None = None
    min_values: int | None = None
    max_values: int | None = None
    domain: tuple[str, ...] | None = None
    min_domain_mass: float | None = None
    drift_linf: float | None = None


@dataclass(frozen=True)
class FeatureSpec:
    """A curated list of features (S12), kept as JSON next to the code that uses it."""

    features: tuple[Feature, ...]
    #: Features whose values were too many to be listed as a domain when the specification was inferred.
    open_domains: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> FeatureSpec:
        found = json.loads(text)
        features = tuple(Feature(**{**row, "domain": tuple(row["domain"]) if row.get("domain") else None}) for row in found["features"])
        return cls(features, tuple(found.get("open_domains", ())))

    def to_json(self) -> str:
        return json.dumps({"features": [asdict(f) for f in self.features], "open_domains": list(self.open_domains)}, indent=2, ensure_ascii=False)

    @classmethod
    def load(cls, path: str) -> FeatureSpec:
        with open(path, encoding="utf-8") as file:
            return cls.from_json(file.read())

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as file:
            file.write(self.to_json())

    def schema(self) -> T.StructType:
        """The specification as a Spark schema."""
        parts = [f"`{f.name}` {f.type if f.single else f'array<{f.type}>'}" for f in self.features]
        return T.StructType.fromDDL(", ".join(parts))


# The curated constraints of the training rows.
TRAINING_SPEC = FeatureSpec((
    Feature("synopsis", min_fraction=1.0, min_count=1, min_values=1, max_values=1),
    Feature("keywords", min_fraction=1.0, min_count=1, min_values=1, max_values=1),
    Feature("tags", single=False, min_fraction=1.0, min_count=1, min_values=1, min_domain_mass=0.95, drift_linf=0.05),
))

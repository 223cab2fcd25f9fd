"""Column roles of a scenario table: series key, time axis, tie-breaker, features, labels."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Roles:
    key: str = "scenario_id"
    time: str = "Time"
    features: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    tie: str | None = None          # unique order tie-breaker inside a series
    extra: tuple[str, ...] = field(default=())   # carried through untouched

    @property
    def order(self) -> list[str]:
        return [self.time] + ([self.tie] if self.tie else [])

    @property
    def passthrough(self) -> list[str]:
        cols = [self.key] + self.order + list(self.extra)
        seen, out = set(), []
        for c in cols:
            if c not in seen:
                seen.add(c)
                out.append(c)
        return out

    def with_features(self, features) -> "Roles":
        return replace(self, features=tuple(features))

    def with_labels(self, labels) -> "Roles":
        return replace(self, labels=tuple(labels))

    @staticmethod
    def infer(columns, key: str = "scenario_id", time: str = "Time", tie: str | None = None) -> "Roles":
        """Role rule: a name containing 'label' (any case) is a label; other non-key,
        non-time columns are features."""
        labels = [c for c in columns if "label" in c.lower()]
        skip = {key, time, tie} | set(labels)
        features = [c for c in columns if c not in skip]
        return Roles(key=key, time=time, features=tuple(features), labels=tuple(labels), tie=tie)

    @staticmethod
    def component(label: str) -> str:
        return label.replace("_label", "")

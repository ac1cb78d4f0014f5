"""Source definitions from YAML or dictionaries; unknown fields are errors."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from ..operators.cleaning import Rule


class ConfigError(ValueError):
    pass


def _strict(cls, data: dict[str, Any]):
    names = {f.name for f in fields(cls)}
    if unknown := sorted(set(data) - names):
        raise ConfigError(f"{cls.__name__}: unknown fields {', '.join(unknown)}")
    try:
        return cls(**data)
    except TypeError as error:
        raise ConfigError(f"{cls.__name__}: {error}") from error


@dataclass(frozen=True)
class FileSource:
    name: str
    url_template: str
    format: str = "json"
    partition_by: list[str] = field(default_factory=list)
    quality_rules: list[Rule] = field(default_factory=list)

    def __post_init__(self) -> None:
        rules = [r if isinstance(r, Rule) else _strict(Rule, r) for r in self.quality_rules]
        if len({r.name for r in rules}) != len(rules):
            raise ConfigError(f"{self.name}: rule names repeat")
        object.__setattr__(self, "quality_rules", rules)


@dataclass(frozen=True)
class RestSource:
    name: str
    base_url: str
    token_env: str | None = None
    per_page: int = 100
    max_tries: int = 5

    def __post_init__(self) -> None:
        if not 1 <= self.per_page <= 100:
            raise ConfigError("per_page lies between 1 and 100")


@dataclass(frozen=True)
class EventStream:
    name: str
    url: str
    token_env: str | None = None
    max_pages: int = 3
    poll_seconds: float = 60.0
    late_after_minutes: int = 10

    def __post_init__(self) -> None:
        if self.max_pages < 1 or self.poll_seconds <= 0 or self.late_after_minutes < 0:
            raise ConfigError(f"{self.name}: pages, interval and lateness must be positive")


def load(cls, path: str | Path):
    import yaml

    return _strict(cls, yaml.safe_load(Path(path).read_text()))

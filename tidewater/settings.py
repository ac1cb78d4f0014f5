"""Where a run finds things: defaults, overridden by environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "TIDEWATER_"


@dataclass(frozen=True)
class Settings:
    """``tables``: a folder of Parquet tables; ``store``: the versioned tables;
    ``late_minutes``: how late an event counts as late."""

    tables: str = "/root/testdata/sf0.001"
    store: str = "store"
    late_minutes: int = 10

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Values of ``TIDEWATER_<NAME>``; an unreadable one, or a name that is none
        of these, is a ValueError, so that a misspelt setting never passes unseen."""
        env, kinds, given = os.environ if env is None else env, {f.name: type(f.default) for f in fields(cls)}, {}
        for name, value in env.items():
            if name.startswith(PREFIX):
                own = name.removeprefix(PREFIX).lower()
                if own not in kinds:
                    raise ValueError(f"unknown setting {name}")
                try:
                    given[own] = kinds[own](value)
                except ValueError as error:
                    raise ValueError(f"{name} is no {kinds[own].__name__}: {value!r}") from error
        return cls(**given)

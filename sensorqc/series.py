"""Description of a gridded sensor series."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Series:
    """Names the key and time columns of a series and fixes its grid.

    ``step`` is the slot width in seconds. ``chunk`` is the number of slots one task handles:
    window work is partitioned by (keys, chunk), never by key alone, so one very long or very
    dense series is spread over many tasks.
    """

    keys: tuple[str, ...] = ("site", "parameter")
    time: str = "dt_round"
    step: int = 900
    chunk: int = 4096

    @property
    def chunk_seconds(self) -> int:
        return self.step * self.chunk

    def by(self, *keys: str) -> "Series":
        return replace(self, keys=tuple(keys))

    def at(self, time: str) -> "Series":
        return replace(self, time=time)

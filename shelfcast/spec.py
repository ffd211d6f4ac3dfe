"""What identifies a series in a panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec


@dataclass(frozen=True)
class PanelSpec:
    """Key columns, time column and target of a panel.

    A panel has one row per key and day, so a series is never longer than the
    calendar it covers. That bound is what lets the series windows run with one
    series per task; tables without it go through ``operators.ordered``.
    """

    keys: tuple[str, ...] = ("store_nbr", "family")
    time: str = "date"
    target: str = "sales"

    def series(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.time)

    def whole_series(self) -> WindowSpec:
        return Window.partitionBy(*self.keys)

    @property
    def grain(self) -> list[str]:
        return [*self.keys, self.time]


SALES = PanelSpec()

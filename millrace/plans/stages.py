"""A small registry of stages whose edges are DataFrames: order, skipping, resuming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class Stage:
    name: str
    run: Callable[[dict[str, DataFrame]], DataFrame]
    needs: list[str] = field(default_factory=list)
    enabled: bool = True
    status: str = "pending"


class StageGraph:
    """Stages by name. A disabled or failed stage makes those that need it `skipped`."""

    def __init__(self, stages: list[Stage]) -> None:
        self.stages = {s.name: s for s in stages}
        self.tables: dict[str, DataFrame] = {}

    def order(self) -> list[str]:
        """Names so that each comes after what it needs; ties keep the given order. Raises on unknown names and cycles."""
        for s in self.stages.values():
            if unknown := [n for n in s.needs if n not in self.stages]:
                raise ValueError(f"{s.name} needs unknown stages: {', '.join(unknown)}")
        done: list[str] = []
        while len(done) < len(self.stages):
            ready = [n for n, s in self.stages.items() if n not in done and all(x in done for x in s.needs)]
            if not ready:
                raise ValueError(f"cycle among {', '.join(n for n in self.stages if n not in done)}")
            done.append(ready[0])
        return done

    def execute(self, start_from: str | None = None, stop_at: str | None = None) -> dict[str, str]:
        """Run the stages from one name to another (all by default); returns their statuses."""
        order = self.order()
        first = order.index(start_from) if start_from else 0
        last = order.index(stop_at) if stop_at else len(order) - 1
        for name in order[first : last + 1]:
            stage = self.stages[name]
            if not stage.enabled or any(self.stages[n].status != "completed" for n in stage.needs if n in order[first:]):
                stage.status = "skipped"
                continue
            try:
                self.tables[name] = stage.run(self.tables)
                stage.status = "completed"
            except Exception as error:  # noqa: BLE001
                stage.status = f"failed: {error}"
        return {n: s.status for n, s in self.stages.items()}

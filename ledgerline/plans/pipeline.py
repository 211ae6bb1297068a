"""The steps and what each needs, in one place for the command line and for schedulers."""

from __future__ import annotations

import heapq
from graphlib import CycleError, TopologicalSorter

STEPS: dict[str, tuple[str, ...]] = {
    "ingest": (),
    "drift": ("ingest",),
    "validate": ("drift",),
    "aggregate": ("validate",),
    "train": ("aggregate",),
    "score": ("train",),
    "stability": ("score",),
    "vintage": ("validate",),
    "diagnose": ("stability", "vintage"),
}
#: For schedulers: the verdict's exit status is the point of the last step, so it is not tried again.
RETRIES = {name: 0 if name == "diagnose" else 2 for name in STEPS}


def execution_order(graph: dict[str, tuple[str, ...]] = STEPS) -> list[str]:
    """Each step after those it needs; where several could come, the one named first. Raises ValueError for a cycle or an unknown step."""
    sorter = TopologicalSorter(graph)
    try:
        sorter.prepare()
    except CycleError as why:
        raise ValueError(f"these steps wait for each other: {' > '.join(why.args[1])}") from why
    place, order = {step: k for k, step in enumerate(graph)}, []
    ready: list[int] = []
    while sorter.is_active():
        for step in sorter.get_ready():
            if step not in place:
                raise ValueError(f"a step that no one defines is needed: {step}")
            heapq.heappush(ready, place[step])
        step = list(graph)[heapq.heappop(ready)]
        order.append(step)
        sorter.done(step)
    return order

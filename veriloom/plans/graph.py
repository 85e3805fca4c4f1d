"""The graph's operators by name, for runs that are described by names."""

from __future__ import annotations

from collections.abc import Callable

from veriloom.plans import pipelines, stages

OPERATORS: dict[str, Callable] = {
    f.__name__: f
    for f in (
        stages.normalize_document, stages.atomic_items, stages.model_items, stages.blueprints, pipelines.generate_files, pipelines.compile_statements, stages.align,
        pipelines.split_large, pipelines.repair, pipelines.audit, stages.workspaces, pipelines.baseline,
    )
}


def operator(name: str) -> Callable:
    """The operator of that name; an unknown name raises with those that there are."""
    if name not in OPERATORS:
        raise KeyError(f"no operator {name!r}; there are {', '.join(sorted(OPERATORS))}")
    return OPERATORS[name]

"""Execution plan of a document pipeline: dependencies, order, restart, configuration layers, retries. Driver-side."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable

# Fixed stage names and dependencies.
EDGES = [
    ("ingestion", "classification"), ("classification", "preprocessing"), ("preprocessing", "layout"), ("layout", "text"),
    ("layout", "equations"), ("text", "report"), ("equations", "report"),
]
ORDER = ["ingestion", "classification", "preprocessing", "layout", "text", "equations", "report"]


class PlanError(ValueError):
    """A stage is unknown, or depends on one that is switched off, or on itself."""


def dependents(edges: list[tuple[str, str]], stage: str) -> set[str]:
    """All stages that need ``stage``, directly or not."""
    out: set[str] = set()
    todo = [stage]
    while todo:
        now = todo.pop()
        for a, b in edges:
            if a == now and b not in out:
                out.add(b)
                todo.append(b)
    return out


def execution_order(edges: list[tuple[str, str]], enabled: list[str], order: list[str] = ORDER) -> list[str]:
    """Enabled stages so that each follows what it needs; ties as in ``order``."""
    if unknown := set(enabled) - set(order):
        raise PlanError(f"unknown stages: {sorted(unknown)}")
    for a, b in edges:
        if b in enabled and a not in enabled:
            raise PlanError(f"{b} needs {a}, which is switched off")
    waiting, out = set(enabled), []
    while waiting:
        ready = [s for s in order if s in waiting and not any(b == s and a in waiting for a, b in edges)]
        if not ready:
            raise PlanError(f"cycle among {sorted(waiting)}")
        out.append(ready[0])
        waiting.discard(ready[0])
    return out


def restart_from(completed: set[str], stage: str, edges: list[tuple[str, str]] = EDGES) -> set[str]:
    """What stays completed when ``stage`` is to run again."""
    return completed - {stage} - dependents(edges, stage)


def layered(defaults: dict, file: dict | None = None, env_prefix: str | None = None, overrides: list[str] = ()) -> tuple[dict, dict]:
    """Dotted keys from defaults, a file, the environment and overrides, the later winning; and where each came from."""
    def flat(d, top=""):
        for k, v in d.items():
            yield from flat(v, f"{top}{k}.") if isinstance(v, dict) else [(top + k, v)]

    values, source = {}, {}
    layers = [("default", dict(flat(defaults))), ("file", dict(flat(file or {})))]
    if env_prefix:
        layers.append(("environment", {k[len(env_prefix) :].lower().replace("__", "."): v for k, v in os.environ.items() if k.startswith(env_prefix)}))
    layers.append(("override", dict(x.split("=", 1) for x in overrides)))
    for name, layer in layers:
        for k, v in layer.items():
            if name != "default" and k not in values:
                raise PlanError(f"unknown setting {k} in {name}")
            kind = type(defaults_value) if (defaults_value := values.get(k)) is not None else str
            values[k] = (str(v).lower() in ("1", "true", "yes") if kind is bool else kind(v)) if isinstance(v, str) else v
            source[k] = name
    return values, source


def config_hash(values: dict) -> str:
    return hashlib.sha256(json.dumps(values, sort_keys=True, default=str).encode()).hexdigest()


def retrying(fn: Callable, attempts: int = 3, base: float = 1.0, factor: float = 2.0, longest: float = 30.0, recoverable=(OSError, TimeoutError), sleep=time.sleep):
    """``fn`` with waits of base * factor^(n-1) between attempts, for recoverable errors only."""
    def call(*args, **kw):
        for n in range(1, attempts + 1):
            try:
                return fn(*args, **kw)
            except recoverable:
                if n == attempts:
                    raise
                sleep(min(longest, base * factor ** (n - 1)))

    return call

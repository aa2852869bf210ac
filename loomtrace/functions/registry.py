"""Named functions that callers plug in: filters, rewards, converters."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module
from pkgutil import iter_modules

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_function(path: str) -> Callable:
    """``package.module.name`` -> the object."""
    module, _, name = path.rpartition(".")
    return getattr(import_module(module), name)


def discover(package: str, marker: str, required: tuple[str, ...] = ()) -> dict[str, object]:
    """A package's modules by their marker's value, those that have all that is required."""
    root, found = import_module(package), {}
    for m in iter_modules(root.__path__):
        module = import_module(f"{package}.{m.name}")
        if hasattr(module, marker) and all(hasattr(module, r) for r in required):
            found[getattr(module, marker)] = module
    return found


def apply_filter(rows: DataFrame, group: list[str], predicate: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of groups that an aggregate predicate keeps, dropped groups with a reason)."""
    verdict = rows.groupBy(*group).agg(predicate.alias("_keep"), reason.alias("reason"))
    return rows.join(verdict.where("_keep").select(*group), group, "left_semi"), verdict.where("not _keep").drop("_keep")


def dispatch(kind: Column, rewards: dict[str, Column], boxed: Callable[[Column], Column] | None = None) -> Column:
    """A reward by its type's name; an unknown type is an error."""
    out = None
    for name, value in rewards.items():
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown reward type: "), kind)))

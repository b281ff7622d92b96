"""Every registered query, by area."""

from importlib import import_module

AREAS = ["star", "tabular", "udfs", "streams", "graphs", "features", "learning"]


def all_registries():
    return [import_module(f"starloom.registry.{area}").REGISTRY for area in AREAS]

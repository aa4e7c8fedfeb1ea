"""Imports every module that registers queries."""

from refrain.plans import builders, experiments, facts, files, layers, learning, moods, pages, predictions, refresh, showcase, texts  # noqa: F401
from refrain.plans.registry import REGISTRY

__all__ = ["REGISTRY"]

"""Imports every module that registers queries."""

from queryset import assembly, basics, evaluate, features, labels, models, population, ranking, sources  # noqa: F401

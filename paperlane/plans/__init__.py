"""Registered queries, each with the SQL that checks it."""

from paperlane.plans import (
    answers, automation, increments, loading, profiling, relations, scoring, storage, texts, training,
)
from paperlane.plans.registry import REGISTRY

__all__ = [
    "REGISTRY", "answers", "automation", "increments", "loading", "profiling", "relations",
    "scoring", "storage", "texts", "training",
]

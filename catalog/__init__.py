"""Query catalog: one entry per operator, with the Spark callable and its SQL twin."""

from __future__ import annotations


def load():
    """All registered entries by name."""
    from catalog import base, features, ingest, modelling, models, profile, quality, serving  # noqa: F401

    return base.REGISTRY

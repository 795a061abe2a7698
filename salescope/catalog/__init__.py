"""Every operator as a runnable query, with the SQL that checks it."""

from __future__ import annotations

from salescope.catalog.registry import REGISTRY


def load() -> dict:
    from salescope.catalog import (  # noqa: F401  (import registers the queries)
        basics,
        datasets,
        events,
        models,
        questions,
        quality,
        series,
    )

    return REGISTRY

"""Import every query module once and expose the catalog."""

from __future__ import annotations

import importlib

from panelcast.plans import catalog

_MODULES = [
    "panelcast.plans.q_features",
    "panelcast.plans.q_profile",
    "panelcast.plans.q_eval",
    "panelcast.plans.q_models",
]


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def queries():
    _load()
    return dict(catalog.QUERIES)


def oracle_sql():
    _load()
    return dict(catalog.ORACLES)

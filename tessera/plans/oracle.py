"""Oracle SQL (DuckDB dialect) for the registered queries.

Every statement is an independent restatement of the query's meaning over
the raw tables; the ``manifest`` rules are the CTE in
``tessera.sources.manifest``.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from tessera.sources.manifest import MANIFEST_CTE

ORACLE: dict[str, str] = {}


def sql(name: str, body: str, manifest: bool = True) -> None:
    """Register ``body``; when ``manifest`` is set, ``body`` may start with
    further CTEs (``name AS (...), ... SELECT``) or a bare SELECT."""
    body = body.strip()
    if manifest:
        if body.upper().startswith("SELECT"):
            text = f"WITH RECURSIVE {MANIFEST_CTE}\n{body}"
        else:
            text = f"WITH RECURSIVE {MANIFEST_CTE},\n{body}"
    else:
        text = body
    if name in ORACLE:
        raise ValueError(f"duplicate oracle {name}")
    ORACLE[name] = text


def load_all() -> dict[str, str]:
    from tessera.plans import (o_core, o_groups, o_features, o_ml)  # noqa: F401
    return dict(ORACLE)

"""Checks on the paths a job is given."""

from __future__ import annotations


def require_apart(target: str, *sources: str) -> None:
    """A job must not overwrite what it reads: the overwrite happens before the read."""
    wanted = target.rstrip("/") + "/"
    for source in sources:
        found = source.rstrip("/") + "/"
        if wanted.startswith(found) or found.startswith(wanted):
            raise ValueError(f"target {target} and source {source} overlap")

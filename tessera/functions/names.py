"""Column-name standardisation (metadata only, runs on the driver over the schema)."""

from __future__ import annotations

import re

_DROP = re.compile(r"[^a-z0-9_]")


def standardize_name(name: str) -> str:
    """strip -> lower -> ' ' to '_' -> drop everything outside [a-z0-9_]."""
    return _DROP.sub("", name.strip().lower().replace(" ", "_"))


def standardize_names(names: list[str]) -> list[str]:
    """Standardise and make unique: a later collision gets ``_2``, ``_3``...

    The original silently produced duplicate names; duplicates break
    DataFrame column resolution, so collisions are suffixed.
    """
    out, seen = [], {}
    for n in names:
        s = standardize_name(n) or "col"
        if s in seen:
            seen[s] += 1
            s2 = f"{s}_{seen[s]}"
            while s2 in seen:
                seen[s] += 1
                s2 = f"{s}_{seen[s]}"
            s = s2
        seen.setdefault(s, 1)
        out.append(s)
    return out

"""Species: names and codes of the organisms a run may be about."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Species:
    name: str
    scientific: str
    taxon: int
    entry_suffix: str
    nuclear_code: int = 1
    mito_code: int = 2


# Organisms, taxon numbers and entry name suffixes.
KNOWN = {
    s.name: s
    for s in (Species("human", "Homo sapiens", 9606, "HUMAN"), Species("mouse", "Mus musculus", 10090, "MOUSE"), Species("rat", "Rattus norvegicus", 10116, "RAT"), Species("zebrafish", "Danio rerio", 7955, "DANRE"))
}
CODES = (1, 2)


def species(name: str = "human", **changes: object) -> Species:
    """A known species, or one described by its fields; genetic codes that are
    not implemented are refused, never guessed."""
    base = KNOWN.get(name.lower())
    if base is None and not {"scientific", "taxon", "entry_suffix"} <= set(changes):
        raise ValueError(f"unknown species {name!r}; known are {', '.join(sorted(KNOWN))}")
    made = Species(**({**base.__dict__, **changes} if base else {"name": name, **changes}))
    for code in (made.nuclear_code, made.mito_code):
        if code not in CODES:
            raise ValueError(f"genetic code {code} is not implemented")
    return made

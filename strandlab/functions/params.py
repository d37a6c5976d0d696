"""Parameters of a run and the modification specification."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: A-Z letters that name a base in a specification; N stands for any (fixed values).
BASES = "ACGTN"


@dataclass(frozen=True)
class ModSpec:
    """One modification, as ``<base>+<code>``: a ChEBI number or a single letter."""

    name: str
    base: str
    code: str

    @staticmethod
    def parse(text: str) -> ModSpec:
        m = re.fullmatch(rf"([{BASES}])\+([0-9]+|[A-Za-z])", text.strip())
        if not m:
            raise ValueError(f"modification {text!r} is not of the form <base>+<code>")
        return ModSpec(text.strip(), m[1], m[2])


def parse_mods(texts) -> list[ModSpec]:
    """Specifications from one or several texts, each of which may be a comma-separated list."""
    return [ModSpec.parse(x) for t in ([texts] if isinstance(texts, str) else texts) for x in t.split(",") if x.strip()]


@dataclass(frozen=True)
class Params:
    """What a run computes; the defaults are the command line's."""

    mods: tuple[ModSpec, ...] = field(default_factory=lambda: (ModSpec.parse("T+B"),))
    binarise: float | None = None
    supplementary: bool = True
    max_dist: int = 15000
    min_len: int = 1
    bin_size: int = 1000
    cov_bin_size: int = 50
    exclude_prefix: tuple[str, ...] = ("chrM",)
    float_mode: str = "x87"
    rds_level: int = 6

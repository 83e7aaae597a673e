"""Job options with the reference defaults and clamping ranges.

Out-of-range values are pulled into range (``min(max(x, lo), hi)``), never
rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

# Defaults and (lo, hi) ranges of the reference options.
TIMEOUT_MS = (10_000, 1_000, 60_000)
MAX_BYTES = (1_500_000, 10_000, 5_000_000)
MAX_CHARS = (50_000, 1_000, 200_000)
MAX_REDIRECTS = (3, 0, 10)
LINK_LIMIT = (50, 1, 200)
FEED_MAX_ITEMS = (10, 1, 50)
SUMMARY_CAP = 500
CONTENT_CAP = 2_000
SNIFF_BYTES = 2_048


def clamp(value: int | None, spec: tuple[int, int, int]) -> int:
    default, lo, hi = spec
    v = default if value is None else int(value)
    return min(max(v, lo), hi)


@dataclass(frozen=True)
class ExtractOptions:
    """Options of the page extraction plan (``format``, ``max_chars``)."""
    markdown: bool = True
    max_chars: int = MAX_CHARS[0]

    @classmethod
    def of(cls, fmt: str = "markdown", max_chars: int | None = None, clamp_chars: bool = True):
        if fmt not in ("markdown", "text"):
            raise ValueError(f"format must be markdown or text, got {fmt!r}")
        mc = clamp(max_chars, MAX_CHARS) if clamp_chars else int(max_chars or MAX_CHARS[0])
        return cls(markdown=(fmt == "markdown"), max_chars=mc)

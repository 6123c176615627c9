"""Similarity of normalised names."""

from __future__ import annotations

from difflib import SequenceMatcher


def name_score(a: str | None, b: str | None, stop: tuple[str, ...] = ()) -> float:
    """1 for equal names; else the better of the shared tokens (a quarter more if one name holds the other) and the matching-blocks ratio, 1 at most."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = set(a.split()) - set(stop), set(b.split()) - set(stop)
    if not x or not y:
        return 0.0
    shared = len(x & y) / max(len(x), len(y)) + (0.25 if a in b or b in a else 0)
    return min(1.0, max(shared, SequenceMatcher(None, a, b).ratio()))

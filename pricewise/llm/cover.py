"""Difference covers: of any two positions, some shift below the period puts both into the
cover, so a match longer than the period shares an anchor that both sides sample."""

from __future__ import annotations

import numpy as np

#: Perfect difference sets by period (each residue is one difference).
PERFECT = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}


def is_cover(period: int, members: tuple[int, ...]) -> bool:
    return len({(a - b) % period for a in members for b in members}) == period


def cover_positions(period: int, first: np.ndarray, size: np.ndarray, window: int,
                    least: int) -> np.ndarray:
    """Cover positions at which a window fits, over runs that begin at ``first`` and are
    ``size`` long; runs under ``least`` have none. Positions count from each run's begin."""
    room = np.where(size >= least, size - window + 1, 0)
    longest = int(room.max()) if len(room) else 0
    pattern = np.nonzero(np.isin(np.arange(max(longest, 0)) % period, PERFECT[period]))[0]
    n = np.searchsorted(pattern, np.maximum(room, 0))
    total = int(n.sum())
    place = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first, n) + pattern[place]


def reached(anchors: np.ndarray, first_of: np.ndarray, period: int, length: int) -> np.ndarray:
    """True at positions from which an anchor is less than a period ahead, in the same run
    (``first_of`` is the begin of each anchor's run)."""
    low = np.maximum(anchors - (period - 1), first_of)
    step = np.bincount(low, minlength=length + 1) - np.bincount(anchors + 1, minlength=length + 1)
    return np.cumsum(step[:length]) > 0


def covered(starts: np.ndarray, window: int, length: int) -> np.ndarray:
    """True at positions inside a window that begins at one of the distinct ``starts``."""
    step = np.zeros(length + 1, dtype=np.int32)
    step[starts] += 1
    step[starts + window] -= 1
    return np.cumsum(step[:length]) > 0

"""Exact order statistics of values that stay where they are.

Each part of the data answers a question with a summary of bounded size: how many of its values
lie at or below ``lo``, below and up to each probe, strictly between ``lo`` and ``hi``, and values
of the last at regular ranks. Added up, summaries bound every rank from both sides; the bounds of
the wanted rank make the next, narrower question. Probes are values that were seen, counted
exactly, so a value that many rows share cannot hold up the search.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np

#: Values that a summary samples at most. Fewer than that are all there.
SAMPLES = 64
PROBES = 8


class Question(NamedTuple):
    """The wanted rank (from 1, over all parts), known to lie in (lo, hi], and values to count at."""

    rank: int
    lo: float
    hi: float
    probes: list[float]


class Summary(NamedTuple):
    below: int
    probed: list[int]  # for each probe, values less than it, then values up to it
    inner: int
    samples: list[float]


def positions(n: int) -> np.ndarray:
    """Ranks at which ``n`` sorted values are sampled, the last one included."""
    if n <= SAMPLES:
        return np.arange(1, n + 1)
    return -(-np.arange(1, SAMPLES + 1) * n // SAMPLES)


def summarized(ordered: np.ndarray, question: Question) -> Summary:
    """What sorted values answer."""
    a = int(np.searchsorted(ordered, question.lo, side="right"))
    b = max(a, int(np.searchsorted(ordered, question.hi, side="left")))
    probed = [int(np.searchsorted(ordered, p, side=s)) for p in question.probes for s in ("left", "right")]
    return Summary(a, probed, b - a, ordered[a + positions(b - a) - 1].tolist())


def rank_of(q: float, n: int) -> int:
    """The rank ``ceil(q * n)`` of a quantile, at least the first."""
    return max(1, math.ceil(q * n))


def narrowed(question: Question, answers: list[Summary]) -> float | Question:
    """The value of the wanted rank, or the next question."""
    lo, hi = question.lo, question.hi
    for i, p in enumerate(question.probes):
        less, up_to = (sum(a.probed[2 * i + j] for a in answers) for j in (0, 1))
        if less < question.rank <= up_to:
            return p
        lo, hi = (max(lo, p), hi) if up_to < question.rank else (lo, min(hi, p))
    below = sum(a.below for a in answers)
    rank = question.rank - below
    if rank > sum(a.inner for a in answers):
        return question.hi
    values = np.concatenate([a.samples for a in answers])
    least, most = [], []
    for a in answers:
        at = positions(a.inner)
        least.append(np.diff(at, prepend=0))
        most.append(np.diff(np.append(at, a.inner + 1)) if len(at) else at)
    order = np.argsort(values, kind="stable")
    values = values[order]
    # of equal values the last sum holds
    least = np.cumsum(np.concatenate(least)[order])
    most = np.cumsum(np.concatenate(most)[order]) + sum(int(positions(a.inner)[0]) - 1 for a in answers if a.inner)
    last = np.append(values[1:] != values[:-1], True)
    values, least, most = values[last], least[last], most[last]
    reached = values[np.searchsorted(least, rank)]
    if all(a.inner <= SAMPLES for a in answers):
        return float(reached)
    missed = values[most < rank]
    hi = min(hi, float(reached))
    if len(missed):
        lo = max(lo, float(missed[-1]))
    inside = values[(values > lo) & (values < hi)]
    probes = inside[np.unique(np.linspace(0, len(inside) - 1, PROBES).astype(int))] if len(inside) else inside
    return Question(question.rank, lo, hi, probes.tolist())

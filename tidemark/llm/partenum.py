"""PartEnum signatures: sets that are similar enough share at least one.

For sets r and s with a Jaccard similarity of at least g, the symmetric difference has at
most ``(|r| + |s|) (1 - g) / (1 + g)`` elements. The domain of the elements, 64-bit hashes,
is cut into groups of ``cells`` cells each, and for every group the subsets of
``cells - slack`` cells are enumerated: a signature is the content of such a subset. A group
with at most ``slack`` differing elements has a subset that is equal in both sets. As each
spoilt group takes ``slack + 1`` differing elements, one more group than those can spoil is
enough, so a set only emits groups, in domain order, until that many of them are rich. A
rich group has ``slack + 1`` cells that are not empty, so none of its subsets is. If r stops
first, s has emitted every group that r has, so the equal subset is in both.

The cut depends on the size band, and a set whose partners may lie in the next band emits
for both. A set that has too few rich groups emits all its groups and, besides, its first
elements in domain order, one more than can differ; two such sets share one of these.

With ``surplus`` a set emits more groups than it must. If a subset is one cell, each
differing element spoils at most one, so similar sets then share at least ``assured`` of
the signatures of a band, and a set need not be looked for under its most frequent ones.

In the finest cut every element is a cell, and a signature, by itself. Then only a set's own
elements that the other lacks are spoilt: with ``common`` elements in both, the first of
them in any order of the domain has at most ``size - common`` others before it. ``front``
is how far such a first one can stand from the front, for a partner of any size.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.words import mixed

BAND_START = 4
BAND_RATIO = 2
PREFIX_BAND = 1 << 20  # tag of signatures that are single elements


@dataclass(frozen=True)
class PartEnum:
    """``percent`` is the similarity that counts, in percent."""

    percent: int = 80
    cells: int = 2
    slack: int = 1
    surplus: float = 1.5

    def differing(self, size: int) -> int:
        """The most elements that may differ between a set of this size and one similar to it."""
        return (size + size * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)

    def common(self, size: Column, other: Column) -> Column:
        """The fewest elements that similar sets of these sizes have in common."""
        return F.ceil((size + other) * self.percent / (100 + self.percent))

    def front(self, size: np.ndarray) -> np.ndarray:
        """The last place, from 1, at which the first element common to a similar set can stand."""
        return size + size * -self.percent // 100 + 1

    def groups_needed(self, size: int) -> int:
        return int((self.differing(size) // (self.slack + 1) + 1) * self.surplus)

    def bands(self, size: int) -> list[int]:
        band, top = 0, BAND_START
        while top < size:
            band, top = band + 1, top * BAND_RATIO
        return [band] if size * 100 // self.percent <= top else [band, band + 1]

    def groups(self, band: int) -> int:
        """Groups in a band: a fifth more than its largest sets need, as some are poor."""
        return self.groups_needed(BAND_START * BAND_RATIO**band) * 6 // 5 + 2

    def assured(self, size: int, emitted: int) -> int:
        """The fewest signatures of a band that a set shares there with any set similar to it.

        A partner that is not poor has emitted ``slack + 1`` cells for each group it needs.
        """
        if self.cells - self.slack != 1:
            return 1
        least = emitted
        for partner in (-(-size * self.percent // 100), size * 100 // self.percent):
            theirs = min(emitted, self.groups_needed(partner) * (self.slack + 1))
            least = min(least, theirs - (size + partner) * (100 - self.percent) // (100 + self.percent))
        return max(1, least - 2)  # between the two partner sizes, rounding can take two

    def signatures(self, elements: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Band and signatures, for each band, of a set given as its sorted distinct hashes."""
        if not len(elements):
            return []
        needed, content = self.groups_needed(len(elements)), mixed(elements)
        out, poor = [], False
        for band in self.bands(len(elements)):
            cells = self.groups(band) * self.cells
            of = (elements >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)
            first = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1))
            filled = of[first].astype(np.int64)
            held = np.zeros(cells, np.uint64)
            held[filled] = mixed(np.add.reduceat(content, first) + filled.astype(np.uint64)) | np.uint64(1)
            held = held.reshape(-1, self.cells)
            rich = np.flatnonzero((held != 0).sum(axis=1) > self.slack)
            enough = len(rich) >= needed
            poor |= not enough
            held = held[: rich[needed - 1] + 1] if enough else held
            group, found = np.arange(len(held), dtype=np.uint64), []
            for number, subset in enumerate(combinations(range(self.cells), self.cells - self.slack)):
                chosen = held[:, subset]
                tag = mixed(group * np.uint64(1 << 24) + np.uint64((band << 8) + number))
                signature = mixed(chosen.sum(axis=1, dtype=np.uint64) + tag)
                found.append(signature[(chosen != 0).any(axis=1)])
            out.append((band, np.unique(np.concatenate(found))))
        if poor:
            prefix = elements[: self.differing(len(elements)) + 1]
            out.append((PREFIX_BAND, mixed(mixed(prefix) + np.uint64(PREFIX_BAND))))
        return out

"""Context-tree weighting over bytes: the arithmetic of one part of the tree.

A *gram* is a context of ``depth`` bytes and the byte that follows, kept in one unsigned 64-bit number: the byte next
to the predicted one is the most significant, the farthest context byte comes before the predicted byte, which is
the least significant. So the context of any smaller depth is a prefix. A *node* is a context and a bit prefix of the
predicted byte (binary decomposition, numbered 1 to 255 as in a heap); its key is the context shifted left by eight
plus that number.
"""

from __future__ import annotations

import numpy as np

HALF_LOG_PI = 0.5 * np.log(np.pi)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0 (Stirling's series after shifting x above 8)."""
    x = np.asarray(x, np.float64).copy()
    shift = np.zeros_like(x)
    while (small := x < 8).any():
        shift[small] += np.log(x[small])
        x[small] += 1
    inverse = 1 / x
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov: the logarithm of the probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - 2 * HALF_LOG_PI


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of the values of each."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], *(np.add.reduceat(v[order], starts) for v in values)


def leaf_nodes(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of full depth with their zeros and ones; grams are distinct and ascending."""
    context, symbol = grams >> np.uint64(8) << np.uint64(8), grams & np.uint64(255)
    keys, zeros, ones = [], [], []
    for bit in range(8):
        number = np.uint64(1 << bit) | (symbol >> np.uint64(8 - bit))
        one = (symbol >> np.uint64(7 - bit) & np.uint64(1)).astype(np.float64)
        k, z, o = summed(context | number, counts * (1 - one), counts * one)
        keys.append(k)
        zeros.append(z)
        ones.append(o)
    return summed(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))


def parents(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nodes of the next smaller depth with sums over their children."""
    return summed(keys >> np.uint64(16) << np.uint64(8) | keys & np.uint64(255), *values)


class Level:
    """The nodes of one depth: key, share of the node's own estimate in its mixture, estimated probability of a one."""

    def __init__(self, keys, zeros, ones, below=None):
        own = log_kt(zeros, ones)
        if below is None:
            self.log_weighted = own
            self.share = np.ones(len(keys), np.float32)
        else:
            self.log_weighted = np.logaddexp(own, below) - np.log(2)
            self.share = np.exp(own - np.log(2) - self.log_weighted).astype(np.float32)
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.estimate = ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32)

    def above(self) -> "Level":
        keys, zeros, ones, below = parents(self.keys, self.zeros, self.ones, self.log_weighted)
        return Level(keys, zeros, ones, below)


def grow(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels ``depth`` down to ``top`` of the part of the tree these grams span, deepest first."""
    levels = [Level(*leaf_nodes(grams, counts))]
    while len(levels) <= depth - top:
        levels.append(levels[-1].above())
    return levels


def log2_probability(grams: np.ndarray, depth: int, levels: dict[int, tuple]) -> np.ndarray:
    """Bits of each gram's last byte, negative: the mixture over all depths, bit by bit.

    ``levels`` has (keys, share, estimate) by depth. A context the training text never had inherits the estimate of
    the next shorter one.
    """
    total = np.zeros(len(grams))
    symbol = grams & np.uint64(255)
    for bit in range(8):
        number = np.uint64(1 << bit) | (symbol >> np.uint64(8 - bit))
        is_one = (symbol >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        mixed, left = np.zeros(len(grams)), np.ones(len(grams))
        last = np.full(len(grams), 0.5)
        for d in range(depth + 1):
            keys, share, estimate = levels[d]
            wanted = (grams >> np.uint64(8 * (depth - d + 1)) << np.uint64(8) if d else np.uint64(0)) | number
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            found = keys[at] == wanted if len(keys) else np.zeros(len(grams), bool)
            own = np.where(found, estimate[at], last) if len(keys) else last
            part = np.where(found, share[at], 1.0) if len(keys) else np.ones(len(grams))
            mixed += left * part * own
            left *= 1 - part
            last = own
        mixed += left * last
        total += np.log2(np.where(is_one, mixed, 1 - mixed))
    return total

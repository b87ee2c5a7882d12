"""Burrows-Wheeler transforms of shards of strings and their merge.

Strings are arrays of uint16 symbols without 0; each ends in a sentinel 0, and
sentinels count as distinct, in the order of the strings. A merge keeps the
shards' transforms as they are and refines only the interleave (which shard the
next row comes from): one round sorts rows stably by their symbol, after which
they are in order of one more leading symbol. Rows that part in round k share
k - 1 symbols with the row above: the common prefixes come with the merge, and
no suffix is compared or sorted again.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of a shard's suffixes in order, by prefix doubling."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:]
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n:
            return order


def transform(text: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """The symbol before each suffix in order; 0 before a string's first."""
    before = np.r_[np.zeros(1, text.dtype), text[:-1]]
    return before[suffixes]


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' rows after ``depth`` rounds, and the common
    prefix of each row with the one above, where it is under ``depth``
    (``depth`` stands for that or more).

    Returns ``row[i]`` = merged row of the i-th row of the concatenated shards,
    and ``lcp`` by merged row.
    """
    symbols = np.concatenate(transforms)
    n = len(symbols)
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint16), [len(t) for t in transforms])
    per_shard = [int((t == 0).sum()) for t in transforms]
    sentinels = np.repeat(np.arange(len(transforms), dtype=np.uint16), per_shard)
    m = len(sentinels)
    order_of = shard.copy()
    block = np.zeros(n, np.int32)
    lcp = np.full(n, depth, np.int32)
    open_ = np.ones(n, bool)
    for k in range(1, depth + 1):
        at = np.argsort(order_of, kind="stable")
        here = np.empty(n, symbols.dtype)
        here[at] = symbols
        by = np.argsort(here, kind="stable")
        sym, blk = here[by], block[by]
        nxt = order_of[by]
        nxt[:m] = sentinels
        part = np.r_[True, (sym[1:] != sym[:-1]) | (blk[1:] != blk[:-1])]
        part[:m + 1] = True
        fresh = part & open_
        lcp[fresh] = k - 1
        open_ &= ~part
        done = not fresh.any() and (nxt == order_of).all()
        order_of, block = nxt, np.cumsum(part, dtype=np.int32)
        if done or not open_.any():
            break
    return np.argsort(order_of, kind="stable"), lcp


def repeated(text: np.ndarray, shard_ends: list[int], depth: int) -> np.ndarray:
    """Positions of ``text`` (whole strings with their sentinels, cut into
    shards at ``shard_ends``) whose next ``depth`` symbols stand elsewhere too."""
    arrays, transforms, a = [], [], 0
    for b in shard_ends:
        own = text[a:b]
        order = suffix_array(own)
        arrays.append(order + a)
        transforms.append(transform(own, order))
        a = b
    row, lcp = merge(transforms, depth)
    same = lcp >= depth
    same[0] = False
    same[:-1] |= same[1:].copy()
    return np.concatenate(arrays)[same[row]]

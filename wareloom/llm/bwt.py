"""Burrows-Wheeler transforms of sets of byte strings, and their merging.

A shard's transform is made by sorting its own suffixes once. Several
transforms are merged from the transforms alone. Each row starts in the block
of its first byte; a round looks up the block of the suffix that lies as many
bytes further on as the blocks are deep, and so doubles the depth. Along each
shard the pairs of blocks are in order already, so a round merges sorted lists
and sorts nothing anew. After a round that has reached depth h, neighbours in
one block have a common prefix of h bytes at least, and neighbours in different
blocks a shorter one: the blocks of the last round are the intervals of suffixes
that repeat.

The way from a row to the row of the next suffix is the stable sorting of the
transform's symbols, and its powers give the rows several bytes on.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 256


def _ranks(keys: np.ndarray, bound: int) -> tuple[np.ndarray, int]:
    """The rank of each key among the different ones, and their number; all keys are below ``bound``."""
    bits = len(keys).bit_length()
    if bound << bits > 1 << 63:
        values, ranks = np.unique(keys, return_inverse=True)
        return ranks.reshape(-1), len(values)
    # With its place in the low bits a key is sorted by value, much faster than by argsort.
    merged = np.sort((keys << bits) | np.arange(len(keys)))
    places = merged & ((1 << bits) - 1)
    merged >>= bits
    ranks = np.empty(len(keys), dtype=np.int64)
    number = np.cumsum(np.concatenate([[0], merged[1:] != merged[:-1]]))
    ranks[places] = number
    return ranks, int(number[-1]) + 1


def transform(strings: list[bytes]) -> np.ndarray:
    """The transform of the strings. String t ends with a symbol of its own, t; byte b is the symbol ``len(strings) + b``."""
    count = len(strings)
    lengths = np.array([len(s) for s in strings], dtype=np.int64) + 1
    ends = np.cumsum(lengths) - 1
    symbols = np.empty(int(lengths.sum()), dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends] = False
    symbols[ends] = np.arange(count)
    symbols[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + count
    # What lies beyond an end does not matter: the end itself tells any two suffixes apart.
    beyond = lambda values, far: np.concatenate([values[far:], values[:far]])
    keys, bound, depth = symbols, SYMBOLS + count, 1
    while bound * (SYMBOLS + count) << len(symbols).bit_length() <= 1 << 63 and depth < len(symbols):
        keys, bound, depth = keys * (SYMBOLS + count) + beyond(symbols, depth), bound * (SYMBOLS + count), depth + 1
    ranks, kinds = _ranks(keys, bound)
    while kinds < len(symbols):
        ranks, kinds = _ranks(ranks * kinds + beyond(ranks, depth), kinds * kinds)
        depth *= 2
    order = np.empty(len(symbols), dtype=np.int64)
    order[ranks] = np.arange(len(symbols))
    before = np.arange(len(symbols)) - 1
    before[np.concatenate([[0], ends[:-1] + 1])] = ends
    return symbols[before[order]].astype(np.int32)


def successors(bwt: np.ndarray) -> np.ndarray:
    """For each row the row of the suffix that is one byte shorter; a string's end is followed by its start."""
    return np.argsort(bwt, kind="stable").astype(np.int32)


def _jump(powers: dict[int, np.ndarray], far: int) -> np.ndarray:
    """Rows ``far`` bytes on, from the powers of two."""
    rows = None
    for step, jump in powers.items():
        if far & step:
            rows = jump if rows is None else jump[rows]
    return rows


def interleave(shards: list[tuple[np.ndarray, int]], depth: int) -> list[np.ndarray]:
    """The block of each row of each shard: equal where the next ``depth`` bytes are equal, in their order.

    ``shards`` are transforms with their number of strings.
    """
    firsts = [np.maximum(np.sort(bwt) - count + 1, 0).astype(np.int64) for bwt, count in shards]
    powers = [{1: successors(bwt)} for bwt, _ in shards]
    edges = np.cumsum([0, *(len(f) for f in firsts)])
    blocks, base, reached = firsts, SYMBOLS + 1, 1
    while reached < depth:
        step = min(reached, depth - reached)
        pairs = np.concatenate([b * base + b[_jump(p, step)] for b, p in zip(blocks, powers)])
        # Each shard's part is in order, so this merges as many lists as there are shards.
        order = np.argsort(pairs, kind="stable")
        merged = pairs[order]
        number = np.concatenate([[0], np.cumsum(merged[1:] != merged[:-1])])
        found = np.empty(len(pairs), dtype=np.int64)
        found[order] = number
        blocks = [found[a:b] for a, b in zip(edges, edges[1:])]
        base, reached = int(number[-1]) + 1, reached + step
        if reached < depth:
            for p in powers:
                widest = max(p)
                if 2 * widest <= depth:
                    p[2 * widest] = p[widest][p[widest]]
    return blocks


def starts(bwt: np.ndarray, count: int, far: int) -> np.ndarray:
    """Rows of the first ``far`` suffixes of each string, by string and place; rows of shorter strings run on."""
    follow = successors(bwt)
    rows = np.empty((count, far), dtype=np.int32)
    at = follow[:count]  # The ends sort first, in the order of the strings.
    for place in range(far):
        rows[:, place] = at
        at = follow[at]
    return rows


def repeated(strings: list[bytes], copies: np.ndarray, windows: np.ndarray, depth: int, shard_bytes: int) -> list[np.ndarray]:
    """For each string, which of its first ``windows`` places start ``depth`` bytes that occur anywhere else.

    A string that stands for ``copies`` equal ones repeats by itself. The
    strings are transformed in shards of some ``shard_bytes`` and merged.
    """
    sizes = np.cumsum([len(s) for s in strings])
    cuts = np.searchsorted(sizes, np.arange(shard_bytes, int(sizes[-1]), shard_bytes)).tolist()
    edges = sorted({0, *cuts, len(strings)})
    spans = list(zip(edges, edges[1:]))
    shards = [(transform(strings[a:b]), b - a) for a, b in spans]
    blocks = interleave(shards, depth)
    placed = []
    for (a, b), (bwt, count), block in zip(spans, shards, blocks):
        rows = starts(bwt, count, int(windows[a:b].max()))
        inside = np.arange(rows.shape[1])[None, :] < windows[a:b, None]
        placed.append((block[rows], inside))
    weight = np.zeros(max(int(b.max()) for b in blocks) + 1, dtype=np.int64)
    for (a, b), (block, inside) in zip(spans, placed):
        np.add.at(weight, block[inside], np.broadcast_to(copies[a:b, None], block.shape)[inside])
    return [weight[block[n, :windows[a + n]]] > 1 for (a, b), (block, _) in zip(spans, placed) for n in range(b - a)]

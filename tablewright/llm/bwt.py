"""Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

A shard is a list of byte strings, each closed by a terminator that sorts
before every byte.  Its transform determines, by a stable sort of its symbols,
the first symbol of every suffix and the step from a suffix to the next, so the
merge below reads transforms only, never the texts.

The merge keeps the interleave of the shards' rows, sorted by the first ``d``
symbols, as blocks of rows that agree in them.  A round refines it to ``3 d``:
the rows of a block are told apart by the blocks of the suffixes ``d`` and ``2 d``
steps further.  Rows alone in their block are settled.  Blocks that remain at depth
``length`` are the intervals whose common prefix is at least that long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols of the first key: as many as fit a number.
FIRST = 7


@dataclass
class Shard:
    bwt: np.ndarray  # symbols 0 (terminator) to 256, in suffix order
    text: np.ndarray  # for each row, the string that its suffix is of
    place: np.ndarray  # and where in the string the suffix starts


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return new


def _regroup(rows: np.ndarray, block: np.ndarray, keys: list[np.ndarray], places: int) -> np.ndarray:
    """Split the blocks of ``rows`` by ``keys`` (blocks, below ``places``); ``block`` gets the new block
    of each row (its first place in the order).  Returns the rows that share one."""
    key = block[rows]
    for k in keys:
        key = key * places + k
    order = np.argsort(key)
    rows, key = rows[order], key[order]
    old = block[rows]
    at = np.arange(len(rows))
    new = _starts(key)
    begin = np.maximum.accumulate(np.where(_starts(old), at, 0))
    head = np.maximum.accumulate(np.where(new, at, 0))
    block[rows] = old + head - begin
    return rows[_with_others(new)]


def _with_others(new: np.ndarray) -> np.ndarray:
    """Which of the sorted rows aren't alone, given where a group begins."""
    return ~(new & np.append(new[1:], True))


def _first_blocks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of every row by its first key, and the rows that share one."""
    order = np.argsort(key)
    new = _starts(key[order])
    block = np.empty(len(key), np.int64)
    block[order] = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return block, order[_with_others(new)]


def _ways(n: int) -> int:
    """How many times the depth a round reaches: two keys ahead fit a number with the block if it is below 2^21."""
    return 3 if n < 1 << 21 else 2


def shard_bwt(strings: list[bytes]) -> Shard:
    """The transform of one shard, by prefix tripling over its suffixes (doubling in one of more than 2^21 symbols)."""
    lengths = np.array([len(s) + 1 for s in strings])
    n = int(lengths.sum())
    ends = np.cumsum(lengths)
    begins = ends - lengths
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[ends - 1] = 0
    text = np.repeat(np.arange(len(strings)), lengths)
    left = ends[text] - np.arange(n)  # symbols up to the terminator, it included
    depth = FIRST
    key, padded = np.zeros(n, np.int64), np.append(symbols, np.zeros(depth, np.int64))
    for j in range(depth):
        key = key * 257 + np.where(left > j, padded[j:j + n], 0)
    block, rows = _first_blocks(key)
    while len(rows):
        rows = np.sort(rows)
        rest = left[rows]  # equal suffixes: the earlier string first
        keys = [np.where(rest <= k * depth, rows, block[np.minimum(rows + k * depth, n - 1)]) for k in range(1, _ways(n))]
        rows = _regroup(rows, block, keys, n)
        depth *= _ways(n)
    suffix = np.empty(n, np.int64)
    suffix[block] = np.arange(n)
    place = suffix - begins[text[suffix]]
    before = np.where(place > 0, symbols[suffix - 1], 0)  # a whole string is preceded by its own terminator
    return Shard(before.astype(np.uint16), text[suffix].astype(np.int32), place.astype(np.int32))


def repeated_intervals(shards: list[Shard], length: int) -> list[np.ndarray]:
    """For each shard, which rows share their first ``length`` symbols with another row of any shard."""
    sizes = [len(s.bwt) for s in shards]
    n = sum(sizes)
    base = np.cumsum([0, *sizes])
    first = np.empty(n, np.int64)
    step = np.empty(n, np.int64)
    for s, at in zip(shards, base):
        rows = np.argsort(s.bwt, kind="stable")
        first[at:at + len(rows)] = s.bwt[rows]
        step[at:at + len(rows)] = rows + at
    ends = first == 0  # within the depth: at its first symbol so far
    ended = np.flatnonzero(ends)
    step[ended] = ended
    depth = min(FIRST, length)
    key, jump = first.copy(), step  # jump: to the suffix as many steps further as the depth
    for _ in range(depth - 1):
        symbol = first[jump]
        key = key * 257 + symbol
        ends |= symbol == 0
        jump = step[jump]
    block, rows = _first_blocks(key)
    rows = rows[~ends[rows]]
    while depth < length and len(rows):
        rows = np.sort(rows)
        reach = min(_ways(n) * depth, length)
        ahead, keys, gone = rows, [], np.zeros(len(rows), bool)
        for at in range(depth, reach, depth):
            if reach - at >= depth:
                ahead = jump[ahead]
            else:  # the last part is shorter: from where it ends the depth
                for _ in range(reach - at):
                    ahead = step[ahead]
            keys.append(block[ahead])
            gone |= ends[ahead]
        rows, keys = rows[~gone], [k[~gone] for k in keys]  # the others share no string of this length
        rows = _regroup(rows, block, keys, n)
        if reach < length:
            twice = jump[jump]
            if reach == 2 * depth:
                ends, jump = ends | ends[jump], twice
            else:
                ends, jump = ends | ends[jump] | ends[twice], jump[twice]
        depth = reach
    shared = np.zeros(n, bool)
    shared[rows] = True
    return [shared[a:b] for a, b in zip(base, base[1:])]


def repeated_places(strings: list[bytes], length: int, shards: int = 4) -> list[np.ndarray]:
    """For each string, the sorted places whose next ``length`` bytes also start elsewhere in any of them."""
    count = max(1, min(shards, len(strings)))
    dealt = [list(range(k, len(strings), count)) for k in range(count)]
    parts = [shard_bwt([strings[i] for i in some]) for some in dealt]
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(strings)
    for some, part, shared in zip(dealt, parts, repeated_intervals(parts, length)):
        text, place = part.text[shared], part.place[shared]
        order = np.lexsort((place, text))
        text, place = text[order], place[order]
        cut = np.searchsorted(text, np.arange(len(some) + 1))
        for k, i in enumerate(some):
            out[i] = place[cut[k]:cut[k + 1]]
    return out

"""Names and order of suffixes by a difference cover, as numpy arrays.

A difference cover modulo ``COVER`` is a set of residues such that any two places of any texts
have, less than ``COVER`` bytes ahead of both, a pair of places that belong to the set. So two
suffixes that agree on ``MATCH`` bytes agree at a sampled place on the ``TUPLE`` bytes that
follow it. A tuple's name is built as in the recursion of difference-cover sorting: names of
triples of bytes, then names of triples of those names, five times over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from guidepost.llm.textops import BYTE_VALUE, mix64, numbers

MATCH = 400  # bytes of a string that must not come twice

# A perfect difference set modulo 133 = 11 * 11 + 11 + 1.
COVER = 133
RESIDUES = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)

ROUNDS = 5
TUPLE = 3**ROUNDS  # 243 bytes; COVER - 1 + TUPLE is at most MATCH
SHIFT = MATCH - TUPLE  # two tuples this far apart cover MATCH bytes

SEED_ROUNDS = 3
SEED = 3**SEED_ROUNDS  # bytes of the pieces by which equal strings meet
SEEDS = MATCH - SEED + 1  # such pieces in MATCH bytes

AT_ONCE = 1 << 22  # bytes whose names are computed at a time
WINDOW_SEEDS = (500, 502)
WEIGHTS = numbers(200, 3 * ROUNDS).reshape(ROUNDS, 3)


def named(buf: np.ndarray, rounds: int) -> np.ndarray:
    """For each place, the name of the ``3**rounds`` bytes from there on."""
    names = BYTE_VALUE[buf]
    for k in range(rounds):
        step = 3**k
        count = max(0, len(names) - 2 * step)
        a, b, c = WEIGHTS[k]
        total = names[:count] * a
        total += names[step : step + count] * b
        total += names[2 * step : 2 * step + count] * c
        names = total
    return names


def sampled(sizes: np.ndarray) -> np.ndarray:
    """The sampled places of texts that lie one after the other; a tuple must fit behind them."""
    longest = int(sizes.max(initial=0))
    periods = np.arange(longest // COVER + 1)[:, None] * COVER
    offsets = (periods + np.array(RESIDUES)).ravel()
    fitting = np.searchsorted(offsets, sizes - TUPLE, "right")
    begins = np.cumsum(sizes) - sizes
    first = np.cumsum(fitting) - fitting
    number = np.arange(fitting.sum()) - np.repeat(first, fitting)
    return offsets[number] + np.repeat(begins, fitting)


def tuple_names(buf: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Names of the tuples at ascending places."""
    found = np.empty(len(places), np.uint64)
    for a in range(0, len(buf), AT_ONCE):
        lo, hi = np.searchsorted(places, [a, a + AT_ONCE])
        if lo < hi:
            names = named(buf[a : a + AT_ONCE + TUPLE], ROUNDS)
            found[lo:hi] = mix64(names[places[lo:hi] - a])
    return found


def windows_near(places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start (into the joined texts) of the runs of MATCH-byte strings that have
    one of ``places`` less than COVER bytes behind their start."""
    begins = np.cumsum(sizes) - sizes
    text = np.searchsorted(begins + sizes, places, "right")
    lo = np.maximum(places - COVER + 1, begins[text])
    hi = np.minimum(places, (begins + sizes)[text] - MATCH)
    keep = lo <= hi
    lo, hi = lo[keep], hi[keep]
    if not len(lo):
        return lo, hi
    # Both ends ascend, and runs of different texts lie at least MATCH - 1 apart.
    new = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    return lo[new], hi[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(hi) - 1]])]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    fill = np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([values, fill]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def pieces(
    buf: np.ndarray, first: np.ndarray, last: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first start, last start, starts, keys) for each run: it is cut where the least seed of the
    MATCH-byte strings changes; equal strings have equal keys, wherever they stand."""
    for a, b in zip(first.tolist(), last.tolist()):
        seeds = mix64(named(buf[a : b + MATCH], SEED_ROUNDS))
        least = sliding_least(seeds, SEEDS)
        cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        yield a, b, cut + a, least[cut]


def window_names(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 bits for the MATCH bytes at each start: two polynomials over all of them, with bases
    and byte values of their own. They come from running sums, shifted by the inverse base."""
    found = []
    for seed in WINDOW_SEEDS:
        base = int(numbers(seed, 1)[0])
        steps = np.full(len(buf), base, np.uint64)
        steps[:1] = 1
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(numbers(seed + 1, 256)[buf] * np.cumprod(steps), out=sums[1:])
        steps[1:] = pow(base, -1, 1 << 64)
        shift = np.cumprod(steps)[starts]
        found.append(mix64((sums[starts + MATCH] - sums[starts]) * shift))
    return np.stack(found, axis=1).reshape(-1, len(WINDOW_SEEDS))


def _same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the MATCH bytes from ``a`` on equal those from ``b`` on."""
    same = np.ones(len(a), bool)
    for k in range(MATCH):
        same &= buf[a + k] == buf[b + k]
    return same


def repeated_windows(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each of the ascending starts, whether its MATCH bytes stand at another one, too.

    Suffixes are sorted by the names of their first two tuples, and neighbours with equal names
    are compared: byte by byte where the pair before them is no pair one byte earlier, else only
    by their last byte. Equal names of unequal bytes are told apart by the bytes themselves.
    """
    found = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return found
    names = named(buf, ROUNDS)
    key = names[starts] * WEIGHTS[0, 0] + mix64(names[starts + SHIFT])
    order = np.argsort(key, kind="stable")
    pair = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    low, high = order[pair], order[pair + 1]
    by_low = np.argsort(low)
    low, high = low[by_low], high[by_low]
    a, b = starts[low], starts[high]
    follows = np.zeros(len(a), bool)
    follows[1:] = (a[1:] == a[:-1] + 1) & (b[1:] == b[:-1] + 1)
    same = buf[a + MATCH - 1] == buf[b + MATCH - 1]
    fresh = np.flatnonzero(~follows)
    same[fresh] = _same_bytes(buf, a[fresh], b[fresh])
    run = np.cumsum(~follows)
    unlike = np.unique(run[~same])
    good = ~np.isin(run, unlike)
    found[low[good]] = True
    found[high[good]] = True
    if len(unlike):  # some names clash: group all windows of those names by their bytes
        clashing = np.flatnonzero(np.isin(key, key[low[~good]]))
        groups: dict[bytes, list[int]] = {}
        for at in clashing.tolist():
            text = buf[starts[at] : starts[at] + MATCH].tobytes()
            groups.setdefault(text, []).append(at)
        for own in groups.values():
            if len(own) > 1:
                found[own] = True
    return found

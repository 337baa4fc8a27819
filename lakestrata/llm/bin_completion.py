"""Bin completion over a histogram of lengths.

Equal lengths are interchangeable, so a packing is a list of (pattern, number
of bins): the work depends on the capacity, not on how many items there are.
The search fills one bin at a time around the largest open length, with the
undominated fillings of the space it leaves. Best-fit decreasing gives the
first incumbent; a branch is left when the waste it has already made, plus a
bound on what must follow, cannot beat the incumbent.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np

Packing = list[tuple[tuple[int, ...], int]]

# Steps in the search of one bin's fillings, and of all bins once branches are
# tried: they limit how long a better packing is looked for, never what is packed.
FILLINGS = 400
STEPS = 400_000


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing, whole groups of equal bins at a time."""
    open_bins: dict[int, list[list]] = {}  # space left: [[pattern, number], ...]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((s for s in open_bins if s >= length), default=None)
            if space is None:
                fit = capacity // length
                full, rest = divmod(left, fit)
                if full:
                    open_bins.setdefault(capacity - fit * length, []).append([(length,) * fit, full])
                if rest:
                    open_bins.setdefault(capacity - rest * length, []).append([(length,) * rest, 1])
                break
            pattern, number = open_bins[space].pop()
            if not open_bins[space]:
                del open_bins[space]
            fit = min(space // length, left)
            used = min(number, left // fit)
            if used < number:
                open_bins.setdefault(space, []).append([pattern, number - used])
            open_bins.setdefault(space - fit * length, []).append([pattern + (length,) * fit, used])
            left -= fit * used
    return [(tuple(pattern), number) for group in open_bins.values() for pattern, number in group]


def bins_of(packing: Packing) -> int:
    return sum(number for _, number in packing)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins any packing needs: for each threshold, lengths that cannot share a
    bin with another long one, plus what the rest exceeds their free space."""
    lengths = sorted(counts)
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for small in [0, *[n for n in lengths if 2 * n <= capacity]]:
        huge = sum(c for n, c in counts.items() if n > capacity - small)
        large = [(n, c) for n, c in counts.items() if capacity - small >= n > capacity / 2]
        middle = sum(n * c for n, c in counts.items() if capacity / 2 >= n >= small)
        n_large = sum(c for _, c in large)
        free = sum((capacity - n) * c for n, c in large)
        best = max(best, huge + n_large + max(0, -(-(middle - free) // capacity)))
    return best


def _dominated(filling: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether ``filling`` fits into the lengths of ``other``, taken as bins."""
    if filling == other or sum(filling) > sum(other):
        return False
    spaces = list(other)

    def place(at: int) -> bool:
        if at == len(filling):
            return True
        tried = set()
        for k, space in enumerate(spaces):
            if filling[at] <= space and space not in tried:
                tried.add(space)
                spaces[k] -= filling[at]
                if place(at + 1):
                    return True
                spaces[k] += filling[at]
        return False

    return place(0)


def fillings(
    counts: dict[int, int], ascending: list[int], space: int, wasted: int, spent: list[int]
) -> list[tuple[int, ...]]:
    """Undominated fillings of ``space`` that waste at most ``wasted``, fullest first.

    Lengths are tried from the longest down; a filling that leaves room for a
    length still at hand is not maximal and is not listed. At most ``FILLINGS``
    steps are made; ``spent[0]`` counts them.
    """
    found: list[tuple[int, ...]] = []
    taken: dict[int, int] = {}
    smallest = ascending[0] if ascending else space + 1
    steps = 0

    def extend(room: int, upto: int, chosen: tuple[int, ...]) -> bool:
        """True when a filling without waste was found."""
        nonlocal steps
        steps += 1
        spent[0] += 1
        top = min(upto, bisect_right(ascending, room))
        open_ = False
        for k in range(top - 1, -1, -1):
            length = ascending[k]
            if counts[length] <= taken.get(length, 0):
                continue
            open_ = True
            taken[length] = taken.get(length, 0) + 1
            done = extend(room - length, k + 1, chosen + (length,))
            taken[length] -= 1
            if done or steps > FILLINGS:
                return done
        if not open_ and room <= wasted:
            maximal = room < smallest or not any(
                counts[n] > taken.get(n, 0) for n in ascending[: bisect_right(ascending, room)]
            )
            if maximal:
                found.append(chosen)
                return room == 0
        return False

    # A single length that fills the space exactly dominates every other filling.
    if counts.get(space, 0):
        return [(space,)]
    # Two that fill it exactly are not dominated by more of them.
    for k in range(bisect_right(ascending, space) - 1, -1, -1):
        a = ascending[k]
        if 2 * a < space:
            break
        if counts[a] and counts.get(space - a, 0) > (a == space - a):
            return [(a, space - a), *_others(extend, found, space, ascending)]
    extend(space, len(ascending), ())
    return _undominated(found)


def _others(extend, found, space, ascending):
    extend(space, len(ascending), ())
    return [f for f in _undominated(found) if sum(f) < space][:2]


def _undominated(found: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    ordered = sorted(set(found), key=lambda f: (-sum(f), len(f), [-n for n in f]))[:12]
    return [f for k, f in enumerate(ordered) if not any(_dominated(f, g) for j, g in enumerate(ordered) if j != k)] or ordered[:1]


def pack(counts: dict[int, int], capacity: int, *, steps: int = STEPS) -> Packing:
    """Pack all lengths; ``counts[n]`` items have the length n, 1 <= n <= capacity.

    The search is the same for all tables. It ends when the incumbent reaches
    the lower bound, when all branches are closed, or after ``steps`` steps.
    """
    counts = {n: c for n, c in counts.items() if c}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    whole = [((capacity,), counts.pop(capacity))] if capacity in counts else []
    incumbent = best_fit(counts, capacity)
    needed = lower_bound(counts, capacity) if counts else 0
    best, best_bins = incumbent, bins_of(incumbent)
    spent = [0]
    total = sum(n * c for n, c in counts.items())
    # Open branches, the deepest last: lengths left, bins so far (a chain),
    # their number, their waste, and the choice to go on with.
    open_: list[tuple] = [(_packed(counts), None, 0, 0, None)] if counts else []
    first = True
    while open_ and best_bins > needed and (first or spent[0] < steps):
        held, done, bins, waste, choice = open_.pop()
        left = {int(n): int(held[n]) for n in held.nonzero()[0]}
        # The first descent is made to its end, whatever it takes.
        while first or spent[0] < steps:
            if choice:
                largest, filling, times, lost = choice
                left = _without(left, largest, filling, times)
                done, bins, waste = (((largest, *filling), times), done), bins + times, waste + times * lost
            if bins >= best_bins:
                break
            if not left:
                best, best_bins = _listed(done), bins
                break
            # Waste that a better packing may still make.
            spare = (best_bins - 1) * capacity - total - waste
            if spare < 0:
                break
            choices = _choices(left, capacity, spare, spent)
            if not choices:
                break
            if spent[0] < steps and len(choices) > 1:
                packed = _packed(left)
                open_ += [(packed, done, bins, waste, other) for other in reversed(choices[1:])]
            choice = choices[0]
        first = False
    return whole + best


def _packed(left: dict[int, int]) -> np.ndarray:
    out = np.zeros(max(left) + 1, dtype=np.int64)
    out[list(left)] = list(left.values())
    return out


def _listed(chain) -> Packing:
    out = []
    while chain:
        last, chain = chain
        out.append(last)
    return out[::-1]


def _choices(left: dict[int, int], capacity: int, spare: int, spent: list[int]) -> list[tuple]:
    """(largest, filling, bins, waste of each) for the next bin: a filling is
    repeated as often as the lengths and the spare waste allow, or used once."""
    largest = max(left)
    rest = dict(left)
    rest[largest] -= 1
    if not rest[largest]:
        del rest[largest]
    out = []
    for filling in fillings(rest, sorted(rest), capacity - largest, spare, spent):
        lost = capacity - largest - sum(filling)
        times = min(left[n] // u for n, u in _uses(largest, filling).items())
        often = min(times, spare // lost) if lost else times
        out.append((largest, filling, often, lost))
        if often > 1:
            out.append((largest, filling, 1, lost))
    return out


def _uses(largest: int, filling: tuple[int, ...]) -> dict[int, int]:
    uses = {largest: 1}
    for n in filling:
        uses[n] = uses.get(n, 0) + 1
    return uses


def _without(left: dict[int, int], largest: int, filling: tuple[int, ...], times: int) -> dict[int, int]:
    have = dict(left)
    for n, u in _uses(largest, filling).items():
        have[n] -= u * times
        if not have[n]:
            del have[n]
    return have

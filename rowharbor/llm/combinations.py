"""Which lengths share a window: counts of combinations by non-negative least squares.

Everything here works on a histogram of lengths. Its size is that of the window,
whatever the number of documents, and so is the size of the plan.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np

#: Lengths are rounded up to this many classes before combinations are enumerated.
CLASSES = 256
#: Different classes in a combination, and how often one may fill a part of a window.
#: Every piece loses some tokens to the rounding, so windows of many pieces are left to
#: the packing of what remains, which does not round.
DEPTH = 3
REPEATS = 2
#: A piece is cut only if both parts have at least this many tokens.
LEAST_CUT = 32


def combinations(classes: int) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """All combinations of at most ``DEPTH`` classes that fill a window, and those that
    fill a half of one, twice. Columns count the classes 1 to ``classes``."""
    found: dict[tuple[tuple[int, int], ...], None] = {}
    for times in range(1, REPEATS + 1):
        part = classes // times if classes % times == 0 else 0
        for a in range(1, part):
            for b in range(1, min(a, part - a) + 1):
                c = part - a - b
                if c <= b:
                    members = [a, b] + [c] * (c > 0)
                    counts = {m: members.count(m) * times for m in members}
                    found[tuple(counts.items())] = None
    listed = [list(members) for members in found]
    matrix = np.zeros((classes, len(listed)))
    for j, members in enumerate(listed):
        for m, n in members:
            matrix[m - 1, j] = n
    return matrix, listed


def nnls(matrix: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |matrix x - wanted|, by active sets: columns join one by
    one where the error falls most, and leave when their count would fall below 0.
    At most as many columns as rows stay above 0."""
    rows, columns = matrix.shape
    x, active = np.zeros(columns), np.zeros(columns, bool)
    scale = np.linalg.norm(matrix, axis=0)
    tolerance = 1e-7 * max(1.0, float(np.abs(wanted).max(initial=0)))
    for _ in range(6 * rows):
        slope = matrix.T @ (wanted - matrix @ x) / scale
        slope[active] = -np.inf
        best = int(np.argmax(slope)) if columns else 0
        if not columns or slope[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            own = matrix[:, on]
            normal = own.T @ own
            normal[np.diag_indices_from(normal)] += 1e-9
            aim = np.linalg.solve(normal, own.T @ wanted)
            if (aim > 0).all():
                x[:] = 0
                x[on] = aim
                break
            low = aim <= 0
            step = np.min(x[on][low] / np.maximum(x[on][low] - aim[low], 1e-300))
            x[on] += step * (aim - x[on])
            out = on[low & (x[on] <= tolerance)]
            if not len(out):
                out = on[[int(np.argmin(np.where(low, x[on], np.inf)))]]
            x[out], active[out] = 0, False
    return x


class Plan:
    """Where the pieces go. Pieces of a length are numbered from 0; an entry deals
    the ``count`` pieces from ``first`` to as many sequences, at one offset. An entry
    with a rest cuts its pieces: the head is placed, the rest is a piece numbered from
    ``rest_first`` among those of its length."""

    def __init__(self, window: int, histogram: dict[int, int]):
        self.window = window
        self.left = {n: int(c) for n, c in histogram.items() if c > 0}
        self.next = dict.fromkeys(self.left, 0)
        #: numbers that rests take up, by length: a rest has the numbers after all others
        self.known = dict(self.left)
        self.sequences = 0
        self.entries: list[tuple[int, int, int, int, int, int, int, int]] = []

    def _take(self, length: int, count: int) -> int:
        first = self.next[length]
        self.next[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]
        return first

    def _place(self, length, first, count, sequence, offset, rest=0, rest_first=0):
        self.entries.append((length, first, count, sequence, offset, length - rest, rest, rest_first))

    def fill(self, members: list[tuple[int, int]], times: int, cut: tuple[int, int] | None = None) -> None:
        """``times`` sequences of ``members`` (length, how often), in this order; ``cut``
        (length, head) closes them with heads and gives the rests back."""
        offset = 0
        for length, often in members:
            for _ in range(often):
                self._place(length, self._take(length, times), times, self.sequences, offset)
                offset += length
        if cut:
            length, head = cut
            rest = length - head
            first = self._take(length, times)
            rest_first = self.known.get(rest, 0)
            self._place(length, first, times, self.sequences, offset, rest, rest_first)
            self.known[rest] = rest_first + times
            self.left[rest] = self.left.get(rest, 0) + times
            self.next.setdefault(rest, rest_first)
        self.sequences += times

    def arrays(self) -> dict[str, np.ndarray]:
        """The entries by length and first number, for a search by both."""
        names = ("length", "first", "count", "sequence", "offset", "head", "rest", "rest_first")
        table = np.array(sorted(self.entries), dtype=np.int64).reshape(-1, len(names))
        return dict(zip(names, table.T, strict=True))


def _combine(plan: Plan) -> None:
    """Fills windows with the combinations that least squares choose."""
    unit = max(1, plan.window // CLASSES)
    classes = plan.window // unit
    by_class: dict[int, list[int]] = {}
    for length in sorted(plan.left):
        if -(-length // unit) <= classes and length < plan.window:
            by_class.setdefault(-(-length // unit), []).append(length)
    counts = np.zeros(classes + 1, dtype=np.int64)
    for k, lengths in by_class.items():
        counts[k] = sum(plan.left[n] for n in lengths)
    matrix, listed = combinations(classes)
    # only what can be had: a combination with an empty class has no use
    usable = [j for j, members in enumerate(listed) if all(counts[m] for m, _ in members)]
    if not usable:
        return
    x = nnls(matrix[:, usable], counts[1:].astype(float))
    for j in np.argsort(-x, kind="stable"):
        times = int(np.rint(x[j]))
        if times < 1:
            break
        members = listed[usable[j]]
        times = min([times, *(int(counts[m]) // often for m, often in members)])
        for m, often in members:
            counts[m] -= times * often
        _deal(plan, [(m, n) for m, often in members for n in range(often)], by_class, times)


def _deal(plan: Plan, slots: list[tuple[int, int]], by_class: dict[int, list[int]], times: int) -> None:
    """Deals lengths of the slots' classes to ``times`` windows. One slot takes the
    longest first and the next the shortest, so that windows fill alike; windows with
    the same lengths are filled together."""
    runs = []
    for i, (k, _) in enumerate(slots):
        lengths, run, need = by_class[k], [], times
        reserved = dict.fromkeys(lengths, 0)
        for other in runs:
            for n, c in other:
                if n in reserved:
                    reserved[n] += c
        for n in lengths if i % 2 else reversed(lengths):
            c = min(need, plan.left.get(n, 0) - reserved[n])
            if c > 0:
                run.append((n, c))
                need -= c
        runs.append(run)
    ends = sorted({int(e) for run in runs for e in np.cumsum([c for _, c in run])})
    bounds = [np.cumsum([c for _, c in run]) for run in runs]
    at = 0
    for end in ends:
        chosen = [run[int(np.searchsorted(b, at, side="right"))][0] for run, b in zip(runs, bounds, strict=True)]
        plan.fill([(n, 1) for n in chosen], end - at)
        at = end


def _greedy(plan: Plan) -> None:
    """Packs what is left: the longest piece first, then always the longest that fits.
    When none fits, the longest piece of all is cut to close the window. Windows alike
    are filled together."""
    window = plan.window
    lengths = sorted(plan.left)
    while lengths:
        members: list[tuple[int, int]] = []
        used: dict[int, int] = {}
        space, cut = window, None
        limit = len(lengths)
        while space and limit:
            limit = bisect_right(lengths, space, 0, limit)
            if not limit:
                break
            n = lengths[limit - 1]
            often = min(space // n, plan.left[n] - used.get(n, 0))
            if often:
                members.append((n, often))
                used[n] = used.get(n, 0) + often
                space -= n * often
            limit -= 1
        if space >= LEAST_CUT:
            for n in reversed(lengths):
                if n < space + LEAST_CUT:
                    break
                if plan.left[n] > used.get(n, 0):
                    cut = (n, space)
                    used[n] = used.get(n, 0) + 1
                    break
        times = min(plan.left[n] // c for n, c in used.items())
        plan.fill(members, times, cut)
        for n in {*used, cut[0] - cut[1] if cut else 0}:
            i = bisect_right(lengths, n)
            there = i > 0 and lengths[i - 1] == n
            if n in plan.left and not there:
                insort(lengths, n)
            elif there and n not in plan.left:
                lengths.pop(i - 1)


def packing_plan(histogram: dict[int, int], window: int) -> Plan:
    """The plan for all pieces of a histogram (length, how many), each of 1 to
    ``window`` tokens."""
    plan = Plan(window, histogram)
    if full := plan.left.get(window):
        plan.fill([(window, 1)], full)
    _combine(plan)
    _greedy(plan)
    return plan

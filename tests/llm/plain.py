"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def classes(rows, threshold=Fraction(4, 5)):
    """(class id, links) of each (id, text)."""
    sets = [shingles(t) for _, t in rows]
    near = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    near[a].add(b)
                    near[b].add(a)
    out = [None] * len(rows)
    for start in range(len(rows)):
        if out[start] is None:
            group, front = {start}, [start]
            while front:
                for x in near[front.pop()] - group:
                    group.add(x)
                    front.append(x)
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            for x in group:
                out[x] = (min(ids, default=None), len(near[x]))
    return out


def line_windows(text, least):
    """(first, last, lines) of the shortest runs of at least ``least`` words from and to each line."""
    lines = [(i, x, x.count(" ") + 1) for i, x in enumerate((text or "").split("\n")) if x.strip(" ")]
    for step in (1, -1):
        for k in range(len(lines)):
            run, total, j = [], 0, k
            while 0 <= j < len(lines) and total < least:
                run.append(lines[j])
                total += lines[j][2]
                j += step
            if total >= least:
                run = run[::step]
                yield run[0][0], run[-1][0], tuple(x for _, x, _ in run)


def line_dedup(rows, least=50):
    """The text left of each (id, text), ids being distinct or their rows equal."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for rank, (_, text) in enumerate(order):
        for a, _, run in sorted(line_windows(text, least), key=lambda w: w[0]):
            first.setdefault(run, (rank, a))
    out = {}
    for rank, row in enumerate(order):
        gone = {i for a, b, run in line_windows(row[1], least) if first[run] < (rank, a) for i in range(a, b + 1)}
        text = row[1]
        if gone:
            text = "\n".join(x for i, x in enumerate(row[1].split("\n")) if i not in gone)
        out[row] = text, len(gone)
    return [out[r] for r in rows]


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b):
            best[j + 1], left = max(best[j + 1], best[j], left + 1 if x == y else 0), best[j + 1]
    return best[-1]


def holds_item(text, item, share=0.6):
    """Whether some stretch of the text of about the item's length has so much of it in order."""
    w, m = words(text), words(item)
    if len(m) < 8:
        return False
    span = 2 * len(m)
    return any(lcs(m, w[a : a + span]) >= share * len(m) for a in range(0, max(len(w) - len(m), 0) + 1, max(len(m) // 2, 1)))

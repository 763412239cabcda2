"""Plain-Python answers to compare the operators with."""

from collections import defaultdict


def window_values(counts, w, n):
    """{(grp, chrom, x): values} from {(grp, chrom, pos): values}."""
    at = defaultdict(lambda: [0] * n)
    for (grp, chrom, pos), values in counts.items():
        for x in range(max(pos - w, 0), pos + w + 1):
            for k in range(n):
                at[grp, chrom, x][k] += values[k]
    return at


def runs(at):
    """Maximal runs of equal non-zero values."""
    found = []
    for (grp, chrom, x), values in sorted(at.items()):
        values = tuple(max(v, 0) for v in values)
        if sum(values) == 0:
            continue
        if found and found[-1][:2] == (grp, chrom) and found[-1][3] == x and found[-1][4:] == values:
            found[-1] = (*found[-1][:3], x + 1, *values)
        else:
            found.append((grp, chrom, x, x + 1, *values))
    return found


def peaks(runs_, gap):
    found, best, last = [], None, None
    for run in sorted(runs_):
        if last is None or run[:2] != last[:2] or run[2] > last[3] + gap:
            if best:
                found.append(best)
            best = run
        elif sum(run[4:]) >= sum(best[4:]):
            best = run
        last = run
    if best:
        found.append(best)
    return sorted((g, c, s + (e - s) // 2, *v) for g, c, s, e, *v in found)


def p_value(null, x):
    x, n = round(x, 6), sum(null.values())
    keys = sorted(null)
    if x <= keys[0]:
        return 1.0
    if x > keys[-1]:
        return round(1 / n, 16)
    above = sum(c for k, c in null.items() if k >= x)
    if x in null:
        return round(above / n, 16)
    low, high = max(k for k in keys if k < x), min(k for k in keys if k > x)
    return round((above + (high - x) / (high - low) * null[low]) / n, 16)


def threshold(null, p):
    n, keys = sum(null.values()), sorted(null)
    if p <= 1 / n:
        return keys[-1]
    suffix = [sum(null[k] for k in keys[i:]) for i in range(len(keys))]
    i = max(j for j in range(len(keys)) if suffix[j] >= p * n)
    if i == len(keys) - 1:
        return keys[-1]
    return keys[i] + (suffix[i] - p * n) / (suffix[i] - suffix[i + 1]) * (keys[i + 1] - keys[i])


def alignment_score(motif, window, match, mismatch, gap, masks):
    table = [[0] * (len(window) + 1)]
    for i, q in enumerate(motif, 1):
        row = [-gap * i]
        for j, r in enumerate(window, 1):
            hit = match if masks(q) & masks(r) else -mismatch
            row.append(max(table[i - 1][j - 1] + hit, table[i - 1][j] - gap, row[j - 1] - gap))
        table.append(row)
    return max(table[-1])


def umi_clusters(counts):
    """Directional clusters of {umi: count} by looking at all pairs."""
    def near(a, b):
        return len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1

    order = sorted(counts, key=lambda u: (-counts[u], u))
    owner = {}
    for root in order:
        if root in owner:
            continue
        owner[root], todo = root, [root]
        while todo:
            at = todo.pop()
            for other in order:
                if other not in owner and near(at, other) and counts[at] >= 2 * counts[other] - 1:
                    owner[other] = root
                    todo.append(other)
    return owner

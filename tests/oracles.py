"""Plain Python answers for small graphs."""

import heapq
import itertools
import math


def components(vertices, edges):
    label = {v: v for v in vertices}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def spanning_forest(edges):
    group = {v: v for e in edges for v in e}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    chosen = {}
    for (a, b), w in sorted(edges.items(), key=lambda e: (e[1], e[0])):
        if find(a) != find(b):
            group[find(a)] = find(b)
            chosen[a, b] = w
    return chosen


def distances(edges, source):
    near = {}
    for (a, b), w in edges.items():
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    best, queue = {}, [(0.0, source)]
    while queue:
        d, v = heapq.heappop(queue)
        if v not in best:
            best[v] = d
            for n, w in near.get(v, []):
                heapq.heappush(queue, (d + w, n))
    return best


def triangles(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    found = {}
    for v, others in near.items():
        n = sum(1 for x, y in itertools.combinations(others, 2) if y in near[x])
        if n:
            found[v] = n
    return found


def ranks(arcs, rounds):
    vertices = {v for a, b, _ in arcs for v in (a, b)}
    out = {v: sum(n for a, _, n in arcs if a == v) for v in vertices}
    rank = {v: 1.0 for v in vertices}
    for _ in range(rounds):
        got = {v: 0.0 for v in vertices}
        for a, b, n in arcs:
            got[b] += rank[a] * n / out[a]
        rank = {v: 0.15 + 0.85 * got[v] for v in vertices}
    scale = len(vertices) / math.fsum(rank.values())
    return {v: r * scale for v, r in rank.items()}

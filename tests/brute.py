"""Plain numpy versions of iterative operators, for small fixtures only."""

import numpy as np


def pairwise(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))


def mutual_reachability(x, min_samples):
    gap = pairwise(x)
    core = np.sort(gap, axis=1)[:, min_samples - 1]
    return np.maximum(gap, np.maximum(core[:, None], core[None, :]))


def brute_mst_edges(reach):
    n = len(reach)
    inside = [0]
    edges = []
    best = reach[0].copy()
    source = np.zeros(n, dtype=int)
    done = np.zeros(n, dtype=bool)
    done[0] = True
    while len(inside) < n:
        candidates = np.where(done, np.inf, best)
        j = int(candidates.argmin())
        edges.append((best[j], int(source[j]), j))
        done[j] = True
        inside.append(j)
        closer = reach[j] < best
        best = np.where(closer, reach[j], best)
        source = np.where(closer, j, source)
    return sorted(edges)


def brute_mst(x, min_samples):
    return sum(e[0] for e in brute_mst_edges(mutual_reachability(x, min_samples)))


def brute_density(x, size):
    """Single linkage, condensed top-down, excess of mass; labels by first row."""
    edges = brute_mst_edges(mutual_reachability(x, size))
    n = len(x)
    node_of = list(range(n))
    children, level, members = {}, {}, {i: [i] for i in range(n)}
    top = {i: i for i in range(n)}

    def find(i):
        while node_of[i] != i:
            i = node_of[i]
        return i

    for w, a, b in edges:
        left, right = top[find(a)], top[find(b)]
        ra, rb = find(a), find(b)
        node_of[rb] = ra
        node = n + len(children)
        children[node], level[node] = (left, right), w
        members[node] = members[left] + members[right]
        top[ra] = node
    root = n + len(children) - 1
    clusters = {}  # cluster -> [birth density, sum of densities, points, child clusters]

    def walk(node, cluster):
        density = 1 / max(level[node], 1e-12) if node in level else np.inf
        if node not in children:
            return
        left, right = children[node]
        big = [len(members[c]) >= size for c in (left, right)]
        if all(big):
            for c in (left, right):
                key = max(clusters) + 1
                clusters[key] = {"birth": density, "fall": {}, "kids": [], "up": cluster}
                clusters[cluster]["kids"].append((key, density, len(members[c])))
                walk(c, key)
            return
        for c, is_big in ((left, big[0]), (right, big[1])):
            if is_big:
                walk(c, cluster)
            else:
                for p in members[c]:
                    clusters[cluster]["fall"][p] = density

    clusters[0] = {"birth": 0.0, "fall": {}, "kids": [], "up": None}
    walk(root, 0)
    mass, chosen = {}, {}
    for key in sorted(clusters, reverse=True):
        c = clusters[key]
        own = sum(d - c["birth"] for d in c["fall"].values())
        own += sum(n_kid * (d - c["birth"]) for _, d, n_kid in c["kids"])
        below = sum(mass[k] for k, _, _ in c["kids"])
        chosen[key] = key != 0 and (not c["kids"] or own >= below)
        mass[key] = own if chosen[key] else below
    labels = np.full(n, -1)
    for key in sorted(clusters):
        up, holder = key, None
        while up is not None:
            if chosen[up]:
                holder = up
            up = clusters[up]["up"]
        if holder is not None:
            for p in clusters[key]["fall"]:
                labels[p] = holder
    order = {}
    for label in labels:
        if label != -1 and label not in order:
            order[label] = len(order)
    return [order.get(label, -1) for label in labels]


def brute_ward(x, ids, k, counts):
    """Greedy Ward merges on the k-nearest-neighbour graph: sets of ids per count."""
    n = len(x)
    gap = pairwise(x)
    near = {i: set() for i in range(n)}
    for i in range(n):
        for j in [j for j in np.lexsort((ids, gap[i])) if j != i][:k]:
            near[i].add(j)
            near[j].add(i)
    centre = {i: x[i].copy() for i in range(n)}
    weight = {i: 1.0 for i in range(n)}
    held = {i: [ids[i]] for i in range(n)}
    result = {}

    def cost(a, b):
        share = 2 * weight[a] * weight[b] / (weight[a] + weight[b])
        return np.sqrt(share) * np.linalg.norm(centre[a] - centre[b])

    while True:
        if len(centre) in counts:
            result[len(centre)] = sorted(sorted(m) for m in held.values())
        pairs = [(cost(a, b), a, b) for a in near for b in near[a] if a < b]
        if not pairs:
            return result
        _, a, b = min(pairs)
        total = weight[a] + weight[b]
        centre[a] = (centre[a] * weight[a] + centre[b] * weight[b]) / total
        weight[a] = total
        held[a] += held[b]
        near[a] = (near[a] | near[b]) - {a, b}
        for other in near[b]:
            if other != a:
                near[other].discard(b)
                near[other].add(a)
        for gone in (centre, weight, held, near):
            del gone[b]

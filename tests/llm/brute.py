"""Plain versions of the operators for small inputs."""

import collections


def jaccard_components(rows, percent=85, words=4):
    """{(id, text): (n, component)} of rows (id, text)."""
    sets = []
    for _, x in rows:
        w = (x or "").encode().lower().split()
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by_id = {}
    for i, (name, _) in enumerate(rows):
        if name is not None and sets[i]:
            up[root(i)] = root(by_id.setdefault(name, i))
    shared = collections.defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        n = collections.Counter(j for g in s for j in shared[g])
        for g in s:
            shared[g].append(i)
        for j, k in n.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                up[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return {r: (len(sets[i]), None if r[0] is None else least[root(i)] if sets[i] else r[0]) for i, r in enumerate(rows)}

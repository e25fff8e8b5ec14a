"""Plain versions of the pipeline's stages."""

import hashlib
from collections import Counter, defaultdict

SPACE = {ord(c): " " for c in " \t\n\x0b\x0c\r"}


def words(text):
    return [w for w in (text or "").translate(SPACE).split(" ") if w]


def exact_groups(texts):
    groups = defaultdict(list)
    for i, text in texts.items():
        groups["".join(words(text))].append((-len(text or ""), i))
    return [min(group)[1] for group in groups.values()]


def near_components(texts, width, percent):
    sets = {}
    for i, text in texts.items():
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [i for i in sets if find(i) == i]


def planned_copies(texts, source):
    """How often the mix takes each document: once at least, 1.5 times the words in all."""
    size = {i: len(words(t)) for i, t in texts.items()}
    names = sorted({source[i] for i in texts}, key=lambda s: (s is None, (s or "").encode()))
    sums = {n: sum(size[i] for i in texts if source[i] == n) for n in names}
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    clamp = lambda level, n: min(max(level * weight[n], sums[n]), 2 * sums[n])
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(clamp(mid, n) for n in names) <= 1.5 * sum(sums.values()) else (low, mid)
    copies = Counter()
    for n in names:
        own = sorted((hashlib.md5(str(i).encode()).hexdigest()[:16], i) for i in texts if source[i] == n)
        target, before = clamp(high, n), 0
        for turn in range(2):
            for _, i in own:
                if sums[n] and before + size[i] / 2 <= target + 1e-6:
                    copies[i] += 1
                before += size[i]
    return copies

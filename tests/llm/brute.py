"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import itertools
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def low(text):
    return (text or "").translate(LOWER)


def shingles(text, n):
    words = SPACED.findall(low(text))
    if len(words) >= n:
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    return {tuple(words)} if words else set()


def near_copies(rows, n):
    """[(id, set size, component)] by comparing the sets of all texts that share a shingle."""
    sets = [(i, shingles(text, n)) for i, text in rows]
    holders = collections.defaultdict(list)
    for k, (_, found) in enumerate(sets):
        for shingle in found:
            holders[shingle].append(k)
    shared = collections.Counter(p for ks in holders.values() for p in itertools.combinations(ks, 2))
    group = list(range(len(sets)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for (a, b), both in shared.items():
        (i, x), (j, y) = sets[a], sets[b]
        if None not in (i, j) and (100 * both >= 80 * (len(x) + len(y) - both)):
            group[top(a)] = top(b)
    for k, (i, _) in enumerate(sets):  # rows with one id are one node
        for m in range(k):
            if i is not None and sets[m][0] == i and sets[m][1] and sets[k][1]:
                group[top(k)] = top(m)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(found), None if i is None else least[top(k)]) for k, (i, found) in enumerate(sets)]


def without_repeats(rows, length=400):
    """[(id, bytes, removed, spans, rest)] by counting every string of ``length`` bytes."""
    data = [(i, (text or "").encode()) for i, text in rows]
    seen = collections.Counter(d[p : p + length] for _, d in data for p in range(len(d) - length + 1))
    out = []
    for i, d in data:
        covered = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                covered[p : p + length] = b"\1" * length
        rest = bytes(b for b, c in zip(d, covered) if not c)
        out.append((i, len(d), len(d) - len(rest), len(re.findall(b"\1+", bytes(covered))), rest))
    return out


def contamination(docs, items, n=10):
    """[(id, words, hit, items, digest, contaminated)] by looking every window up."""
    windows = collections.defaultdict(set)
    for i, text in items:
        words = PLAIN.findall(low(text))
        size = min(n, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[k : k + size])].add(i)
    out = []
    for i, text in docs:
        words = PLAIN.findall(low(text))
        hit, found = bytearray(len(words)), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit[k : k + size] = b"\1" * size
                    found |= windows[tuple(words[k : k + size])]
        names = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((i, len(words), sum(hit), len(names), digest, sum(hit) > 0))
    return out

"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_pairs(texts, threshold=0.8):
    sets, where, common = {i: shingles(t) for i, t in texts.items()}, defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for found in where.values():
        common.update((a, b) for k, a in enumerate(found) for b in found[k + 1:])
    return [(a, b) for (a, b), n in common.items() if n / (len(sets[a]) + len(sets[b]) - n) >= threshold]


def contamination(texts, items, size=10):
    windows = defaultdict(set)
    for item, text in items.items():
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k:k + size])].add(str(item))
    out = {}
    for i, text in texts.items():
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    counts = Counter(k for *_, k in found)
    return (counts["assign"], counts["access"], counts["hex"], sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))))


def without_repeats(texts, size=200):
    data, count = {i: (t or "").encode() for i, t in texts.items()}, Counter()
    for b in data.values():
        count.update(b[s:s + size] for s in range(len(b) - size + 1))
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if count[b[s:s + size]] > 1:
                gone[s:s + size] = b"\x01" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, sha(kept))
    return out

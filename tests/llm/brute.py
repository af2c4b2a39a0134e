"""Plain Python versions of what the operators compute, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

import xxhash


def fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    if not s:
        return 0
    h = [xxhash.xxh64_intdigest(q, 42) for q in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, prints, radius=3):
    top = list(range(len(ids)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    least = collections.defaultdict(list)
    for i, x in enumerate(ids):
        least[find(i)].append(x)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(ids))]


ASSIGN = re.compile(r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)', re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def deduplicated(rows, window):
    """rows: (id, text) in any order. (n_words, n_removed, digest) by place in the input."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        w = (rows[i][1] or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            q = tuple(w[k : k + window])
            if q in seen:
                gone[k : k + window] = [True] * window
            seen.add(q)
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out


class Katz:
    def __init__(self, texts, most=5):
        self.c1, self.c2, self.ch = collections.Counter(), collections.Counter(), collections.Counter()
        for t in texts:
            h = 0
            for w in self.tokens(t):
                self.c1[w] += 1
                self.c2[h, w] += 1
                self.ch[h] += 1
                h = w
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.d1, self.d2 = self.discounts(self.c1, most), self.discounts(self.c2, most)
        self.p1 = {w: self.d1.get(c, 1) * c / (self.n + 1) for w, c in self.c1.items()}
        self.unknown = 1 - sum(self.p1.values())
        self.mass, self.below = collections.Counter(), collections.Counter()
        for (h, w), c in self.c2.items():
            self.mass[h] += self.d2.get(c, 1) * c / (self.ch[h] + 1)
            self.below[h] += self.p1[w]

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    @staticmethod
    def discounts(counts, most):
        n, d = collections.Counter(counts.values()), {}
        cut = (most + 1) * n[most + 1] / n[1] if n[1] else 1
        for r in range(1, most + 1):
            x = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 1
            d[r] = x if 0 < x < 1 else 1.0
        return d

    def p(self, h, w):
        if (h, w) in self.c2:
            c = self.c2[h, w]
            return self.d2.get(c, 1) * c / (self.ch[h] + 1)
        alpha = (1 - self.mass[h]) / (1 - self.below[h]) if self.ch[h] else 1.0
        return alpha * self.p1.get(w, self.unknown)

    def score(self, text):
        h, s, b = 0, 0.0, 0.0
        for w in self.tokens(text):
            s += math.log10(self.p(h, w))
            b += math.log10((self.c1[w] + 0.5) / (self.n + 0.5 * (self.v + 1)))
            h = w
        return s, b


def held(i, k):
    return i is not None and zlib.crc32(str(i).encode()) % k == 1

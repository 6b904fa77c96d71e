"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import math
import re
import zlib

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text):
    return (text or "").encode().translate(LOWER).split()


def removed_strings(texts, length=400):
    """(bytes, removed, spans, sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                mark[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(d)) if mark[k] and not (k and mark[k - 1]))
        left = bytes(b for b, m in zip(d, mark) if not m)
        out.append((len(d), sum(mark), spans, hashlib.sha256(left).hexdigest()))
    return out


def left_lines(rows, run=3, words=50):
    """Lines left of each (id, text) when stretches of ``run`` lines, or with more than ``words`` words, that begin earlier somewhere are cut; equal rows are one document."""
    seen = {}
    docs = sorted(set((-math.inf if i is None else i, t or "") for i, t in rows))
    out = {}
    for i, t in docs:
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for size in range(1, run + 1):
            for p in range(len(at) - size + 1):
                key = tuple(lines[at[p + k]] for k in range(size))
                if size < run and sum(len(x.encode().split()) for x in key) <= words:
                    continue
                if seen.setdefault(key, (i, t, p)) != (i, t, p):
                    gone.update(at[p : p + size])
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return [out[-math.inf if i is None else i, t or ""] for i, t in rows]


def left_passages(texts, length=51):
    """The texts without the passages of ``length`` words that start anywhere else too; each from its first word to its last."""
    cut = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    data = [(t or "").encode() for t in texts]
    words = [[d[a:b] for a, b in c] for d, c in zip(data, cut)]
    count = collections.Counter(tuple(w[k : k + length]) for w in words for k in range(len(w) - length + 1))
    out = []
    for d, c, w in zip(data, cut, words):
        mark = bytearray(len(d))
        for k in range(len(w) - length + 1):
            if count[tuple(w[k : k + length])] > 1:
                a, b = c[k][0], c[k + length - 1][1]
                mark[a:b] = b"\1" * (b - a)
        out.append(bytes(x for x, m in zip(d, mark) if not m).decode())
    return out


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set()


def components(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    label[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return [(len(s), (min(least[find(k)], default=None) if s else rows[k][0])) for k, s in enumerate(sets)]


def base_scores(rows):
    """(held out, tokens, known, total, base) of each (id, text)."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    tokens = [words(t) + [b"\n"] for _, t in rows]
    c = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, distinct = sum(c.values()), len(c)
    return [
        (h, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)) for t, h in zip(tokens, held)
    ]

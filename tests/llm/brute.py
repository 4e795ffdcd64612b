"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(t)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, max_bits=2):
    """rows: [(doc_id, text)] -> [(doc_id, fingerprint hex, component_id)]."""
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                label[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)].append(d)
    return [(d, f"{fps[i]:016x}", min(least[root(i)], default=None)) for i, (d, _) in enumerate(rows)]


def without_repeats(texts, width=35):
    """[(words, kept words)] per text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()

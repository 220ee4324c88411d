"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import struct
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def union(links, nodes):
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard_classes(texts):
    """{doc_id: (set size, component)} with all pairs compared."""
    sets = {i: shingles(t) for i, t in texts}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    parts = union(links, ids)
    return {i: (len(sets[i]), parts[i]) for i in ids}


def without_repeats(texts, width=35):
    """[(doc_id, words, kept words)] of rows."""
    words = [(i, WORD.findall(t or "")) for i, t in texts]
    count = Counter(tuple(w[k:k + width]) for _, w in words for k in range(len(w) - width + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if count[tuple(w[k:k + width])] > 1:
                gone.update(range(k, k + width))
        out.append((i, w, [x for k, x in enumerate(w) if k not in gone]))
    return out


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _hash(*values, seed=42):
    """Spark's xxhash64 of strings (str), longs (int) and ints (tuple of one)."""
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", *v) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed=seed & ((1 << 64) - 1))
    return _signed(seed)


def order_minhash(text):
    """Slot tuples of a text, from the definition: two-word k-mers, two per slot."""
    words = [_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", text)]
    grams = [_hash(a, b) for a, b in zip(words, [*words[1:], None], strict=False)]

    def top(h):
        return (h & ((1 << 64) - 1)) >> 25

    seen, marked = defaultdict(int), []
    for pos, g in enumerate(grams):
        k = top(g)
        marked.append((top(_hash(k, (seen[k],))), pos))
        seen[k] += 1
    slots = defaultdict(list)
    for h, pos in sorted(marked):
        if len(slots[h >> 33]) < 2:
            slots[h >> 33].append((pos, h & ((1 << 33) - 1)))
    out = []
    for slot in sorted(slots):
        seed = 42
        for _, h in sorted(slots[slot]):
            seed = _hash(h, seed=seed)
        out.append((slot << 25) | ((seed & ((1 << 64) - 1)) >> 39))
    return out


def likeness(a, b):
    slots = {x >> 25 for x in a} | {x >> 25 for x in b}
    return len(set(a) & set(b)) / len(slots) if slots else 1.0


def sha(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()

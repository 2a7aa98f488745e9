"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def words(text):
    return WORD.findall(text or "")


def first_id(ids):
    return min((i for i in ids if i is not None), default=None)


def exact(rows):
    """[(doc_id, text)] -> sorted [(doc_id, keep_id, group_size, kept, digest)]."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for text, ids in groups.items():
        keep = first_id(ids)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def without_repeats(rows, window):
    """[(doc_id, text)] -> [(doc_id, n_words, n_removed, kept text)]."""
    own = [words(t) for _, t in rows]
    seen = defaultdict(list)
    for d, w in enumerate(own):
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])].append((d, i))
    gone = [set() for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    return [(rows[d][0], len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d])) for d, w in enumerate(own)]


def near(rows, n, percent=80):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id, kept)]."""
    sets = []
    for _, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    members = defaultdict(list)
    for a in range(len(rows)):
        members[find(a)].append(rows[a][0])
    return [(rows[a][0], len(sets[a]), first_id(members[find(a)]), rows[a][0] == first_id(members[find(a)])) for a in range(len(rows))]


def edit_of_one(a, b):
    """Whether at most one word inserted, left out or replaced turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return len(a) - start - end <= 1 and len(b) - start - end <= 1


def repeated_lines(rows, least=5):
    """[(doc_id, text)] with distinct ids -> {doc_id: (lines, numbers of those that go)}."""
    lines = sorted((LAST if i is None else i, k, tuple(words(line))) for i, t in rows for k, line in enumerate((t or "").split("\n")))
    lines = [x for x in lines if x[2]]
    gone = defaultdict(list)
    for at, (i, k, w) in enumerate(lines):
        if any(w == v or (min(len(w), len(v)) >= least and edit_of_one(w, v)) for _, _, v in lines[:at]):
            gone[None if i == LAST else i].append(k)
    return {i: ((t or "").count("\n") + 1, gone[i]) for i, t in rows}


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(*parts):
    """xxhash64 of strings, longs (int) and ints (1-tuples), as Spark chains it; None is passed over."""
    h = 42
    for x in parts:
        if x is not None:
            data = x.encode() if isinstance(x, str) else struct.pack("<q", x) if isinstance(x, int) else struct.pack("<i", x[0])
            h = xxhash.xxh64(data, seed=h).intdigest()
    return _signed(h)


def components(text, k=2, bits=7, size=2):
    """Order min hash of a text by its definition."""
    w = words(text)
    kmer = lambda p: xx(*(w[p + j] if p + j < len(w) else None for j in range(k)))
    seen, ranked = defaultdict(int), []
    for p in range(max(len(w) - k + 1, 1) if w else 0):
        code = kmer(p) & 0x7FFFFFFF
        ranked.append((xx(code, (seen[code],)) & 0x7FFFFFFF, p))
        seen[code] += 1
    out = [None] * (1 << bits)
    for b in range(1 << bits):
        places = sorted(p for r, p in sorted(x for x in ranked if x[0] >> (31 - bits) == b)[:size])
        if places:
            out[b] = xx(*(kmer(p) for p in places))
    return out


def likeness(a, b):
    same = [x == y for x, y in zip(a, b, strict=True) if x is not None or y is not None]
    return sum(same) / len(same) if same else 1.0

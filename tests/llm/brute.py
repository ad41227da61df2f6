"""Plain restatements of what the operators promise, for small inputs."""

import hashlib
import re

import xxhash

SPACE = re.compile("[\x20\x09-\x0d]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups_of(ids, links):
    """id -> smallest id it reaches."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def substring_report(docs, window=50):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows."""
    owner = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1 if doc_id is not None else 0):
            key = tuple(w[i : i + window])
            owner[key] = min(owner.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1 if doc_id is not None else 0):
            if owner[tuple(w[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), sha(kept)))
    return out


def simhash(text, size=3):
    w = words(ascii_lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs, items, span=13):
    """doc_id -> (n_words, n_hit, items) of (doc_id, text) and (item_id, text) rows."""
    windows = []
    for item_id, text in items:
        w = WORD.findall(ascii_lower(text))
        n = min(span, len(w))
        windows += [(item_id, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        w = WORD.findall(ascii_lower(text))
        hit, found = set(), set()
        for item_id, window in windows:
            n = len(window)
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    found.add(item_id)
        out.append((doc_id, len(w), len(hit), sorted(map(str, found))))
    return out

"""Plain versions of what the operators compute, for small tables."""

import hashlib
import re

import numpy as np


class Sets:
    """Smallest reachable member of each group."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_duplicates(texts, width=2):
    sets = {}
    for doc_id, text in texts.items():
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[doc_id] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} - {()}
    groups = Sets(texts)
    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                groups.join(a, b)
    return {k: (len(sets[k]), groups.find(k), groups.find(k) == k) for k in texts}


def near_vectors(vectors, cosine=0.95):
    good = {}
    for k, v in vectors.items():
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            good[k] = np.array(v, np.float64)
    groups, links = Sets(vectors), dict.fromkeys(vectors, 0)
    for a in good:
        for b in good:
            x, y = good[a], good[b]
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    return {k: (links[k], groups.find(k), groups.find(k) == k) for k in vectors}


def contamination(texts, items, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda x: word.findall((x or "").translate(lower))
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(n, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(str(item))
    out = {}
    for doc_id, text in texts.items():
        own, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if names := windows.get(tuple(own[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(own), len(hit), len(found), digest, bool(hit))
    return out

"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash


def lowered(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def repeats(texts: list[tuple[int | None, str | None]], length: int) -> list[tuple]:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row."""
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = re.findall("[^\x20\x09-\x0d]+", lowered(text or ""))
    if not words:
        return 0
    size = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids: list, fingerprints: list[int], radius: int = 3) -> list:
    """The smallest id that each row reaches."""
    label = list(range(len(ids)))
    bits = np.array(fingerprints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            near = np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= radius)
            low = min(label[j] for j in near)
            for j in near:
                if label[j] != low:
                    label[j], changed = low, True
    members = defaultdict(list)
    for i, group in enumerate(label):
        members[group].append(ids[i])
    return [min((x for x in members[g] if x is not None), default=None) for g in label]


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) per row."""
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lowered(text or ""))
        size = min(window, len(words))
        for p in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[p : p + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, found = WORD.findall(lowered(text or "")), set(), set()
        for size in sizes:
            for p in range(len(words) - size + 1):
                if items_of := windows.get(tuple(words[p : p + size])):
                    hit.update(range(p, p + size))
                    found |= items_of
        named = sorted(str(i) for i in found if i is not None)
        sha = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(named), sha, bool(hit) and 20 * len(hit) >= len(words)))
    return out

"""Plain versions of the operators on small lists of rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def data_of(text: str | None) -> bytes:
    return (text or "").encode()


def suffix_dedup(rows: list[tuple], length: int = 400) -> list[tuple]:
    seen = Counter(d[i : i + length] for _, t in rows for d in [data_of(t)] for i in range(len(d) - length + 1))
    out = []
    for doc_id, text in rows:
        d = data_of(text)
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((doc_id, len(d), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def line_dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, removed) for rows in order of id, without repeated ids."""
    earlier, out = [], []
    for doc_id, text in sorted(rows):
        lines, removed = (text or "").split("\n"), []
        for k, line in enumerate(lines):
            words = set(WORD.findall(line))
            if not words:
                continue
            if any(10 * len(words & o) >= 8 * len(words | o) for o in earlier):
                removed.append(k)
            earlier.append(words)
        out.append((doc_id, len(lines), removed))
    return out


def fingerprint(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows: list[tuple]) -> list[tuple]:
    known = [(d, fingerprint(t)) for d, t in rows]
    root = {d: d for d, _ in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(known):
        for b, y in known[i + 1 :]:
            if (x ^ y).bit_count() <= 4:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return [(d, f"{f:016x}", find(d)) for d, f in known]


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    where = defaultdict(list)
    for i in range(len(words) - 4):
        where[tuple(words[i : i + 5])].append(i)
    hit = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Weights 5, 2, 1 in order share all words; no source goes over 3 times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out

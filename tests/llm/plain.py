"""Plain single-machine versions of the operators, to hold results against."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import regex
import xxhash


def components(nodes, links) -> dict:
    """Smallest node reachable, by union and find."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normal_line(line: str) -> str:
    return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")


def sim_hash(norm: str) -> int:
    words = set(norm.split(" "))
    hashes = {w: xxhash.xxh64_intdigest(w.encode(), 42) for w in words}
    weight = {w: 2 if len(w) > 3 else 1 for w in words}
    total = sum(weight.values())
    return sum(
        1 << i for i in range(64) if 2 * sum(weight[w] for w in words if hashes[w] >> i & 1) > total
    )


def line_dedup(rows: list[tuple[int, str | None]], bits: int = 3) -> dict[int, tuple[int, int, str | None]]:
    """doc_id -> (lines, lines removed, md5 of what is left)."""
    places: dict[str, list[tuple[int, int]]] = {}
    for doc_id, text in rows:
        for k, line in enumerate(text.split("\n") if text is not None else []):
            if norm := normal_line(line):
                places.setdefault(norm, []).append((doc_id, k))
    norms = sorted(places)
    sims = np.array([sim_hash(n) for n in norms], dtype=np.uint64)
    links = []
    for i, norm in enumerate(norms):
        near = np.nonzero(np.bitwise_count(sims[i + 1 :] ^ sims[i]) <= bits)[0] + i + 1
        for j in map(int, near):
            longer = max(len(norm), len(norms[j]))
            if abs(len(norm) - len(norms[j])) * 5 <= longer and edit_distance(norm, norms[j]) * 5 <= longer:
                links.append((i, j))
    gone: set[tuple[int, int]] = set()
    groups: dict[int, list[tuple[int, int]]] = {}
    for i, c in components(range(len(norms)), links).items():
        groups.setdefault(c, []).extend(places[norms[i]])
    for members in groups.values():
        gone |= set(members) - {min(members)}
    out = {}
    for doc_id, text in rows:
        lines = text.split("\n") if text is not None else []
        left = [line for k, line in enumerate(lines) if (doc_id, k) not in gone]
        md5 = None if text is None else hashlib.md5("\n".join(left).encode()).hexdigest()
        out[doc_id] = len(lines), len(lines) - len(left), md5
    return out


def spark_words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def quality_counts(text: str | None) -> dict[str, int]:
    text = text or ""
    words = spark_words(text)
    lines = [line for line in text.split("\n") if spark_words(line)]
    windows: dict[tuple, list[int]] = {}
    for k in range(len(words) - 2):
        windows.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(line in lines[:k] for k, line in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


def plain_words(text: str | None) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def license_base(text: str | None) -> tuple:
    words = plain_words(text)
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    places = [
        (k, label)
        for phrase, label in phrases.items()
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    at = [k for k, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(at, default=None), max(at, default=None), labels


def secret_base(text: str | None) -> tuple[int, int, int, str]:
    text, spans = text or "", []
    assign = r"""(?ia:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, group, least in (
        ("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)
    ):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    kinds = ["assign", "access", "hex"]
    spans.sort(key=lambda s: (s[0], kinds.index(s[1])))
    joined = ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)
    return *[sum(s[1] == k for s in spans) for k in kinds], hashlib.sha256(joined.encode()).hexdigest()


def containment(docs: list[tuple], items: list[tuple], percent: int = 80) -> set[tuple]:
    def grams(words, n):
        return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}

    found = set()
    for item_id, text in items:
        words = plain_words(text)
        n = min(5, len(words))
        own = grams(words, n) if n else set()
        for doc_id, body in docs if own else []:
            shared = len(own & grams(plain_words(body), n))
            if 100 * shared >= percent * len(own):
                found.add((doc_id, item_id, len(own), shared))
    return found

"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size):
    w = words(fold(text))
    if len(w) >= size:
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def components(rows, size, percent):
    """{doc_id: smallest doc_id reachable} of [(doc_id, text)]."""
    sets = [(d, shingles(t, size)) for d, t in rows if d is not None]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, (d, s) in enumerate(sets):
        shared = {}
        for x in s:
            for j in holders[x]:
                if j < k:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            e, other = sets[j]
            if 100 * n >= percent * (len(s) + len(other) - n):
                a, b = find(d), find(e)
                up[max(a, b)] = min(a, b)
    return {d: find(d) for d in up}


def repeats(rows, window):
    """[(doc_id, n_words, removed flags, words)] of [(doc_id, text)] with distinct doc_ids."""
    seen, out = set(), []
    for d, t in sorted(rows):
        w = words(t)
        drop = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                drop[i : i + window] = [True] * window
            seen.add(k)
        out.append((d, w, drop))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut(text, drop):
    """The text without dropped words, each with the white space after it."""
    out, at = [], 0
    spans = [m.span() for m in WORD.finditer(text)]
    edges = [a for a, _ in spans] + [len(text)]
    for k, gone in enumerate(drop):
        if gone:
            out.append(text[at : edges[k]] if edges[k] > at else "")
            at = max(at, edges[k + 1])
    out.append(text[at:])
    return "".join(out)


def terms(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], (last + 1 if x == y else max(row[j], row[j + 1]))
    return row[-1]


def viterbi(text, nodes, longest, unknown):
    """Best score over all segmentations, and the first found, over the whole text."""
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for i in range(len(text)):
        single = False
        for k in range(1, min(longest, len(text) - i) + 1):
            node = nodes.get(text[i : i + k])
            if node is not None:
                single = single or k == 1
                if best[i] + node[0] > best[i + k]:
                    best[i + k], back[i + k] = best[i] + node[0], (i, node[1])
        if not single and best[i] + unknown > best[i + 1]:
            best[i + 1], back[i + 1] = best[i] + unknown, (i, -1)
    return best, back

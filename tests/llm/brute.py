"""Slow, plain versions that the operators are held against."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def near(rows, k, percent):
    """{id: (set size, smallest id reachable)} for (id, text) with distinct ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    ra, rb = root(a), root(b)
                    up[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


KINDS = (
    ("assign", re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 6),
    ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 20),
    ("hex", re.compile(r"([0-9a-f]+)"), 24),
)


def secrets(text):
    """(start, place of the kind, kind, end) of the base spans."""
    found = []
    for i, (kind, pattern, least) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            if len(m.group(1)) >= least:
                found.append((m.start(), i, kind, m.end()))
    return sorted(found)


def repeats(rows, k):
    """{id: (words, removed, kept)} for (id, text) with distinct ids."""
    first, words = {}, {}
    for i, t in sorted(rows):
        words[i] = WORD.findall(t or "")
        for a in range(len(words[i]) - k + 1):
            first.setdefault(tuple(words[i][a : a + k]), (i, a))
    out = {}
    for i, w in words.items():
        gone = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < (i, a):
                gone.update(range(a, a + k))
        out[i] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    return out

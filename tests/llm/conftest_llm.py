"""Brute-force counterparts that several test modules share."""

import itertools
import re

# In the order in which redaction prefers spans that start together: the longest first.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_pii_spans(text):
    """(start, end, kind) of the base kinds, by start, the longest first."""
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], -x[1]))


def word_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_groups(rows, size, num, den):
    """doc_id to the smallest id of its group, for distinct ids."""
    sets = {i: word_set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}

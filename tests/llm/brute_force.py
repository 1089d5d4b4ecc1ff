"""Plain counterparts of the prefix trie, the ranked search and the removal of repeated word runs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_trie(rows):
    """rows of (conv_id, turn, role, text), turns of a conversation distinct or equal rows."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = original.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not children[n]
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(n))
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=20):
    """(item_id, rank, doc_id, score) for rows of (doc_id, text) and (item_id, text)."""
    counted = [(i, Counter(w), len(w)) for i, t in docs for w in [terms(t)] if w]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counted:
            m, score = 75 + (25 * n * n_docs) // n_terms, 0
            for t in terms(text):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


def brute_runs(rows, k):
    """(doc_id, n_words, n_removed, kept_sha256) for rows of (doc_id, text) with distinct ids."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for p in range(len(words) - k + 1):
            window = tuple(words[p : p + k])
            if window in seen:
                gone[p : p + k] = [True] * k
            seen.add(window)
        kept = " ".join(w for w, x in zip(words, gone, strict=True) if not x)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out

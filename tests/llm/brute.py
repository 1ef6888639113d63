"""Plain versions of the operators, and tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UPPER, UPPER.lower())
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
PROSE = "The cat and the dog of the town are in the house and it is not for the bird that was on the roof. "

#: doc_id, text, lang, source; then columns whose names the operators use themselves
EDGE = [
    (0, None, None, None), (1, "", "en", "a"), (2, " \t\n\r\x0b\x0c ", "en", "a"), (3, "Is", "en", "b"),
    (4, "is", "en", "b"), (5, PROSE * 8, "en", "b"), (6, (PROSE * 8).upper(), "en", "b"), (7, LONG, None, "c"),
    (8, PASSAGE, "en", None), (9, "before " + PASSAGE + " after", "en", "c"), (10, PASSAGE + "\n" + PASSAGE, "de", "c"),
    (11, "été à la mer, 中文 \U0001f600 où?", "fr", "c"), (12, "12 34 --- !!! ²", "fr", "c"),
    (13, "### $$$ " * 40, "en", "a"), (14, "a\nline\na\nline\nanother\n", "en", "a"), (15, PROSE * 8, "en", "b"),
    (None, PROSE * 8, "en", "b"), (None, None, None, None), (16, "x" * 5000, "en", "a"), (16, "x" * 5000, "en", "a"),
    (17, "nbsp and\u0085next <|endoftext|> end's it'll.", "en", "a"), (17, "another text of one id", "en", "a"),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, file string, row long, "
          "size string, number string, quality string, component string, fp string, digest string, chunk string, "
          "kept string, word string, _file string, at string, language string, deme string, sequence string")


def edge_rows():
    extra = SCHEMA.count(",") - 4
    return [(i, t, lang, s, len(t) if t is not None else None, *([None if i == 3 else "e"] * 2), 7, *["e"] * (extra - 3))
            for i, t, lang, s in EDGE]


def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    w = words(text)
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), lines, len(hit), failed)


def window_dedup(rows, width):
    """rows: (id, text) with distinct ids; {id: (words, removed, sha256 of what is kept, spans)}"""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), spans(gone))
    return out


def spans(gone):
    edges = np.flatnonzero(np.diff(np.r_[0, np.array(gone, int), 0])).tolist()
    return list(zip(edges[::2], edges[1::2], strict=True))


def byte_dedup(rows, width):
    """rows: (id, text); {id: (bytes, removed, runs, sha256 of what is left)}"""
    count = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, t in raw:
        count.update(t[s : s + width] for s in range(len(t) - width + 1))
    out = defaultdict(list)
    for i, t in raw:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - width + 1):
            if count[t[s : s + width]] > 1:
                gone[s : s + width] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out[i].append((len(t), int(gone.sum()), len(spans(gone)), hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def fingerprint(text, xxh64):
    w = words((text or "").translate(FOLD))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = np.array([xxh64(s.encode(), seed=42) for s in shingles], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=int)
    return sum(1 << i for i in np.flatnonzero(2 * bits > len(shingles)).tolist())


def components(prints, bits):
    """prints: list of fingerprints; the root index of each."""
    up, f = list(range(len(prints))), np.array(prints, np.uint64)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= bits).tolist():
            a, b = find(i), find(i + 1 + j)
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def suffix_tree(rows, learns, tree):
    """rows: (id, text) with distinct ids; {id: (held_out, tokens, known, N, base, score, in context)}"""
    tokens = {i: [*words((t or "").translate(FOLD)), None] for i, t in rows}
    own = {i: t for i, t in tokens.items() if learns(i)}
    c = Counter(w for t in own.values() for w in t)
    n, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d0, d = once / (once + 2 * twice) if once else 0.5, tree.discount
    least = tree.least_count
    often = {w for w, x in c.items() if x >= least and w is not None}

    def root(w):
        if not n:
            return 1.0
        return (c[w] - d0) / n if c[w] else d0 * v / n

    after = defaultdict(Counter)
    for t in own.values():
        for j in range(1, len(t)):
            if t[j - 1] in often:
                after[t[j - 1 : j][0],][t[j]] += 1
                if j > 1 and t[j - 2] in often:
                    after[t[j - 2], t[j - 1]][t[j]] += 1

    def passes(s, suffix):
        total, kinds = sum(after[s].values()), len(after[s])
        ones = sum(x == 1 for x in after[s].values())
        gain = sum(x * (math.log(x - 1 - d) - math.log(suffix(w))) for w, x in after[s].items() if x > 1)
        gain += ones * math.log(d * kinds / total) - (total - ones) * math.log(total)
        return total >= least and gain > tree.divergence * total

    kept = {s for s in after if len(s) == 1 and passes(s, root)}

    def suffix_of(s):
        u = s[1:]
        if u not in kept:
            return root
        return lambda w: max(after[u][w] - d, 0) / c[u[0]] + 0.3 * root(w)

    kept |= {s for s in after if len(s) == 2 and passes(s, suffix_of(s))}
    out = {}
    for i, t in tokens.items():
        score, inside = 0.0, 0
        for j, w in enumerate(t):
            p, hit = root(w), False
            for length in (1, 2):
                s = tuple(t[j - length : j]) if j >= length else ()
                if len(s) == length and s in kept:
                    total = sum(after[s].values())
                    p, hit = max(after[s][w] - d, 0) / total + d * len(after[s]) / total * p, True
            score, inside = score + math.log10(p), inside + hit
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out[i] = (not learns(i), len(t), sum(c[w] > 0 for w in t), n, base, score, inside)
    return out


def deep_suffix_tree(rows, learns, tree):
    """Contexts of up to `tree.depth` words; rows as above; {id: (score, in context)}"""
    tokens = {i: [*words((t or "").translate(FOLD)), None] for i, t in rows}
    after, d = defaultdict(Counter), tree.discount
    for i, t in tokens.items():
        for j, w in enumerate(t if learns(i) else ()):
            for length in range(min(j, tree.depth) + 1):
                after[tuple(t[j - length : j])][w] += 1
    total = {s: sum(x.values()) for s, x in after.items()}
    c, n = after[()], total[()]
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d0, kept = once / (once + 2 * twice), set()

    def p(s, w, weight):
        q = (c[w] - d0) / n if c[w] else d0 * len(c) / n
        for u in (s[k:] for k in range(len(s) - 1, -1, -1)):
            if u in kept:
                q = max(after[u][w] - d, 0) / total[u] + (weight or d * len(after[u]) / total[u]) * q
        return q

    for s in sorted((s for s in after if s and total[s] >= tree.least_count), key=len):
        ones = sum(x == 1 for x in after[s].values())
        gain = sum(x * (math.log(x - 1 - d) - math.log(p(s[1:], w, 0.3))) for w, x in after[s].items() if x > 1)
        gain += ones * math.log(d * len(after[s]) / total[s]) - (total[s] - ones) * math.log(total[s])
        if gain > tree.divergence * total[s]:
            kept.add(s)
    out = {}
    for i, t in tokens.items():
        states = [tuple(t[max(0, j - tree.depth) : j]) for j in range(len(t))]
        out[i] = (sum(math.log10(p(s, w, None)) for s, w in zip(states, t, strict=True)),
                  sum(any(s[k:] in kept for k in range(len(s))) for s in states))
    return out

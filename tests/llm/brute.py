"""Plain single-process versions the operators are tested against."""

from __future__ import annotations

import math
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def ngram_join(rows):
    """{doc_id: (set size, component)}; rows: (doc_id, text)."""
    sets = {d: shingles(t) for d, t in rows}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    pairs = {(a, b) for v in holders.values() for a in v for b in v if a < b}
    links = [(a, b) for a, b in pairs
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {d: (len(s), comp[d]) for d, s in sets.items()}


def text_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def near_vectors(rows, threshold=0.9):
    """[(vec_id, n_links, component)] for rows (vec_id, vector or None)."""
    ok, out = [], []
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok.append(i)
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in ok}
    links = [(i, j) for i in ok for j in ok if i < j and len(unit[i]) == len(unit[j])
             and float(unit[i] @ unit[j]) >= threshold]
    n = [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    comp = components({r[0] for r in rows}, [(rows[i][0], rows[j][0]) for i, j in links])
    for i, (vec_id, _) in enumerate(rows):
        out.append((vec_id, n[i], comp[vec_id]))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    """[(start, kind number, kind, end)] of the base patterns."""
    text, out = text or "", []
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for number, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), number, kind, m.end()))
    return sorted(out)


def char_shingles(line):
    return {line} if len(line) < 5 else {line[i:i + 5] for i in range(len(line) - 4)}


def line_dedup(rows):
    """[(kept text, dropped lines)] for rows (doc_id, text) in row order."""
    sets, first = {}, {}
    for at, (doc, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\x0b\x0c\r")
            if line:
                sets.setdefault(line, char_shingles(line))
                first[line] = min(first.get(line, (doc, at, k)), (doc, at, k))
    holders = {}
    for line, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(line)
    shared = {}
    for v in holders.values():
        for a in v:
            for b in v:
                if a < b:
                    shared[a, b] = shared.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    comp = components(sets, links)
    keeper = {}
    for line, c in comp.items():
        keeper[c] = min(keeper.get(c, first[line]), first[line])
    out = []
    for at, (doc, text) in enumerate(rows):
        if text is None:
            out.append((None, 0))
            continue
        kept, n = [], 0
        for k, line in enumerate(text.split("\n")):
            bare = line.strip(" \t\x0b\x0c\r")
            if bare and keeper[comp[bare]] != (doc, at, k):
                n += 1
            else:
                kept.append(line)
        out.append(("\n".join(kept), n))
    return out

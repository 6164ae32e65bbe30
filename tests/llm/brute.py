"""Plain, quadratic versions of the operators, for small tables."""

import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def distance(p, q):
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a > 0 else 0) + (b * math.log2(b / m) if b > 0 else 0)
    return math.sqrt(max(total / 2, 0))


def quality(rows, limits, min_share, bins, classes):
    """{id: (counts, kept)} of (id, text, lang) rows."""
    def word_bin(w):
        h = xxhash.xxh64(w.encode(), seed=42).intdigest()
        return (h - (1 << 64) if h >= 1 << 63 else h) % bins

    def class_counts(t):
        c = [sum(bool(re.fullmatch(f"[{x}]", ch)) for ch in t) for x in classes] + [sum(ch in " \t\n\x0b\x0c\r" for ch in t)]
        return c + [len(t) - sum(c)]

    words, chars = {}, {}
    for _, t, g in rows:
        if g is not None:
            words.setdefault(g, Counter()).update(word_bin(w) for w in WORD.findall(t or ""))
            chars[g] = [a + b for a, b in zip(chars.get(g, [0] * (len(classes) + 2)), class_counts(t or ""))]
    out = {}
    for i, t, g in rows:
        t = t or ""
        n = base_counts(t)
        failed = n["n_words"] < limits.min_words or 100 * n["n_repeat_words"] > limits.max_repeat_percent * n["n_words"]
        kept = not failed
        if g is not None and (total := sum(words[g].values())):
            common = sorted(b for b, c in words[g].items() if c / total >= min_share)
            ref = [words[g][b] / total for b in common]
            if n["n_words"] >= limits.word_guard:
                own = Counter(word_bin(w) for w in WORD.findall(t))
                p = [own[b] / n["n_words"] for b in common]
                kept &= distance(p + [1 - sum(p)], ref + [1 - sum(ref)]) <= limits.word_distance
            if len(t) >= limits.char_guard:
                size = sum(chars[g])
                kept &= distance([c / len(t) for c in class_counts(t)], [c / size for c in chars[g]]) <= limits.char_distance
        out[i] = (n, failed, kept)
    return out


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows):
    """{id: (set size, smallest id reachable)} of (id, text) rows."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * (n := len(a & b)) >= 75 * (len(a) + len(b) - n):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def linked_items(docs, items, min_score):
    """{(doc, item): score} by aligning every text with every item, without seeds."""
    import numpy as np

    from haulstat.llm.decontamination import MATCH, PASSAGE_SHARE, PASSAGE_SUM, align, words_of

    out = {}
    for i, item in items:
        own = words_of(item)
        if not own:
            continue
        number = {w: k + 1 for k, w in enumerate(dict.fromkeys(own))}
        wanted = np.array([number[w] for w in own])
        for d, text in docs:
            words = words_of(text)
            numbers = np.array([number.get(w, 0) for w in words], dtype=np.int64)
            best, end = align(numbers, wanted)
            _, back = align(numbers[:end][::-1], wanted[::-1])
            if best / (MATCH * len(own)) >= min_score or best >= PASSAGE_SUM and best >= PASSAGE_SHARE * MATCH * back:
                out[d, i] = best / (MATCH * len(own))
    return out

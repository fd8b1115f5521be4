"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction
from math import exp, log

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, n: int = 5) -> set:
    w = SPACED.findall(text or "")
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes(docs: list[tuple], threshold=Fraction(4, 5)) -> dict[int, tuple]:
    """row number -> (members of its class, links)."""
    sets = [shingles(t) for _, t in docs]
    texts = [t or "" for _, t in docs]
    n = len(docs)
    linked = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if texts[i] == texts[j] or common and common >= threshold * len(sets[i] | sets[j]):
                linked[i].add(j)
                linked[j].add(i)
    out = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (seen, len(linked[i]))
    return out


def without_repeats(docs: list[tuple], window: int) -> dict:
    words = {k: SPACED.findall(t or "") for k, t in docs}
    seen = Counter(tuple(w[i : i + window]) for w in words.values() for i in range(len(w) - window + 1))
    out = {}
    for k, w in words.items():
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out[k] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def contaminated(docs: list[tuple], items: list[tuple], window: int = 13) -> dict:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found: dict[tuple, set] = {}
    for i, t in items:
        w = word.findall((t or "").translate(low))
        size = min(len(w), window)
        for j in range(len(w) - size + 1 if w else 0):
            found.setdefault(tuple(w[j : j + size]), set()).add("" if i is None else str(i))
    sizes = {len(x) for x in found}
    out = {}
    for k, t in docs:
        w = word.findall((t or "").translate(low))
        hit, ids = set(), set()
        for size in sizes:
            for j in range(len(w) - size + 1):
                if own := found.get(tuple(w[j : j + size])):
                    hit |= set(range(j, j + size))
                    ids |= own
        out[k] = (len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w))
    return out


def without_lines(
    docs: list[tuple], depth: int = 3, min_docs: int = 3, min_tokens: int = 4, similarity: float = 0.5, exact_docs: int | None = 2,
    short_docs: int = 3
) -> dict:
    """id -> places of the lines that go, from the operator's description: the tree, its leaves, their templates."""
    lines = {(k, i): re.findall(r"[^\x09-\x0D\x20]+", x) for k, t in docs for i, x in enumerate((t or "").split("\n"))}
    masked = {at: ["<*>" if re.search("[0-9]", t) else t for t in w] for at, w in lines.items()}
    leaf = {at: (len(m), *m[:depth]) for at, m in masked.items()}
    holders: dict[tuple, set] = {}
    for (k, i), m in masked.items():
        for j, t in enumerate(m):
            holders.setdefault((leaf[k, i], j, t), set()).add(k)
    found: dict[tuple, set] = {}
    for at, m in masked.items():
        template = [t if j < depth or t != "<*>" and len(holders[leaf[at], j, t]) >= min_docs else "<*>" for j, t in enumerate(m)]
        if len(m) >= min_tokens and sum(t != "<*>" for t in template) >= similarity * len(m):
            found.setdefault(("template", min_docs, *template), set()).add(at)
        if exact_docs is not None and m and (len(m) >= min_tokens or "<*>" not in m):
            found.setdefault(("line", exact_docs if len(m) >= min_tokens else short_docs, *lines[at]), set()).add(at)
    gone: dict = {k: set() for k, _ in docs}
    for (_, needed, *_), places in found.items():
        own = {k for k, _ in places}
        if len(own) >= needed:
            for k, i in places:
                if k != min(own):
                    gone[k].add(i)
    return gone


def languages(train: list[tuple], texts: list[str | None], bucket, alpha: float = 0.1, evidence: int = 100, buckets: int = 1 << 16) -> list[tuple]:
    """(language, score) of each text, by multinomial naive Bayes over hashed trigrams of letters; ``bucket`` gives a trigram's number."""

    def grams(text: str) -> list[int]:
        low = re.sub(" +", " ", "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text))
        return [bucket(low[i : i + 3]) for i in range(len(low) - 2)]

    counts: dict[str, Counter] = {}
    docs: Counter = Counter()
    for text, lang in train:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
            docs[lang] += 1
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        found = grams(text)
        total, cooled = {}, {}
        for lang in sorted(counts):
            mass = sum(counts[lang].values()) + alpha * buckets
            likelihood, prior = sum(log((counts[lang][g] + alpha) / mass) for g in found), log(docs[lang] / docs.total())
            total[lang] = likelihood + prior
            cooled[lang] = likelihood * min(1.0, evidence / max(len(found), 1)) + prior
        best = max(sorted(total), key=total.get)
        out.append((best, 1 / sum(exp(v - cooled[best]) for v in cooled.values())))
    return out

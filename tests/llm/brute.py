"""The operators' results by plain Python over all rows, for comparison."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import sha256

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def alnum(text: str | None) -> list[str]:
    return ALNUM.findall((text or "").translate(LOWER))


def blanks(text: str | None) -> list[bytes]:
    """Words between the six ASCII blanks, A-Z lowered."""
    return (text or "").encode().lower().split()


def license_facts(text):
    words, places, labels = alnum(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def windows(items, size=10):
    out = defaultdict(set)
    for item, text in items:
        w = tuple(alnum(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            out[w[k : k + size]].add(str(item))
    return out


def leaks(text, wanted):
    words, hit, items = tuple(alnum(text)), set(), set()
    for n in {len(w) for w in wanted}:
        for i in range(len(words) - n + 1):
            if found := wanted.get(words[i : i + n]):
                hit.update(range(i, i + n))
                items |= found
    return len(words), len(hit), len(items), digest(",".join(sorted(items))), bool(hit)


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    counts = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = set()
    for i in range(len(words) - 7):
        if counts[tuple(words[i : i + 8])] > 1:
            repeated.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, r = len(words), len(repeated)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def personal(text):
    def digits(v):
        return re.sub("[^0-9]", "", v)

    def luhn(v):
        return sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(v))) % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    ]
    spans, counts = [], []
    for k, (name, pattern, valid) in enumerate(kinds):
        found = [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text or "") if valid(m[0])]
        counts.append(len(found))
        spans += found
    return (*counts, digest(",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))))


def shingles(text, n=5):
    w = blanks(text)
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def groups(texts: dict, percent=80):
    """(n_shingles, component_id) per id, by comparing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    up = {i: i for i in sets}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    holders = defaultdict(list)
    for i, s in sets.items():
        for j in {j for g in s for j in holders[g]}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}

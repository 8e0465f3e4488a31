"""Fingerprints against sets built word by word, followers in order, pairs against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from brute import FOLDER, LOWER, alnum
from pyspark.sql import functions as F

from orderlens.llm import fingerprints as fp
from orderlens.llm.queries import QUERIES
from orderlens.llm.text import PUNCTUATION, row_hash, word_hashes


def spot_list(text, marks):
    """The spots of a text as tuples, by plain Python."""
    words = alnum(text)
    values = [int(word_hashes([w], PUNCTUATION)[0][0]) for w in words]
    anchor = [v in marks for v in values]
    content = [k for k, a in enumerate(anchor) if not a]
    out = []
    for k, v in enumerate(values):
        if anchor[k] or v % fp.EXTRA == 0:
            chain = [words[c] for c in content if c > k][: fp.CHAIN]
            out += [("spot", words[k], *chain)] if chain else []
    if len(words) <= fp.SHORT or not out:
        out += [("every", words[k], *words[k + 1 : k + 1 + fp.CHAIN]) for k in range(len(words))]
    return out


def jaccard(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def parts(text):
    return [text[k : k + 8] for k in range(0, len(text), 8)]


def test_query(spark, texts):
    marks = {int(h) for h in fp.anchor_hashes(fp.ANCHORS)}
    ids = sorted(texts, reverse=True)
    follower = dict(zip(ids, ids[1:] + ids[:1]))
    got = QUERIES["op12_spot_signatures"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        own, then = texts[r.doc_id] or "", texts[follower[r.doc_id]] or ""
        n = len(own) // 3
        changed = own[: len(own) - n] + then[:n]
        assert (r.n_chars, r.edited_sha256) == (len(own), sha256(changed.encode()).hexdigest())
        a, b, c = (spot_list(t, marks) for t in (own, changed, then))
        # "spot" and "every" spots of the same words are one, as their hashes are.
        a, b, c = ([s[1:] for s in x] for x in (a, b, c))
        assert r.near_edited == pytest.approx(jaccard(a, b), abs=0.02)
        assert r.near_next == pytest.approx(jaccard(a, c), abs=0.02)
        assert parts(r.fingerprint) == sorted(set(parts(r.fingerprint))) and len(parts(r.fingerprint)) == len(a)


def test_followers_and_edges(docs_of, spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a null id"), (4, "twice the same"), (4, "twice the same"), (5, "one"), (5, "the other text of five"), (6, "long " * 60_000), (7, "é" * 30)]
    docs = docs_of(rows)
    order = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", row_hash(F.col("text")).alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), order[r]))
    for size in (1 << 20, 1):  # few ranges, and as many as shuffle partitions or rows
        got = fp.compare_with_followers(docs, with_text=True, task_bytes=size).collect()
        want = Counter()
        for (i, t), (_, f) in zip(ordered, ordered[1:] + ordered[:1]):
            want[i, len(t or ""), fp.edited(t or "", f or "")] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited_text) for r in got) == want
        empty = [r for r in got if r.doc_id in (1, 2, 3)]
        assert {r.fingerprint for r in empty} == {""}
    assert fp.compare_with_followers(docs.limit(0)).collect() == []
    [one] = fp.compare_with_followers(docs_of([(1, "alone with itself")])).collect()
    assert one.near_next == 1.0
    prints = {(r.doc_id, r.fingerprint) for r in fp.fingerprint(docs).collect()}
    assert prints == {(r.doc_id, r.fingerprint) for r in got}


def test_all_pairs(docs_of):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)] + fp.ANCHORS[:9] * 12
    base = [rng.choices(words, k=rng.randint(5, 200)) for _ in range(12)]
    rows = []
    for k in range(150):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((k, " ".join(own)))
    prints = fp.fingerprint(docs_of(rows))
    pairs, members = fp.similar_pairs(prints, 70)
    of = {r.doc_id: r["class"] for r in members.collect()}
    sets = {r.doc_id: set(parts(r.fingerprint)) for r in prints.collect()}
    want = {}
    for x in sets:
        for y in sets:
            same = len(sets[x] & sets[y]) / len(sets[x] | sets[y])
            if of[x] < of[y] and same >= 0.7:
                want[of[x], of[y]] = same
    got = [(r.a, r.b, r.similarity) for r in pairs.collect()]
    assert len(got) == len(want) and {(a, b): s for a, b, s in got} == pytest.approx(want)
    assert len(want) > 100
    assert all((of[x] == of[y]) == (sets[x] == sets[y]) for x in sets for y in sets)


def test_pruned_similarity_agrees():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(0, 900, rng.integers(1, 700)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.choice([0.5, 0.9, 1.0])], rng.integers(0, 900, rng.integers(0, 60))]))
        x, y = ("".join(f"{v:08x}" for v in s) for s in (a, b))
        same = len(np.intersect1d(a, b)) / max(1, len(np.union1d(a, b)))
        assert fp.pruned_similarity(x, y, 80, step=16) == (pytest.approx(same) if same >= 0.8 else None)


def test_length_parts(spark):
    """Lengths that can reach the similarity are in one partition or in neighbouring ones."""
    n = 3000
    part = [r[0] for r in spark.range(1, n).select(fp.length_part(F.col("id"), 80)).collect()]
    part = dict(zip(range(1, n), part))
    for a in range(1, n):
        assert 0 <= part[min(n - 1, a * 100 // 80)] - part[a] <= 1


def test_lower_case_and_punctuation():
    assert LOWER[65] == 97 and not re.search("[A-Z]", "".join(alnum("The LAW")))
    marks = fp.anchor_hashes(fp.ANCHORS)
    one, _ = fp.spots(["The law, of THE sea: was kept by him and her"], marks, 3)
    two, _ = fp.spots(["the law of the sea was kept by him and her."], marks, 3)
    assert one.tolist() == two.tolist()

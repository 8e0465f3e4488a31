"""Spelling variants against brute force over all pairs of words, gram dictionary, edge cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import FOLDER
from pyspark.sql import functions as F

from orderlens.llm import spelling
from orderlens.llm.queries import QUERIES
from orderlens.operators.storage import store


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and len(b) - len(a) <= 1 and a[k + (len(a) == len(b)) :] == b[k + 1 :]


def words_of(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if c.isascii() else c for c in text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def variants(n):
    near = {w: [] for w in n}
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    for w in n:
        for size in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [o for o in by_size.get(size, []) if one_edit(w, o)]
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def rows_of(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_query(spark, texts):
    got = rows_of(QUERIES["op13_spelling_variants"](spark, FOLDER))
    want = variants(words_of(texts.items()))
    assert len(got) == len(want) and set(got) == want


def made_up(seed, count):
    """Words of few syllables and endings, with all kinds of edits, at both ends too."""
    rng = random.Random(seed)
    parts = ["ab", "ba", "tion", "éß", "ÿa", "mmm", "o", "zzz"]
    out = Counter()
    while len(out) < count:
        word = "".join(rng.choices(parts, k=rng.randint(2, 6)))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word) + 1)
            word = rng.choice([word[:k] + rng.choice("abézÿ") + word[k:], word[:k] + rng.choice("abézÿ") + word[k + 1 :], word[:k] + word[k + 1 :]])
        out[word + "ation" * (len(word) < 3)] += rng.choice([1, 2, 40, 900])
    return dict(out)


@pytest.mark.parametrize("rare", [0, 3, 32, 10**6])
def test_every_pair_is_found_with_any_dictionary(spark, rare):
    n = {w: c for w, c in made_up(rare, 1500).items()}
    table = store(spark.createDataFrame(list(n.items()), "word string, n long"), "words")
    got = [(r.a, r.na, r.b, r.nb) for r in spelling.near_pairs(table, rare).collect()]
    want = {(a, n[a], b, n[b]) for a in n for b in n if a < b and one_edit(a, b)}
    assert len(got) == len(want) and set(got) == want and len(want) > 300


def test_forms_lead_to_roots(spark):
    n = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaaabba": 2000, "unrelated": 5}
    table = store(spark.createDataFrame(list(n.items()), "word string, n long"), "words")
    got = rows_of(spelling.variants(table))
    assert set(got) == variants(n)
    assert {r[2] for r in got if r[0] == "aaaaaaa"} == {"aaaabbb"}


def test_dictionary_holds_the_frequent_grams(spark):
    n = made_up(9, 800)
    table = store(spark.createDataFrame(list(n.items()), "word string, n long"), "words")
    frequent = spelling.gram_dictionary(table, 20)
    counts = Counter()
    for w in n:
        marked = [92] * (spelling.LONGEST - 1) + [ord(c) - 96 if ord(c) < 128 else ord(c) - 165 for c in w]
        for k in range(len(marked)):
            for size in range(2, spelling.LONGEST):
                if k + size <= len(marked):
                    counts[size, sum(c << 7 * (size - 1 - j) for j, c in enumerate(marked[k : k + size]))] += 1
    for size, known in enumerate(frequent, 2):
        assert known.tolist() == sorted(g for (s, g), c in counts.items() if s == size and c > 20)


def test_grams_are_cut_by_the_dictionary():
    letters = spelling.Letters(["abcdefg"])
    code = lambda s: np.array([sum((ord(c) - 96) << 7 * (len(s) - 1 - k) for k, c in enumerate(s))], dtype=np.uint64)
    gram, length = letters.variable([code("bc"), code("bcd"), np.zeros(0, dtype=np.uint64)])
    assert length[spelling.LONGEST - 1 :].tolist() == [2, 4, 2, 2, 2, 2, 2, 1]
    assert gram[spelling.LONGEST] == code("bcde")[0]


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (None, "Without Without"), (4, "ÀÉÎõüÿß ÀÉÎõüÿß ÀÉÎõüÿx"), (4, "ÀÉÎõüÿß ÀÉÎõüÿß ÀÉÎõüÿx"), (5, "a" * 50_000 + " " + "a" * 50_000 + " " + "a" * 50_001), (6, "a" * 50_001)]
    docs = docs_of(rows).withColumn("n", F.lit(1)).withColumn("word", F.lit("clash"))
    words = store(spelling.counted_words(docs), "words")
    assert {(r.word, r.n) for r in words.collect()} == set(words_of(rows).items())
    assert set(rows_of(spelling.variants(words))) == variants(words_of(rows))
    assert rows_of(spelling.variants(store(spelling.counted_words(docs.limit(0)), "words"))) == []
    plain = spelling.counted_words(docs_of([(7, "kept as written, kept as WRITTEN")]), one_in=None)
    assert [tuple(r) for r in plain.collect()] == [("written", 2)]

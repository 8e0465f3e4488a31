"""Nulls, empty and long texts, ties, repeated rows, empty tables, columns with clashing names."""

from __future__ import annotations

import random

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orderlens.llm import chat, decontam, jaccard, licenses, lm, packing, pii, quality, records, toxicity

LONG = " ".join(f"w{k % 977}x{k % 1009}" for k in range(60_000))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (None, "a null id with the MIT License and more words here"),
    (4, "twice the same row, CC BY and a@b.example.org"),
    (4, "twice the same row, CC BY and a@b.example.org"),
    (5, "one id, first text of two"),
    (5, "one id, second text of the two"),
    (6, LONG),
    (7, "é" * 5000 + " +49 (30) 1234-5678 " + "1" * 5000),
]
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def by_text(rows):
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))


def test_licenses(docs_of):
    got = licenses.scan(docs_of(ROWS)).collect()
    want = [(i, *brute.license_facts(t)) for i, t in ROWS]
    key = lambda r: str(tuple(r))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(want, key=key)
    assert {r.doc_id: r.score for r in got if r.n_base} == {None: 1.0, 4: 1.0}
    assert licenses.scan(docs_of([])).collect() == []


def test_decontamination(spark, docs_of):
    items = spark.createDataFrame(
        [("a", "one id, first text"), ("b", None), ("c", ""), ("d", "one id, first text"), (None, "x"), ("e", LONG[:200])],
        "item_id string, text string",
    )
    wanted = brute.windows((r.item_id, r.text) for r in items.filter("item_id is not null").collect())
    got = decontam.scan(docs_of(ROWS), items).collect()
    want = {(i, *brute.leaks(t, wanted)[:2]) for i, t in ROWS}
    assert {(r.doc_id, r.n_words, r.n_hit) for r in got} == want and len(got) == len(set(ROWS))
    assert [r["items"] for r in got if r.doc_id == 5 and r.contaminated] == [["a", "d"]]
    assert decontam.scan(docs_of([]), items).collect() == []
    assert not any(r.contaminated for r in decontam.scan(docs_of(ROWS), items.limit(0)).collect())


def test_decontamination_in_blocks(spark, docs_of):
    random.seed(1)
    words = [f"v{k}" for k in range(40)]
    items = [(str(k), " ".join(random.choices(words, k=random.randint(1, 14)))) for k in range(40)]
    docs = [(k, " ".join(random.choices(words, k=30) + items[k % 40][1].split() + random.choices(words, k=5))) for k in range(60)]
    table = spark.createDataFrame(items, "item_id string, text string")
    wanted = brute.windows(items)
    for per_pass in (50, 10_000):
        got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), brute.digest(",".join(r["items"])), r.contaminated) for r in decontam.scan(docs_of(docs), table, per_pass=per_pass).collect()}
        assert got == {i: brute.leaks(t, wanted) for i, t in docs}


def test_personal_data(docs_of):
    got = pii.scan(docs_of(ROWS)).collect()
    counts = {(r.doc_id, *(sum(s.kind == k for s in r.base) for k in range(4))) for r in got}
    assert counts == {(i, *brute.personal(t)[:4]) for i, t in ROWS}
    assert len(got) == len(set(ROWS))
    assert pii.scan(docs_of([])).collect() == []
    docs = docs_of(ROWS)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert {r.text for r in clean.filter("doc_id = 4").collect()} == {"twice the same row, CC BY and [EMAIL]"}


def test_long_runs_of_digits_and_letters(docs_of):
    text = "x" * 20_000 + "@ " + "7" * 300_000 + " a@b.c" + ".d" * 100_000
    [row] = pii.scan(docs_of([(1, text)])).collect()
    assert [(s.kind, s.start, s.end) for s in row.base] == [(0, text.index("a@"), len(text))]


def test_toxicity(spark, docs_of):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (99, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(ROWS), labels)
    got = toxicity.score(docs_of(ROWS), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(docs_of([]), model).collect() == []
    # No labels of one class: the same score for all.
    for some in (labels.limit(0), labels.filter("doc_id = 5")):
        assert toxicity.fit(docs_of(ROWS), some).weights == {}
    docs = docs_of(ROWS)
    assert toxicity.accepted(docs, model, 2.0).columns == docs.columns
    assert toxicity.accepted(docs, model, 2.0).count() == len(ROWS)


def test_quality(docs_of):
    docs = docs_of(ROWS).withColumn("source", F.when(F.col("doc_id") > 4, "h"))
    got = quality.judge(docs).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(brute.quality(t) for _, t in ROWS)
    assert all(r.host_rate is not None for r in got)
    assert quality.judge(docs.limit(0)).collect() == []


def test_packing(docs_of):
    got = packing.pack_documents(docs_of(ROWS), WORDS, with_ids=True)
    rows = got.collect()
    assert {r.doc_id for r in rows} == {i for i, _ in ROWS}
    assert sorted(r.length for r in rows if r.doc_tokens == 1) == [1, 1, 1]
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 4)
    whole = packing.sequences(got).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in rows)
    for r in whole:
        n = r.n_tokens
        assert len(r.ids) == 4 * (n if n & (n - 1) == 0 else 2048)
    assert packing.pack_documents(docs_of([]), WORDS).collect() == []


def test_jaccard(docs_of):
    got = jaccard.similar_groups(docs_of(ROWS)).collect()
    assert len(got) == len(ROWS)
    assert {(r.doc_id, r.component_id) for r in got if r.n_shingles == 0} == {(1, 1), (2, 2), (3, 3)}
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (4, 5, 6)} == {(4, 4), (5, 5), (6, 6)}
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id is None} == {(7, None)}
    assert jaccard.similar_groups(docs_of([])).collect() == []
    docs = docs_of([*ROWS, (8, ROWS[4][1]), (9, "one id, second text of the two")])
    left = jaccard.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted({(i or 0, t or "") for i, t in ROWS})


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_of_a_large_group_of_near_copies(docs_of, seed):
    """Copies, near copies around the threshold, a passage that many texts share, short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    text = rng.choices(words, k=120)
    passage = rng.choices(words, k=30)
    rows = []
    for k in range(150):
        own = list(text)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append(" ".join(own))
    rows += [rows[0]] * 20
    rows += [" ".join(rng.choices(words, k=rng.randint(0, 40)) + passage) for _ in range(60)]
    rows += [" ".join(passage[: rng.randint(1, 30)]) for _ in range(30)]
    rng.shuffle(rows)
    texts = dict(enumerate(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(texts.items())).collect()}
    assert got == brute.groups(texts)


def test_lm(docs_of):
    docs = docs_of(ROWS)
    got = lm.score(docs, F.col("doc_id") > 3).collect()
    assert len(got) == len(set(ROWS))
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert not next(r for r in got if r.doc_id is None).train
    assert all(r.score < 0 and r.base_score < 0 for r in got)
    assert lm.score(docs_of([]), F.lit(True)).collect() == []
    nothing = lm.score(docs, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in nothing} == {(0, 0)}


def test_records(spark, docs_of):
    path, index = records.save(docs_of(ROWS), BYTES, "leading", 2)
    rows = index.orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 5, 6, 7]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    _, index = records.save(docs_of([]), BYTES, "leading", 2)
    assert index.collect() == []


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "b"), (1, 1, None, "b"), (1, 2, "a\nb\\", "<|im_end|>\n<\\|x"), (None, 0, "user", "n"), (2, 5, "assistant", ""), (2, None, "assistant", "first")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("x"))
    linked = chat.linked_turns(table)
    got = {r.tree: r for r in chat.format_paths(linked).collect()}
    assert {k: chat.parse(v.conversation) for k, v in got.items()} == {
        1: [("user", ""), ("", "b"), ("", "b"), ("a\nb\\", "<|im_end|>\n<\\|x")],
        None: [("user", "n")],
        2: [("assistant", "first"), ("assistant", "")],
    }
    assert chat.format_paths(chat.linked_turns(table.limit(0))).collect() == []

"""What the methods add to the fixed parts of the queries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import chat, graph, jaccard, licenses, packing, pii, quality, records, toxicity
from orderlens.llm.text import word_hashes
from orderlens.llm.tokens import Encoder, definition
from orderlens.llm.trie import EliasFano


def test_similar_notice_is_found(docs_of):
    notice = licenses.TEMPLATES["bsd"].split()
    rng = random.Random(3)
    other = [f"w{rng.randrange(9999)}" for _ in range(700)]
    changed = [w for k, w in enumerate(notice) if k % 9]  # a ninth is missing
    half = notice[: len(notice) // 2]
    rows = [(1, " ".join(other[:300] + changed + other[300:])), (2, " ".join(half + other)), (3, " ".join(other))]
    got = {r.doc_id: (r.base_labels, r.labels) for r in licenses.scan(docs_of(rows)).collect()}
    assert got == {1: ("", "bsd"), 2: ("", ""), 3: ("", "")}


def test_blocks_against_all_templates(spark, docs_of):
    """The prefix join finds what comparing every block with every template finds."""
    rng = random.Random(5)
    names = list("abcdefghijklmnop")
    templates = {f"t{k}": " ".join(rng.sample(names, 6)) for k in range(8)}
    texts = [(k, " ".join(rng.choices(names, k=rng.randint(1, 20)))) for k in range(80)]
    docs = docs_of(texts, extra=False)
    found = licenses.similar_blocks(spark, docs, templates, 0.8, size=16, stride=8).collect()
    want = set()
    for k, text in texts:
        words = text.split()
        for a in range(0, max(1, len(words)), 8):
            for label, t in templates.items():
                if len(set(t.split()) & set(words[a : a + 16])) >= 5:
                    want.add((k, label))
    assert {(r.doc_id, r.label) for r in found} == want and want


def test_terms_that_disclose(docs_of):
    filler = [f"common{'abcdefghij'[k]}" for k in range(10)]
    rows = []
    for k in range(200):
        rng = random.Random(k)
        rows.append((k, " ".join(rng.choices(filler, k=30))))
    for k in range(200, 206):
        rows.append((k, f"{filler[k % 10]} Zebulon wrote to jo@x.example.org about {filler[(k + 3) % 10]}"))
    rows.append((300, "Zebulon is also mentioned here"))
    got = {r.doc_id: r for r in pii.scan(docs_of(rows)).collect()}
    terms = {got[k].text[s.start : s.end] for k in range(200, 206) for s in got[k].spans if s.kind == 4}
    assert "Zebulon" in terms and not any(t.startswith("common") for t in terms)
    assert all(not got[k].spans for k in [*range(200), 300])
    clean = {r.doc_id: r.text for r in pii.sanitise(docs_of(rows)).collect()}
    assert "Zebulon" not in clean[200] and "[EMAIL]" in clean[200] and "Zebulon" in clean[300]


def test_terms_of_an_entity_in_one_text(docs_of):
    """Every pair is weighed; the rows of one text count once."""
    filler = [f"common{'abcdefghij'[k]}" for k in range(10)]
    rows = [(k, " ".join(random.Random(k).choices(filler, k=30))) for k in range(200)]
    rows.append((300, f"{filler[0]} Quixano wrote to jo@x.example.org about {filler[1]}"))
    rows += [(k, f"{filler[2]} Zebulon wrote to bo@y.example.org about {filler[3]}") for k in range(400, 406)]
    got = {r.doc_id: r for r in pii.scan(docs_of(rows)).collect()}
    assert {s.value for s in got[300].spans if s.kind == 4} >= {"Quixano"}
    for k in range(400, 406):
        assert {s.value for s in got[k].spans if s.kind == 4} >= {"Zebulon"} and not got[k].removed
    assert not any(s.value in filler for r in got.values() for s in r.spans)


def test_terms_from_the_whole_text(docs_of):
    """Far from the value, short, or with digits: terms count wherever they stand in a text."""
    filler = [f"common{'abcdefghij'[k]}" for k in range(10)]
    rows = [(k, " ".join(random.Random(k).choices(filler, k=30))) for k in range(200)]
    far = " ".join(filler * 10)
    rows.append((300, f"Quixano {far} jo@x.example.org ip 10.1.2.3 {far} Lu, u99x, 𝐀bc bc QUIXANO Bosun"))
    # The term is far from the value in one holder, and near it in the others.
    rows += [(k, f"Zebulon {far if k == 400 else filler[k % 10]} bo@y.example.org {k % 5}") for k in range(400, 404)]
    got = {r.doc_id: r for r in pii.scan(docs_of(rows)).collect()}
    text = got[300].text
    found = [text[s.start : s.end] for s in got[300].spans if s.kind == 4]
    assert found == ["Quixano", "ip", "Lu", "u99x", "𝐀bc", "bc", "QUIXANO", "Bosun"]
    assert all("Zebulon" in {s.value for s in got[k].spans if s.kind == 4} for k in range(400, 404))
    assert not any(s.value in filler for r in got.values() for s in r.spans)


def test_swap_penalty_narrows_the_gap(docs_of, spark):
    """Toxic texts name one group more often; the penalty keeps its name from counting."""
    rng = random.Random(7)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 2
        words = [f"w{rng.randrange(30)}" for _ in range(8)] + (["idiot"] if toxic and rng.random() < 0.8 else [])
        words.append("women" if rng.random() < (0.8 if toxic else 0.2) else "men")
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    docs, marks = docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    gaps = []
    for penalty in (0.0, 20.0):
        model = toxicity.fit(docs, marks, swap_penalty=penalty)
        score = lambda t, m=model: m.score(toxicity.features(t))
        gaps.append(abs(score("the women came") - score("the men came")))
        assert score("you idiot") > 0.7
    assert gaps[1] < 0.25 * gaps[0]


def test_reply_trees(spark):
    #        1
    #     2     3      mean scores: 1-2-4: 3, 1-2-5: 8/3, 1-3: 3.5
    #    4 5           7 -> 8 -> 7 is a circle, 9 has an unknown parent
    rows = [(10, 1, None, 2.0), (10, 2, 1, 3.0), (10, 3, 1, 5.0), (10, 4, 2, 4.0), (10, 5, 2, 3.0), (11, 7, 8, 1.0), (11, 8, 7, 1.0), (12, 9, 99, 1.0)]
    table = spark.createDataFrame(
        [(t, n, p, "assistant" if n > 1 else "user", f"m{n}", s) for t, n, p, s in rows],
        "tree long, node long, parent long, role string, text string, score double",
    )
    got = {(r.tree, r.rank): [t for _, t in chat.parse(r.conversation)] for r in chat.format_paths(table, branches=2).collect()}
    assert got == {(10, 1): ["m1", "m3"], (10, 2): ["m1", "m2", "m4"], (12, 1): ["m9"]}
    [row] = chat.format_paths(table.filter("tree = 10")).collect()
    assert [row.conversation[s.start : s.end] for s in row.loss] == ["m3"]


def test_a_long_chain(spark):
    n = 700
    rows = [(1, k, k - 1 if k else None, "user", str(k), 0.0) for k in range(n)]
    table = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    [row] = chat.format_paths(table).collect()
    assert [t for _, t in chat.parse(row.conversation)] == list(map(str, range(n)))


@given(st.lists(st.tuples(st.text("<|\\im_startend>\nab"), st.text("<|\\im_startend>\nab"))))
def test_conversations_read_back(turns):
    text, _ = chat.render(turns)
    assert chat.parse(text) == turns


@given(st.sets(st.integers(0, 10**6), max_size=300), st.integers(10**6 + 1, 10**12))
def test_elias_fano(numbers, universe):
    x = np.array(sorted(numbers), dtype=np.int64)
    level = EliasFano.build(x, universe)
    asked = np.concatenate([x, np.arange(0, 10**6, 9973)])
    place = {int(v): k for k, v in enumerate(x)}
    assert level.find(asked).tolist() == [place.get(int(v), -1) for v in asked]


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30)))
def test_patterns_use_each_piece_once(histogram):
    found = packing.patterns(histogram, 64)
    used = {}
    for lengths, n in found:
        assert sum(lengths) <= 64 and n > 0
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == histogram
    spans = packing.slots(found)
    for length, n in histogram.items():
        ranks = sorted((low, high) for x, low, high, _, _ in spans if x == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranks, ranks[1:]))


@pytest.mark.parametrize(("name", "blanks"), [("byte_bpe_50k.json", "leading"), ("word_bpe_49k.json", "dropped")])
def test_words_give_the_ids_of_whole_texts(name, blanks):
    encoder = Encoder(definition(public_tokenizers.path(name)), blanks)
    whole = Tokenizer.from_file(public_tokenizers.path(name))

    @given(st.lists(st.text(alphabet="ab Éé'sΣİ́.,1\n\t 中<|>_") | st.text()))
    def check(texts):
        got = encoder.encode(texts)
        assert got == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    check()


def test_frames_and_their_checks():
    stretches = [[b"", b"abc\n"], [], [bytes(300)]]
    data = b"".join(records.stretch([records.frame(p) for p in s], s == stretches[-1]) + b"\n" for s in stretches)
    assert [p for _, p in records.frames(data)] == [b"", b"abc\n", bytes(300)]
    assert all(data[at + 12 : at + 12 + len(p)] == p for at, p in records.frames(data))
    for k in range(len(data)):
        wrong = data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :]
        with pytest.raises(ValueError):
            list(records.frames(wrong))
    for k in range(len(data)):
        with pytest.raises(ValueError):
            list(records.frames(data[:k]))
    ids = np.array([1, 70_000], "<u4")
    assert records.unpack_record(records.pack_record(-5, ids.tobytes(), 4))[0] == -5
    assert zlib.crc32(records.unpack_record(records.pack_record(None, ids.tobytes(), 4))[1].tobytes()) == zlib.crc32(ids.tobytes())


def test_records_files_are_bounded_by_their_stretches(spark, tmp_path, monkeypatch):
    """One task writes several files; each frame is found again by its file, offset and length."""
    monkeypatch.setattr(records, "STRETCHES", 2)
    monkeypatch.setattr(records, "small_batches", lambda spark: None)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        docs = spark.createDataFrame([(k, f"text {k} " * (k % 4)) for k in range(25)], "doc_id long, text string")
        path = str(tmp_path / "records")
        records.write(docs.coalesce(1), path, public_tokenizers.path("byte_bpe_50k.json"), "leading", 2, parts=1)
    finally:
        spark.conf.set(name, old)
    files = {records.file_number(str(f)): f.read_bytes() for f in (tmp_path / "records").glob("part-*")}
    assert len(files) == 5 and sorted(files) == list(range(5))
    index = records.index(records.read(spark, path)).orderBy("start").collect()
    assert [r.doc_id for r in index] == list(range(25))
    at = 0
    for r in index:
        (framed,) = [files[r.file][r.offset : r.offset + r.length]]
        doc_id, ids = records.unpack_record(framed[12:-4])
        assert (doc_id, len(ids), r.start, zlib.crc32(ids.tobytes())) == (r.doc_id, r.n_tokens, at, r.ids_crc32)
        at += len(ids)


def test_host_rates_are_shrunk(spark):
    """A small host with few failures more is drawn to the others; a large bad host is rejected."""
    good = " ".join(f"w{k}" for k in range(40))
    rows = [(k, good if k % 10 else "short", f"h{k % 8}") for k in range(800)]
    rows += [(1000 + k, "short" if k % 10 else good, "bad") for k in range(400)]
    rows += [(2000, "short", "tiny"), (2001, good, "tiny")]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[k] for k in range(1000, 1400)) and kept[1] and kept[2001]


@given(st.lists(st.text(alphabet="aB éÉ\n\t ") | st.none(), max_size=8))
def test_word_hashes(texts):
    hashes, counts = word_hashes(texts)
    words = [w for t in texts for w in (t or "").encode().lower().split()]
    assert counts.tolist() == [len((t or "").encode().split()) for t in texts]
    by = dict(zip(words, hashes.tolist()))
    assert [by[w] for w in words] == hashes.tolist() and len(set(by.values())) == len(by)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(k, k + 1) for k in range(400, 480)]
    up = {}

    def top(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {n: top(n) for a, b in edges for n in (a, b) if a != b}
    assert len(got) == len({r.node for r in got})
    assert graph.components(spark.createDataFrame([], "a long, b long").filter(F.lit(True))).collect() == []


def test_message_bytes_do_not_grow_with_the_fragments():
    """An n-gram costs at most 8 bytes, its place, and its owner's name and class once per message."""
    rng = np.random.default_rng(3)
    ids, owners = rng.integers(0, 1 << 62, 4000), np.sort(rng.integers(0, 4001, 100_000))
    rng.shuffle(owners)
    for parts in (1, 10, 1000, 20_000):
        size = 0
        for piece in np.array_split(owners, parts):
            names, classes, places = jaccard.addressed(piece, ids)
            size += len(names) + len(classes) + len(places) + 8 * len(piece)
            where = jaccard.placed_owners(places, len(piece), len(names) // 4)
            back = np.append(np.frombuffer(names, np.uint32).astype(np.int64), 4000)[where]
            assert (back == piece).all()
            assert (np.frombuffer(classes, np.int64) == ids[np.frombuffer(names, np.uint32)]).all()
        assert size <= 22 * len(owners)
    names, classes, places = jaccard.addressed(np.arange(70_001), np.arange(70_000))
    assert jaccard.placed_owners(places, 70_001, 70_000).tolist() == [*range(70_000), -1]


def test_all_links_between_different_sets(docs_of):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(60)}" for _ in range(120)] for _ in range(6)]
    texts = {}
    for k in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        texts[k] = " ".join(words)
    texts |= {60: None, 61: "", 62: "one two", 63: "one two", 64: texts[0]}
    pairs, members = jaccard.similar_pairs(docs_of(texts.items()))
    of = {r.doc_id: r["class"] for r in members.collect()}
    sets = {i: frozenset(zip(*(t.split()[j:] for j in range(5)))) if t and len(t.split()) >= 5 else t for i, t in texts.items()}
    got = {(r.a, r.b): (r.na, r.nb, r.common) for r in pairs.collect()}
    want = {}
    for i, x in sets.items():
        for j, y in sets.items():
            if isinstance(x, frozenset) and isinstance(y, frozenset) and of[i] < of[j] and 100 * len(x & y) >= 80 * len(x | y):
                want[of[i], of[j]] = (len(x), len(y), len(x & y))
    assert got == want and len(want) > 20
    assert of[60] is None and of[61] is None and of[62] == of[63] and of[64] == of[0]

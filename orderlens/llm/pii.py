"""Personal data: fixed patterns, and terms that give a protected value away.

A value found by a pattern (an address, a number) is a protected entity. All terms of the texts that hold it are
weighed over the whole corpus: PMI(t, e) = log2(P(e | t) / P(e)) is how many of the IC(e) = log2(N / n(e)) bits
that single the entity out are revealed by t. P(e) is n(e) / N, and P(e | t) is smoothed towards it, as
(n(t, e) + prior * P(e)) / (n(t) + prior), so that a term seen once reveals less than one seen often, but no
count is too low to be weighed. n counts different texts. Terms that reveal a share of at least ``disclosure``
are generalised in the documents that hold the entity, terms that reveal ``removal`` are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import BROADCAST_ROWS, free_name, let, row_hash
from orderlens.operators.storage import store

_LOCAL = r"[A-Za-z0-9._%+-]"
#: The patterns, in the order of kinds. Quantifiers are possessive where giving back could not
#: help, so that long runs need neither stack nor time; an address starts where a run starts or a match ended.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
KINDS = [*PATTERNS, "term"]
#: Characters of a term: letters with their marks, and digits.
_INNER = r"[\p{L}\p{M}\p{N}]"
TERM = rf"{_INNER}+"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _starts(parts: Column, found: Column) -> Column:
    """Code points before each match, from what stands between the matches."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def add(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.char_length(F.get(parts, i))
        return F.struct(
            (start + F.char_length(F.get(found, i))).alias("at"),
            F.concat(acc["starts"], F.array(start)).alias("starts"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), empty, add, lambda acc: acc["starts"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weight(i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.char_length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda a, i: a + weight(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.char_length(_digits(value))
        return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(value)).between(9, 15)
    return F.lit(True)


def pattern_spans(text: Column, kind: str) -> Column:
    """Valid matches of one kind: start and end (code points, end exclusive), kind's place and value."""
    matched = F.filter(_matches(text, F.lit(PATTERNS[kind]), kind), lambda s: _valid(kind, s["value"]))
    return F.when(text.rlike(GUARDS[kind]), matched).otherwise(F.array().cast(SPAN))


def _matches(text: Column, pattern: Column, kind: str) -> Column:
    """Spans of all matches of a pattern, as of one kind."""

    def spans(both: Column) -> Column:
        parts, found = both["parts"], both["found"]

        def all_(starts: Column) -> Column:
            return F.transform(
                found,
                lambda v, i: F.struct(
                    F.get(starts, i).alias("start"),
                    F.lit(KINDS.index(kind)).alias("kind"),
                    (F.get(starts, i) + F.char_length(v)).alias("end"),
                    v.alias("value"),
                ),
            )

        return let(_starts(parts, found), all_)

    both = F.struct(
        F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found")
    )
    tried = F.filter(F.array(both), lambda x: F.size(x["found"]) > 0)
    return F.coalesce(F.get(F.transform(tried, spans), F.lit(0)), F.array().cast(SPAN))


def _all_patterns(text: Column) -> Column:
    return F.array_sort(F.concat(*(pattern_spans(text, k) for k in PATTERNS)))


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``base`` (sorted spans) of all rows, and ``text`` of those that have any."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", row_hash(F.col("text")).alias("text_hash"), text.alias("text")).withColumn(
        "base", _all_patterns(F.col("text"))
    )
    return found.withColumn("text", F.when(F.size("base") > 0, F.col("text")))


def _terms(text: Column) -> Column:
    """Different terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] >= KINDS.index("card"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"].cast("string"), value)


def _copies(docs: DataFrame) -> DataFrame:
    """``hash`` of each different text and its number of rows."""
    return store(docs.groupBy(row_hash(F.col("text")).alias("hash")).agg(F.count("*").alias("copies")), "copies")


def _term_counts(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``term`` and ``n_t``, the number of different texts that hold it."""
    repeated = copies.filter("copies > 1")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    # Each of a text's rows is its share of one.
    part = F.coalesce(1 / F.col("copies"), F.lit(1.0))
    rows = docs.withColumn("hash", row_hash(F.col("text"))).join(repeated, "hash", "left")
    return (
        rows.select(part.alias("part"), F.explode(_terms(F.coalesce("text", F.lit("")))).alias("term"))
        .groupBy("term")
        .agg(F.round(F.sum("part")).cast("long").alias("n_t"))
    )


def _share(n_te: Column, n_t: Column, n_e: Column, texts: int, prior: float) -> Column:
    """Share of the bits of an entity that a term reveals; ``prior`` texts more hold the term, and the entity by chance."""
    chance = n_e / texts
    revealed = F.log2((n_te + prior * chance) / (n_t + prior) / chance)
    information = -F.log2(chance)
    return F.when(information > 0, revealed / information)


def _most(n_e: Column, texts: int, prior: float, disclosure: float) -> Column:
    """A term that more texts hold has a share below ``disclosure`` even if all holders of the entity have it."""
    return F.pow(n_e, F.lit(disclosure)) * texts ** (1 - disclosure) * (1 + prior / texts) - prior + 1e-6


def _holders(found: DataFrame) -> DataFrame:
    """``text_hash``, ``class`` and ``n_e``: which texts hold the entities of a class, and in how many texts these are.

    Entities of the same texts occur with the same terms, so they are one class and weighed once.
    """
    spans = found.select("text_hash", F.explode("base").alias("span"))
    held = store(spans.select("text_hash", _entity(F.col("span")).alias("entity")).distinct(), "held")
    classes = held.groupBy("entity").agg(
        F.count("*").alias("n_e"), F.bit_xor(F.xxhash64("text_hash")).alias("class")
    )
    # Both sides are stored, so that an entity of many texts is an exchange of its own and can be split.
    return store(held.join(store(classes, "classes"), "entity").select("text_hash", "class", "n_e").distinct(), "holders")


def disclosing_terms(docs: DataFrame, found: DataFrame, prior: float, disclosure: float) -> DataFrame:
    """Rows (``text_hash``, ``term``, ``share``): terms of a text that reveal an entity it holds.

    ``found``: stored rows of ``base_spans`` with spans. Every pair of an entity and a term is weighed, but for
    terms in too many texts to reach ``disclosure``.
    """
    copies = _copies(docs)
    texts = max(1, copies.count())
    holders = _holders(found)
    widest = holders.agg(F.max("n_e")).first()[0] or 0
    most = lambda n_e: _most(n_e, texts, prior, disclosure)
    share = lambda n_te: _share(n_te, F.col("n_t"), F.col("n_e"), texts, prior)
    of_term = _term_counts(docs, copies).filter(F.col("n_t") <= most(F.lit(widest)))
    # The rows of a term are as many as the texts that hold it: no key is hot.
    of_text = found.dropDuplicates(["text_hash"]).select("text_hash", F.explode(_terms(F.col("text"))).alias("term"))
    pairs = of_text.join(of_term, "term").join(holders, "text_hash").filter(F.col("n_t") <= most(F.col("n_e")))
    pairs = store(pairs, "pairs")
    several = pairs.filter("n_e > 1")
    weighed = (
        several.groupBy("class", "n_e", "term", "n_t")
        .agg(F.count("*").alias("n_te"))
        .withColumn("share", share(F.col("n_te")))
        .filter(F.col("share") >= disclosure)
        .drop("n_te", "n_t")
    )
    weighed = several.join(store(weighed, "disclosing"), ["class", "n_e", "term"]).select("text_hash", "term", "share")
    once = pairs.filter("n_e = 1").withColumn("share", share(F.lit(1))).filter(F.col("share") >= disclosure)
    return weighed.unionByName(once.select("text_hash", "term", "share"))


def scan(
    docs: DataFrame,
    prior: float = 1.0,
    disclosure: float = 0.8,
    removal: float = 0.95,
) -> DataFrame:
    """One row per different (``doc_id``, ``text``) with its spans.

    ``base``: spans of the patterns; ``spans``: these and the disclosing terms, as (start, kind, end, value),
    sorted by start and kind; ``text``: of rows with spans only; ``removed``: the terms to be removed.

    Null and empty texts have no spans. Rows of one text count once as holders of an entity; repeated rows are
    one row. Null ids are ids; rows of one id with different texts are separate. A term that overlaps a
    pattern's span is no span of its own. An empty table gives no rows; extra columns are not read.
    """
    docs = docs.select("doc_id", "text")
    base = store(base_spans(docs).dropDuplicates(["doc_id", "text_hash"]), "base")
    found = base.filter("text is not null")
    of_text = (
        disclosing_terms(docs, found, prior, disclosure)
        .groupBy("text_hash")
        .agg(
            F.collect_set("term").alias("terms"),
            F.collect_set(F.when(F.col("share") >= removal, F.col("term"))).alias("removed"),
        )
    )
    more = F.when(F.col("terms").isNotNull(), _term_spans(F.col("text"), F.col("terms"), F.col("base")))
    none = F.array().cast("array<string>")
    # Stored, so that a text of many rows is an exchange of its own and can be split.
    held = found.join(store(of_text, "of_text"), "text_hash", "left").select(
        "doc_id",
        "text_hash",
        "text",
        "base",
        F.array_sort(F.concat("base", F.coalesce(more, F.array().cast(SPAN)))).alias("spans"),
        F.coalesce("removed", none).alias("removed"),
    )
    plain = base.filter("text is null").select("*", F.col("base").alias("spans"), none.alias("removed"))
    return held.unionByName(plain)


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Places of the given terms in a text, but for those within a span of ``base``."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    # Words as they are written, matched whole; they need no quoting.
    chosen = F.array_join(F.filter(words, lambda w: F.array_contains(terms, F.lower(w))), "|")
    pattern = F.concat(F.lit(f"(?<!{_INNER})(?:"), chosen, F.lit(f")(?!{_INNER})"))
    clear = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return F.filter(let(pattern, lambda p: _matches(text, p, "term")), clear)


def sanitised(text: Column, spans: Column, removed: Column) -> Column:
    """The text with values and terms replaced by their kind in brackets, and removed terms left out."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gone = (s["kind"] == KINDS.index("term")) & F.array_contains(removed, F.lower(s["value"]))
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(gone, F.lit("")).otherwise(F.get(names, s["kind"]))
        # Of spans that overlap only the first leaves a mark; all that any of them covers goes.
        new = F.concat(acc["out"], between, F.when(s["start"] >= acc["at"], mark).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), new.alias("out"))

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))

    return F.aggregate(spans, start, add, rest)


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def sanitise(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with ``text`` (and ``n_chars``, if there) of rows with spans sanitised; other rows are unchanged.

    Texts without spans take part in no join.
    """
    base, own, other, key, text = (free_name(docs, n) for n in ("base", "own", "found_id", "found_hash", "clean"))
    flagged = docs.withColumn(base, _all_patterns(F.coalesce("text", F.lit(""))))
    plain = flagged.filter(F.size(base) == 0).drop(base)
    found = scan(docs, **settings).filter(F.size("spans") > 0)
    clean = found.select(
        F.col("doc_id").alias(other),
        F.col("text_hash").alias(key),
        sanitised(F.col("text"), F.col("spans"), F.col("removed")).alias(text),
    )
    held = flagged.filter(F.size(base) > 0).withColumn(own, row_hash(F.col("text")))
    joined = held.join(clean, F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(own) == F.col(key)))
    new = {"text": F.col(text)} | ({"n_chars": F.char_length(text)} if "n_chars" in docs.columns else {})
    kinds = dict(docs.dtypes)
    changed = joined.select(
        *(new[c].cast(kinds[c]).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns)
    )
    return plain.unionByName(changed)

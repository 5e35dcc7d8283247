"""Information-theoretic sanitisation of personal data.

Strict patterns find the base entities (e-mail addresses, IP addresses, card and phone numbers). A corpus-wide
co-occurrence count then finds the words that reveal them: with N documents, n(e) that hold the entity, n(t) that
hold the word and n(t, e) that hold both, wherever they stand in the document,

    PMI(t; e) = log2(n(t, e) * N / (n(t) * n(e))),   information of e = log2(N / n(e)),

and the share PMI / information is how much of the entity the word gives away (1: the word never occurs without
it). Words whose share reaches the threshold, in at least ``MIN_DOCS`` different texts with the entity, are spans
wherever they stand in any document; in the sanitised text entities and such words are generalised to their kind, and
words that give away nearly everything are removed.

All is DataFrame code. Counts are partial aggregates, and no text moves: words are paired with entities by text,
and the places of the words found are cut out where a text is scanned. Entities that stand in exactly the same texts
have the same counts with every word, so they are one class, and a contact list of n addresses costs n words times its
classes, not n times n. A word must stand in two texts of a class at least, so it stands in one besides the longest: words
of all but the longest text are candidates, and are looked up in that one.

Texts are told apart by their 64-bit XXH64, sets of texts by four aggregates of such hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, table, text_of

KINDS = ("email", "ip", "card", "phone", "term")
THRESHOLD = 0.9
REMOVE = 0.999
MIN_DOCS = 2
#: Bits of the bitmap of flagged words: 128 KiB, whatever their number.
BITS = 1 << 20

_E = "[A-Za-z0-9._%+-]"
#: Each pattern matches what the contract's does, leftmost and without overlaps. Possessive and anchored forms keep
#: long runs linear: a match can begin only where a run begins or the last match ended. The card pattern matches
#: the maximal runs of 12 to 19 digits alone.
PATTERNS = {
    "email": rf"(?:(?<!{_E})|\G){_E}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Words: ASCII letters and digits and all characters beyond ASCII.
WORD = r"[A-Za-z0-9\x{80}-\x{10FFFF}]++"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, pattern: str, found: Column, only: Column | None = None) -> Column:
    """start, end and value of each match, from the lengths of the matches and of the pieces between them; with
    ``only``, an array of words in lower case, of those in it."""
    none = F.slice(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("value"))), 1, 0)
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        out = F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))))
        if only is not None:
            out = F.when(F.array_contains(only, F.lower(x["value"])), out).otherwise(acc["out"])
        return F.when(x["value"].isNull(), acc).otherwise(F.struct(end.alias("at"), out.alias("out")))

    def all_placed(gaps: Column) -> Column:
        return F.aggregate(F.arrays_zip(gaps.alias("gap"), found.alias("value")), zero, step, lambda acc: acc["out"])

    # the outer transform makes the pieces once
    placed = F.transform(F.array(F.split(text, pattern, -1)), all_placed)[0]
    return F.when(F.size(found) == 0, none).otherwise(placed)


def words_in(text: Column) -> Column:
    """The different words in lower case, each lowered by itself (the empty one may be among them)."""
    return F.array_distinct(F.transform(F.array_distinct(F.split(text, NOT_WORD)), F.lower))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(values, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(short, lambda p: (F.length(p) <= 2) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """The entity that a match names, however it is written."""
    return F.concat(F.lit(f"{kind}:"), F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value))


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, tie, base (array of start, kind number, end, entity) and words (all different words of a text that holds
    entities, else NULL): one row per row."""
    d = docs.select("doc_id", text_of().alias("t"))
    d = d.withColumns({f"m_{k}": _found(F.col("t"), PATTERNS[k]) for k in PATTERNS})
    d = d.withColumns({f"p_{k}": _placed(F.col("t"), PATTERNS[k], F.col(f"m_{k}")) for k in PATTERNS})

    def entities(kind: str, number: int) -> Column:
        held = F.filter(f"p_{kind}", lambda x: _holds(kind, x["value"]))
        return F.transform(held, lambda x: F.struct(
            x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"), _entity(kind, x["value"]).alias("entity")))

    base = F.array_sort(F.concat(*[entities(k, i) for i, k in enumerate(PATTERNS)]))
    d = d.select("doc_id", F.xxhash64("t").alias("tie"), "t", base.alias("base"))
    return d.select("doc_id", "tie", "base", F.when(F.size("base") > 0, words_in(F.col("t"))).alias("words"))


def word_documents(docs: DataFrame) -> DataFrame:
    """term, n: in how many documents each word stands, over all documents."""
    return (docs.select(F.explode(words_in(text_of())).alias("term")).where("term != ''").groupBy("term")
            .agg(F.count(F.lit(1)).alias("n")))


def _entity_classes(spans: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(entity, class) of the entities that ``min_docs`` different texts hold at least, and (class, tie, copies, n_e):
    the texts of each class, how often each text occurs and in how many documents the class stands."""
    held = table(spans.select("tie", F.explode(F.array_distinct("base.entity")).alias("entity"))
                 .groupBy("entity", "tie").agg(F.count(F.lit(1)).alias("copies")), "held")
    other = F.xxhash64(F.lit("set"), "tie")
    sets = (held.groupBy("entity").agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("n_e"), F.min("tie").alias("low"),
                                       F.max("tie").alias("high"), F.bit_xor(other).alias("xor"),
                                       F.sum(other.cast("decimal(38,0)")).alias("sum"))
            .where(F.col("texts") >= min_docs))
    by = ["texts", "n_e", "low", "high", "xor", "sum"]
    classes = sets.groupBy(*by).agg(F.min("entity").alias("class"))
    named = sets.join(classes, by).select("entity", "class", "n_e")
    named = table(named, "classes")
    texts = held.join(named.where("entity = class"), "entity").select("class", "tie", "copies", "n_e")
    return named.select("entity", "class"), table(texts, "class-texts")


def _class_disclosures(texts: DataFrame, spans: DataFrame, docs: DataFrame, threshold: float, min_docs: int) -> DataFrame:
    """class, term, share: the words that give away the entities of a class."""
    total = float(docs.count())
    information = F.log2(F.lit(total) / F.col("n_e"))
    texts = texts.where(information > 0)
    held = (spans.join(texts.select("tie").distinct(), "tie", "left_semi").select("tie", "words").dropDuplicates(["tie"]))
    longest = (texts.join(held.select("tie", F.size("words").alias("size")), "tie").groupBy("class")
               .agg(F.max(F.struct("size", "tie")).alias("m")).select("class", F.col("m.tie").alias("longest")))
    marked = texts.join(longest, "class")
    # with evidence from one text alone, the longest must give candidates as well
    apart = (F.col("tie") != F.col("longest")) if min_docs > 1 else F.lit(True)
    words = held.select("tie", F.explode("words").alias("term")).where("term != ''")
    found = (marked.where(apart).join(words, "tie").groupBy("class", "term", "n_e", "longest")
             .agg(F.sum("copies").alias("n_te"), F.count(F.lit(1)).alias("texts")))
    # a word in more documents than this cannot reach the threshold, as n(t, e) is n(e) at most
    enough = F.log2("n") <= F.log2(F.lit(total)) - threshold * information + 1e-9
    found = found.join(word_documents(docs).where(F.col("n") >= min_docs), "term").where(enough)
    if min_docs > 1:
        there = words.select(F.col("tie").alias("longest"), "term", F.lit(1).alias("more"))
        copies = marked.where("tie = longest").select("class", F.col("copies").alias("of_longest"))
        found = (found.join(there, ["longest", "term"], "left").join(copies, "class")
                 .withColumn("n_te", F.col("n_te") + F.when(F.col("more").isNotNull(), F.col("of_longest")).otherwise(0))
                 .withColumn("texts", F.col("texts") + F.coalesce("more", F.lit(0))).where(F.col("texts") >= min_docs))
    pmi = F.log2(F.col("n_te") * total / (F.col("n") * F.col("n_e")))
    return found.select("class", "term", (pmi / information).alias("share")).where(F.col("share") >= threshold)


def disclosures(spans: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, min_docs: int = MIN_DOCS) -> DataFrame:
    """entity, term, share: the words that give away an entity. ``spans``: the result of ``spans_of``, kept.

    Evidence is counted in different texts: copies of a whole text are one piece of evidence (all of them count as
    documents), other repetitions are not set aside. A word counts only if ``min_docs`` different texts hold it and
    the entity; an entity that fewer texts hold gives away no words, as any word that is nowhere else would have
    share 1 there. Words of the entity as it is written count like others.
    """
    named, texts = _entity_classes(spans, min_docs)
    return (named.join(_class_disclosures(texts, spans, docs, threshold, min_docs), "class").select("entity", "term", "share"))


def _bits(term: Column) -> list[Column]:
    """The bits of a word in the bitmap."""
    return [F.pmod(h, F.lit(BITS)) for h in (F.crc32(term.cast("binary")), F.xxhash64(term), F.xxhash64(F.lit("more"), term))]


def _bitmap(terms: DataFrame) -> bytes:
    """BITS bits; set are those of each ``term``."""
    parts = (terms.select(F.explode(F.array(*_bits(F.col("term")))).alias("bit")).groupBy(F.shiftright("bit", 15).alias("nth"))
             .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).collect())
    bits = {p["nth"]: bytes(p["bits"]) for p in parts}
    return b"".join(bits.get(i, bytes(1 << 12)) for i in range(BITS >> 15))


def _has_bits(bits: bytes, term: Column) -> Column:
    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.lit(bits), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1

    first, *more = [is_set(at) for at in _bits(term)]
    for one in more:  # a word whose first bit is not set is not looked up again
        first = first & one
    return first


def term_spans(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """doc_id, tie, terms: array of (start, kind number, end, share) of all places of the flagged words (term, share)
    in all documents; documents without any are left out, repeated rows are one.

    One scan: a bitmap of fixed size tells which words of a text may be flagged, their places alone leave the scan,
    and the join with ``flagged`` removes those that only had the same bits."""
    bits = _bitmap(flagged)
    d = docs.select("doc_id", text_of().alias("t")).withColumn("tie", F.xxhash64("t"))
    d = d.withColumn("own", F.filter(words_in(F.col("t")), lambda w: _has_bits(bits, w))).where(F.size("own") > 0)
    placed = d.select("doc_id", "tie", F.explode(_placed(F.col("t"), WORD, _found(F.col("t"), WORD), F.col("own"))).alias("p"))
    hits = placed.select("doc_id", "tie", "p.start", "p.end", F.lower("p.value").alias("term")).join(flagged, "term")
    one = F.struct("start", F.lit(4).alias("kind"), "end", "share")
    return hits.groupBy("doc_id", "tie").agg(F.collect_set(one).alias("terms"))


def find(docs: DataFrame, threshold: float = THRESHOLD, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, tie, spans: array of (start, kind number, end, share) by start and kind, one row per row.

    Positions are code points, end exclusive; kinds are numbered as in KINDS; share is NULL for entities, and the
    largest over entities for words; words that overlap an entity are left to it. NULL and empty texts have no spans;
    repeated rows have the same spans and count as documents each; an empty table gives no rows; other columns are
    not read.
    """
    spans = cut(spans_of(docs))
    _, texts = _entity_classes(spans, min_docs)
    shares = _class_disclosures(texts, spans, docs, threshold, min_docs)
    flagged = table(shares.groupBy("term").agg(F.max("share").alias("share")), "flagged")
    terms = term_spans(docs, flagged).withColumnsRenamed({"doc_id": "_doc_id", "tie": "_tie"})
    kind = "array<struct<start:int,kind:int,end:int,share:double>>"
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"),
                                                  F.lit(None).cast("double").alias("share")))
    apart = F.filter("terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    both = F.array_sort(F.concat(base.cast(kind), F.coalesce(apart.cast(kind), F.array().cast(kind))))
    return (spans.select("doc_id", "tie", "base")
            .join(terms, spans["doc_id"].eqNullSafe(F.col("_doc_id")) & (spans["tie"] == F.col("_tie")), "left")
            .select("doc_id", "tie", both.alias("spans")))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised(docs: DataFrame, threshold: float = THRESHOLD, min_docs: int = MIN_DOCS,
              remove: float = REMOVE) -> DataFrame:
    """``docs`` with entities and revealing words in the text generalised to ``[KIND]``; words whose share is at
    least ``remove`` are removed. Of overlapping spans the one that starts first (then the longest kind number
    listed first) stands. Same columns; a NULL text stays NULL."""
    key, tie, spans = (free_name(docs, c) for c in ("_key", "_tie", "_spans"))
    found = find(docs, threshold, min_docs).where("size(spans) > 0").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias(key), F.col("tie").alias(tie), F.col("spans").alias(spans)).distinct()
    rows = (docs.withColumn(key, F.coalesce(docs["doc_id"].cast("string"), F.lit("null")))
            .withColumn(tie, F.xxhash64(text_of())).join(found, [key, tie], "left"))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        shown = F.when(s["share"] >= remove, F.lit("")).otherwise(kinds[s["kind"]])
        kept = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(kept, shown)).alias("out")))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.aggregate(F.col(spans), zero, step, rest))
    return rows.withColumn("text", text).select(*docs.columns)

"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' byte lengths give their character spans (a token that ends
inside a character counts it from the character's start); the sorted spans are interval-joined to the sorted
sections of the document, and a token that crosses a boundary goes to one section by the rule:

* ``start``: the section that holds the token's first character;
* ``end``: the section that holds its last character;
* ``most``: the section that holds most of its characters, the earlier one if equal.

So a document's sections always add up to its token count, which separate encoding of sections does not.
Sections are the lines of a text, each with its line feed (``section_counts``), or given fields or sections, a table of
character spans (``span_counts``); what no span covers is a section of its own, without a field.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import small_batches, text_of

RULES = ("start", "end", "most")


def token_spans(text: str, ids: list[int], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character start and end (exclusive, one past the last character touched) of each token."""
    ends = np.cumsum(lengths[np.asarray(ids, "int64")]) if ids else np.zeros(0, "int64")
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    raw = np.frombuffer(text.encode(), "uint8")
    if len(raw) == len(text):
        return starts, ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    return char[starts], char[ends - 1] + 1


def line_bounds(text: str) -> np.ndarray:
    """Starts of the lines and the text's length; an empty text is one empty line."""
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array([*starts, len(text)], "int64")


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and of those the ones that cross a boundary. ``bounds``: section starts, then the end."""
    n = len(bounds) - 1
    first = np.searchsorted(bounds[1:-1], starts, "right")
    last = np.searchsorted(bounds[1:-1], ends - 1, "right")
    if rule == "start":
        owner = first
    elif rule == "end":
        owner = last
    elif rule == "most":
        owner = first.copy()
        for i in np.flatnonzero(first != last):
            cuts = np.clip(bounds[first[i]:last[i] + 2], starts[i], ends[i])
            owner[i] = first[i] + int(np.argmax(np.diff(cuts)))
    else:
        raise ValueError(f"rule must be one of {RULES}")
    return np.bincount(owner, minlength=n), np.bincount(owner[first != last], minlength=n)


_encoders: dict[tuple, tuple] = {}  # of this worker


def _encoder(ranks: dict[bytes, int], pattern: str) -> tuple:
    key = (id(ranks), pattern)
    if key not in _encoders:
        lengths = np.zeros(max(ranks.values()) + 1, "int64")
        for piece, i in ranks.items():
            lengths[i] = len(piece)
        _encoders.clear()
        _encoders[key] = (tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths, ranks)
    return _encoders[key]


def section_counts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, rule: str = "start") -> DataFrame:
    """doc_id, section, start, end, n_tokens, n_crossing, doc_tokens: one row per line of each document.

    Sections are numbered from 0; start and end (exclusive) are code points. ``n_crossing`` are the tokens of the
    section that also touch another; ``doc_tokens`` is the document's total. NULL and empty texts have one empty
    section without tokens; repeated rows repeat; an empty table gives no rows; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    @arrow_udf("struct<bounds array<bigint>, tokens array<bigint>, crossing array<bigint>, total bigint>")
    def count(texts: pa.Array) -> pa.Array:
        encoding, lengths, _ = _encoder(shared.value, pattern)
        rows = []
        for t in texts:
            text = t.as_py() or ""
            ids = encoding.encode_ordinary(text)
            starts, ends = token_spans(text, ids, lengths)
            bounds = line_bounds(text)
            held, crossing = attribute(starts, ends, bounds, rule)
            rows.append({"bounds": bounds.tolist(), "tokens": held.tolist(), "crossing": crossing.tolist(), "total": len(ids)})
        kind = pa.list_(pa.int64())
        return pa.array(rows, pa.struct([("bounds", kind), ("tokens", kind), ("crossing", kind), ("total", pa.int64())]))

    counted = docs.select("doc_id", count(text_of()).alias("c"))
    each = F.posexplode(F.arrays_zip(F.col("c.tokens"), F.col("c.crossing"))).alias("section", "n")
    return counted.select("doc_id", "c", each).select(
        "doc_id", "section", F.col("c.bounds")[F.col("section")].alias("start"),
        F.col("c.bounds")[F.col("section") + 1].alias("end"), F.col("n.tokens").alias("n_tokens"),
        F.col("n.crossing").alias("n_crossing"), F.col("c.total").alias("doc_tokens"))


def segments(length: int, spans: list[tuple[int, int, str | None]]) -> tuple[np.ndarray, list[str | None]]:
    """Bounds of a text of ``length`` characters and the field of each part: the spans in order, and what lies between them
    (None). Spans are cut to the text; of overlapping ones the first by start, then end, then field has what they share."""
    bounds, fields, at = [0], [], 0
    for start, end, field in sorted(spans, key=lambda s: (s[0], s[1], s[2] is not None, s[2] or "")):
        start, end = min(max(start, at), length), min(max(end, at), length)
        if start > at:
            bounds.append(start)
            fields.append(None)
        bounds.append(max(end, start))
        fields.append(field)
        at = bounds[-1]
    if at < length or not fields:
        bounds.append(length)
        fields.append(None)
    return np.array(bounds, "int64"), fields


def span_counts(docs: DataFrame, spans: DataFrame, ranks: dict[bytes, int], pattern: str, rule: str = "start") -> DataFrame:
    """doc_id, section, field, start, end, n_tokens, n_crossing, doc_tokens: one row per given field or section
    of each document, and per part of its text outside all of them (field NULL).

    ``spans`` (doc_id, field, start, end): code points, end exclusive. Sections are numbered by place. They are cut to
    the text, spans that end before they begin are empty, and of overlapping ones the earlier has what they share
    (``segments``). Spans without a doc_id, start or end, or of no document, are left out; a document without spans, or
    without a doc_id, is one section outside; repeated documents have the same spans each, repeated spans share
    like overlapping ones; empty tables give no rows; other columns are not read.

    A document meets the list of its spans by an equi-join; the tokens are joined to it where the text is encoded.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    own = (spans.select("doc_id", F.col("start").cast("bigint"), F.col("end").cast("bigint"), F.col("field").cast("string"))
           .na.drop(subset=["doc_id", "start", "end"]).groupBy(F.col("doc_id").alias("_doc_id"))
           .agg(F.collect_list(F.struct("start", "end", "field")).alias("spans")))

    @arrow_udf("array<struct<field string, start bigint, end bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint>>")
    def count(texts: pa.Array, lists: pa.Array) -> pa.Array:
        encoding, lengths, _ = _encoder(shared.value, pattern)
        rows = []
        for t, given in zip(texts, lists):
            text = t.as_py() or ""
            ids = encoding.encode_ordinary(text)
            bounds, fields = segments(len(text), [(s["start"], s["end"], s["field"]) for s in given.as_py() or ()])
            held, crossing = attribute(*token_spans(text, ids, lengths), bounds, rule)
            rows.append([{"field": f, "start": a, "end": b, "n_tokens": n, "n_crossing": c, "doc_tokens": len(ids)}
                         for f, a, b, n, c in zip(fields, bounds[:-1].tolist(), bounds[1:].tolist(), held.tolist(), crossing.tolist())])
        kind = pa.struct([("field", pa.string()), *[(c, pa.int64()) for c in ("start", "end", "n_tokens", "n_crossing", "doc_tokens")]])
        return pa.array(rows, pa.list_(kind))

    d = docs.select("doc_id", text_of().alias("t"))
    counted = d.join(own, d["doc_id"] == own["_doc_id"], "left").select("doc_id", count("t", "spans").alias("c"))
    return counted.select("doc_id", F.posexplode("c").alias("section", "n")).select("doc_id", "section", "n.*")

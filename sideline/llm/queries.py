"""Registered queries of the operators (thin: operator, then the columns of its contract) and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (block_naming, byte_bpe, ctph, lexical, license_scan, minhash, mixing, prefix_trie, sanitise, sharding, simhash, token_counts,
               toxicity)
from .common import documents

VOCABULARY = "byte_bpe_50k.tiktoken"


def bpe_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to: a row per row, as ``round_trip``."""
    ranks = byte_bpe.read_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(documents(spark, sf_dir)))


def held_out() -> Column:
    """Rows that the classifier does not learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.train(documents(spark, sf_dir), labels.where(~held_out()))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.scores(documents(spark, sf_dir), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op6_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < 4)

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{sanitise.KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return found.select("doc_id", *counts, F.sha2(sanitise.as_text(base), 256).alias("base_sha256"),
                        sanitise.as_text(F.col("spans")).alias("spans"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_groups(documents(spark, sf_dir))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ctph.against_edits(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


def op10_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    ranks = byte_bpe.read_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    return token_counts.section_counts(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def words_pattern(markup: str) -> str:
    """A license template as a regular expression over lower-case words, each after a space."""
    phrase = lambda text: "".join(f" {w.lower()}" for w in re.findall("[A-Za-z0-9\x80-\U0010FFFF]+", text))
    out = []
    for i, piece in enumerate(re.split(r"<<(.*?)>>", markup, flags=re.S)):
        kind, _, what = piece.partition("=")
        if i % 2 == 0:
            out.append(phrase(piece))
        elif kind == "var;match":
            out.append(f"({'|'.join(map(phrase, what.split('|')))})")
        elif kind == "var;words":
            out.append(f"( [^ ]+){{0,{what}}}")
        else:
            out.append({"beginOptional": "(", "endOptional": ")?"}[piece])
    return "".join(out)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_mix": op2_mix,
    "op3_simhash": op3_simhash,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_sanitise": op6_sanitise,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_shard": op8_shard,
    "op9_fingerprints": op9_fingerprints,
    "op10_token_counts": op10_token_counts,
    "op11_minhash": op11_minhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical": op13_lexical,
}

SQL = {
    # the templates as patterns over the words joined by one space, in place of automata
    "op4_license_scan": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS t,
         list_filter(range(0, len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
         list_filter(range(0, len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
         list_filter(range(0, len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl
  FROM d
), l AS (
  SELECT *, list_concat(list_concat(mit, apache), gpl) AS places,
    list_filter([CASE WHEN len(mit) > 0 THEN 'mit' END, CASE WHEN len(apache) > 0 THEN 'apache' END,
                 CASE WHEN len(gpl) > 0 THEN 'gpl' END], lambda x: x IS NOT NULL) AS base,
    list_filter([
      {cases}
    ], lambda x: x IS NOT NULL) AS found
  FROM p
)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_concat(base, found)), ',') AS labels,
       CASE WHEN len(found) > 0 THEN 1.0::DOUBLE WHEN len(places) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM l
""".replace("{cases}", ",\n      ".join(
        f"CASE WHEN regexp_matches(t, '{words_pattern(markup)} ') THEN '{label}' END" for label, markup in license_scan.TEMPLATES)),
    "op7_exact_dedup": """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) AS nth
  FROM t
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op2_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS nth FROM s
), c AS (
  SELECT *, (nth - 1) % 3 + 1 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM w
), o AS (
  SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM c
), k AS (
  SELECT *, rest * weight > cap * open AS capped FROM o
), g AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE weight * (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE
                   / (sum(CASE WHEN NOT capped THEN weight END) OVER ())::DOUBLE END AS target
  FROM k
), p AS (
  SELECT d.doc_id, d.size, g.source_size::BIGINT AS source_size, g.target, d.source,
         round(least(CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END, 3.0) * 4294967296)::HUGEINT AS part
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), e AS (
  SELECT *, sum(part) OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         + ('0x' || substr(sha256('mix-2|' || coalesce('s' || source, 'null')), 1, 8))::BIGINT AS upto
  FROM p
)
SELECT doc_id, size, source_size, target, ((upto // 4294967296 - (upto - part) // 4294967296) * size)::BIGINT AS taken FROM e
""",
    # CRC-32 by bits; then the operator's steps: draw, cut, deal, subdivide twice, fill
    "op8_shard": r"""
WITH b AS (
  SELECT DISTINCT coalesce(text, '') AS t FROM documents
), c AS (
  SELECT t, ('0x' || substr(md5(t), 1, 15))::BIGINT AS key, octet_length(encode(t)) + 1 AS size,
         xor(list_reduce(list_transform(range(0, octet_length(encode(t))), lambda i: ('0x' || substr(hex(encode(t)), 2 * i + 1, 2))::BIGINT),
                         lambda s, x: list_reduce(range(0, 8), lambda y, k: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END,
                                                  xor(s, x)), 4294967295::BIGINT), 4294967295) AS crc
  FROM b
), r AS (
  SELECT d.doc_id, c.size, c.crc, c.key,
         c.key || '|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || c.size AS name,
         row_number() OVER (ORDER BY c.key, d.doc_id NULLS FIRST) AS id
  FROM documents d JOIN c ON coalesce(d.text, '') = c.t
), n AS (
  SELECT sum(size)::DOUBLE AS total, count(*) AS docs,
         greatest(1024, ceil(count(*) / 1000000.0))::BIGINT AS ranges FROM r
), drawn AS (
  SELECT key, floor(size * (16 * ranges / total) + ('0x' || substr(md5('draw|' || name), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)::BIGINT AS times
  FROM r, n
), k AS (
  SELECT list(key ORDER BY key) AS keys FROM (SELECT key, unnest(range(0, times)) FROM drawn)
), cuts AS (
  SELECT CASE WHEN len(keys) >= ranges THEN list_transform(range(1, ranges), lambda i: keys[(i * len(keys)) // ranges + 1])
              ELSE coalesce(keys, []) END AS cuts FROM k, n
), place AS (
  SELECT r.*, len(list_filter(cuts, lambda x: x < key)) AS lo, len(list_filter(cuts, lambda x: x <= key)) AS hi FROM r, cuts
), r0 AS (
  SELECT *, CASE WHEN hi - lo >= 2 THEN lo + 1 + ('0x' || substr(md5('deal|' || name), 1, 13))::BIGINT % (hi - lo - 1) ELSE hi END AS rng FROM place
), full0 AS (
  SELECT rng, ceil(sum(size) / greatest(any_value(total) / any_value(ranges), 1.0))::BIGINT AS parts FROM r0, n GROUP BY rng
  HAVING sum(size) > 2.0 * greatest(any_value(total) / any_value(ranges), 1.0)
), r1 AS (
  SELECT r0.*, coalesce(('0x' || substr(md5('part|' || key), 1, 13))::BIGINT % parts, 0) AS by_key FROM r0 LEFT JOIN full0 USING (rng)
), full1 AS (
  SELECT rng, by_key, ceil(sum(size) / greatest(any_value(total) / any_value(ranges), 1.0))::BIGINT AS parts FROM r1, n GROUP BY rng, by_key
  HAVING sum(size) > 2.0 * greatest(any_value(total) / any_value(ranges), 1.0)
), r2 AS (
  SELECT r1.*, coalesce(('0x' || substr(md5('part|' || name), 1, 13))::BIGINT % parts, 0) AS by_doc FROM r1 LEFT JOIN full1 USING (rng, by_key)
), held AS (
  SELECT rng, by_key, by_doc, sum(size) AS held, count(*) AS members FROM r2 GROUP BY ALL
), filled AS (
  SELECT *, least(floor((coalesce(sum(held) OVER (ORDER BY rng, by_key, by_doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + held / 2.0)
                        * 8 / total)::INTEGER, 7) AS shard FROM held, n
), started AS (
  SELECT *, coalesce(sum(members) OVER (PARTITION BY shard ORDER BY rng, by_key, by_doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM filled
)
SELECT r2.doc_id, r2.size::BIGINT AS size, r2.crc::BIGINT AS text_crc32, 'bytes' AS law, started.shard,
       (started.first + row_number() OVER (PARTITION BY r2.rng, r2.by_key, r2.by_doc ORDER BY r2.key, r2.doc_id NULLS FIRST, r2.size, r2.crc) - 1)::BIGINT AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM r2 JOIN started USING (rng, by_key, by_doc)
""",
    # all pairs that share a shingle, and what links reach
    "op11_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i + 2], ' ')))) AS shingle
  FROM w WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s AS a JOIN s AS b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)
), g AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (
  SELECT doc_id AS root, doc_id FROM documents
  UNION
  SELECT r.root, g.b FROM r JOIN g ON g.a = r.doc_id
), c AS (
  SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
""",
    # every prefix of every conversation spelled out; CRC-32 by bits
    "op12_prefix_trie": """
WITH t AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns,
         xor(list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT),
                         lambda s, x: list_reduce(range(0, 8), lambda y, k: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END,
                                                  xor(s, x)), 4294967295::BIGINT), 4294967295) % 9 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), r AS (
  SELECT t.conv_id, list_concat(coalesce(lead.turns, [])[1:t.h], t.turns[t.h + 1:]) AS seq
  FROM t LEFT JOIN t AS lead ON lead.conv_id = t.conv_id - t.conv_id % 5
), p AS (
  SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM r
), n AS (
  SELECT depth, seq[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len(seq)), '')) AS ends_sha256
  FROM p GROUP BY ALL
), c AS (
  SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), o AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n.depth > 0 THEN (n_convs - 1) * octet_length(encode(n.node[n.depth].text)) ELSE 0 END AS saving
  FROM n LEFT JOIN c ON c.depth = n.depth AND c.node = n.node
), a AS (
  SELECT *, unnest(range(0, depth + 1)) AS above FROM o
), s AS (
  SELECT above AS depth, node[1:above] AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saving) AS saved_tokens FROM a GROUP BY ALL
)
SELECT o.conv_id, o.depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM o JOIN s ON s.depth = o.depth AND s.node = o.node LEFT JOIN n AS up ON up.depth = o.depth - 1 AND up.node = o.node[1:o.depth - 1]
""",
    # every document scored for every item, without strata or bounds
    "op13_lexical": r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), n AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL
), s AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n
), m AS (
  SELECT doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM n, s
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term
), scores AS (
  SELECT q.item_id, tf.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
""",
}

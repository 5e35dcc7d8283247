"""The registered queries against brute force over a whole small table."""

import hashlib
import re
import zlib

import pytest
from test_sanitise import CONTRACT, brute
from test_simhash import brute_components, slow_fingerprint

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op3_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op4_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                        "labels string, score double",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_sanitise": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op7_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op8_shard": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                        "near_edited double, near_next double",
    "op11_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op10_token_counts": "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint",
}


@pytest.fixture(scope="module")
def results(spark):
    made = {}

    def of(name):
        if name not in made:
            df = E.queries()[name](spark, SF)
            made[name] = (", ".join(f"{c} {t}" for c, t in df.dtypes), df.collect())
        return made[name]

    return of


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_one_row_per_document(results, docs, name):
    columns, rows = results(name)
    assert columns == COLUMNS[name]
    ids = [r.doc_id for r in rows] if name != "op10_token_counts" else list({r.doc_id for r in rows})
    assert sorted(ids) == [r.doc_id for r in docs]


@pytest.mark.parametrize("name,columns", [
    ("op12_prefix_trie", "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
                         "saved_tokens bigint, ends_sha256 string"),
    ("op13_lexical", "item_id bigint, rank int, doc_id bigint, score bigint")])
def test_columns_of_nodes_and_ranks(results, name, columns):
    assert results(name)[0] == columns and results(name)[1]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_simhash(results, docs):
    fps = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    comp, least = brute_components(fps.values()), {}
    for i, f in fps.items():
        least.setdefault(comp[f], i)
    assert sorted(map(tuple, results("op3_simhash")[1])) == [(i, f"{f:016x}", least[comp[f]]) for i, f in fps.items()]


def test_sanitise(results, docs):
    text = {r.doc_id: r.text or "" for r in docs}
    for r in results("op6_sanitise")[1]:
        spans = brute(text[r.doc_id])
        names = [f"{list(CONTRACT)[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == sha(",".join(names))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(names) <= set(r.spans.split(",")) | {""} and (names or not re.search("email|ip|card|phone", r.spans))


def test_fingerprints(results, docs):
    got = {r.doc_id: r for r in results("op9_fingerprints")[1]}
    texts = [r.text or "" for r in docs]
    for k, r in enumerate(docs):
        n = len(texts[k])
        edited = texts[k][:n - n // 4] + texts[(k + 1) % len(texts)][:n // 4]
        assert (got[r.doc_id].n_chars, got[r.doc_id].edited_sha256) == (n, sha(edited))
        assert got[r.doc_id].edited_fingerprint == got[r.doc_id].fingerprint or edited != texts[k]
        assert 0 <= got[r.doc_id].near_next <= 1 and 0 <= got[r.doc_id].near_edited <= 1
    by_text = {}
    for k, r in enumerate(docs):
        assert by_text.setdefault(texts[k], got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint


def test_toxicity_holds_out_a_fifth(results, docs):
    for r in results("op5_toxicity")[1]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_shards(results, docs):
    rows = results("op8_shard")[1]
    assert {r.law for r in rows} == {"bytes"} and {r.shard for r in rows} == set(range(8))
    size = {s: sum(r["size"] for r in rows if r.shard == s) for s in range(8)}
    largest = max(r["size"] for r in rows)
    assert max(size.values()) - min(size.values()) <= 2 * largest
    for s in range(8):
        mine = sorted(r.slot for r in rows if r.shard == s)
        assert mine == list(range(len(mine)))

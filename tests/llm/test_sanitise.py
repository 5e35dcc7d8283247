import random
import re

import pytest
from helpers import odd_rows, prose, table

from sideline.llm import sanitise as S

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
            "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    return sorted((m.start(), n, m.end()) for n, (kind, pattern) in enumerate(CONTRACT.items())
                  for m in re.finditer(pattern, text or "") if holds(kind, m.group()))


def base_spans(spark, texts):
    got = S.find(table(spark, [(k, t, "s") for k, t in enumerate(texts)])).collect()
    return {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.kind < 4] for r in got}


def test_base_spans_equal_the_contract(spark):
    rng = random.Random(1)
    texts = [t for _, t, _ in odd_rows()] + [
        "mail a.b+c@x-y.example.org, or d@e or f@g.h@i.j", "a@b.c+d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 00255.1.2.3 9999.1.1.1",
        "4111 1111 1111 1111 and 4111-1111-1111-1111 and 4111  1111 1111 1111", "x4111111111111111y", "+1 (555) 555-0100. +49.30",
        "+1234567890123456", "ß 😀 é a@b.cd 漢 4111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2", "12-34-56-78-90-12 3", "5" * 16 + " 4"]
    for chars, n in (("0123456789 -", 60), ("01.", 40), ("a@.b+-", 30), ("+1 ().-23", 50), ("0 ", 40), ("4a@.1+- ", 80)):
        texts += ["".join(rng.choices(chars, k=rng.randint(0, n))) for _ in range(150)]
    got = base_spans(spark, texts)
    for k, t in enumerate(texts):
        assert got[k] == brute(t), t


def test_long_runs_stay_linear(spark):
    long = ["1 " * 60_000, "1" * 120_000, "a" * 120_000, "1." * 60_000, "a@" * 50_000, "+1" + "2" * 100_000, "x@" + "a." * 50_000]
    got = base_spans(spark, long)
    assert [len(got[k]) for k in (0, 1, 2, 3)] == [0, 0, 0, 15_000]
    assert got[6] == [(0, 0, 100_000 + 1)]


def corpus(rng, n=200):
    rows = [(k, prose(rng, 30), "s") for k in range(n)]
    for k in range(5):  # a nickname that stands near one address only, in different surroundings
        rows.append((1000 + k, f"{prose(rng, 9)} quillfeather wrote from q.f@mail.example.com today {prose(rng, 9)}", "s"))
    for k in range(60):
        rows.append((2000 + k, f"{prose(rng, 9)} wrote from here today {prose(rng, 9)}", "s"))
    for k in range(3):  # copies of one passage are no evidence
        rows.append((3000 + k, "lonelyword beside other@mail.example.com here", "s"))
    return rows


def test_words_that_reveal_an_entity(spark):
    rows = corpus(random.Random(2))
    text = {i: t for i, t, _ in rows}
    found = {}
    for r in S.find(table(spark, rows)).collect():
        found[r.doc_id] = [(text[r.doc_id][s.start:s.end], s.kind) for s in r.spans]
    for k in range(1000, 1005):
        terms = [w for w, kind in found[k] if kind == 4]
        assert "quillfeather" in terms and "wrote" not in terms and ("q.f@mail.example.com", 0) in found[k]
    assert all(not found[k] for k in list(range(200)) + list(range(2000, 2060)))
    assert all([kind for _, kind in found[k]] == [0] for k in range(3000, 3003))


def test_shares_equal_brute_force(spark):
    import math

    rows = corpus(random.Random(3))
    docs = table(spark, rows)
    got = {(r.entity, r.term): r.share for r in S.disclosures(S.spans_of(docs), docs, -9.0).collect()}
    n = len(rows)
    holds_word = lambda w: sum(w in re.split(r"[^a-z]+", t) for _, t, _ in rows)
    for word in ("quillfeather", "wrote", "from", "today"):
        pmi = math.log2(5 * n / (holds_word(word) * 5))
        assert got["email:q.f@mail.example.com", word] == pytest.approx(pmi / math.log2(n / 5))


def test_sanitised_text(spark):
    rows = corpus(random.Random(4)) + [(9000, None, "s"), (None, "call +1 555 555 0100 now", "s")]
    docs = table(spark, rows)
    out = S.sanitised(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == len(rows)
    assert "quillfeather" not in got[1000] and "[EMAIL]" in got[1000] and "@" not in got[1000] and " wrote from " in got[1000]
    assert got[9000] is None and got[None] == "call [PHONE] now" and got[0] == rows[0][1]


def test_evidence_is_counted_in_different_texts(spark):
    rng = random.Random(5)
    footer = f"{prose(rng, 12)} zebrawing reach me at z.w@mail.example.com any time {prose(rng, 12)}"
    rows = [(k, prose(rng, 30), "s") for k in range(200)]
    rows += [(1000 + k, f"{prose(rng, 20)} {footer} {prose(rng, 20)}", "s") for k in range(4)]  # one footer, different texts
    rows += [(2000 + k, "onlyhere solo@mail.example.com", "s") for k in range(4)]  # copies of a whole text
    rows.append((3000, "singleword single@mail.example.com", "s"))  # an entity of one document
    text = {i: t for i, t, _ in rows}
    terms = {r.doc_id: {text[r.doc_id][s.start:s.end] for s in r.spans if s.kind == 4} for r in S.find(table(spark, rows)).collect()}
    assert all("zebrawing" in terms[1000 + k] for k in range(4))
    assert all(not terms[k] for k in (2000, 2001, 2002, 2003, 3000))


def test_words_count_and_are_found_in_whole_documents(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, 30), "s") for k in range(200)]
    far = " ".join(prose(rng, 1) for _ in range(60))  # the name and the number always stand far from the address
    rows += [(1000 + k, f"{prose(rng, 9)} Zebrawing AC4417X {far} to z.w@mail.example.com {prose(rng, 9)} zebrawing", "s") for k in range(12)]
    rows += [(2000, f"{prose(rng, 9)} ZEBRAWING called", "s"), (None, "no address, zebrawing", "s"), (None, "no address, zebrawing", "s")]
    rows += [(3000 + k, f"ézebra@x.org zebra {prose(rng, 9)}", "s") for k in range(2)]
    text = {i: t for i, t, _ in rows}
    found = {}
    for r in S.find(table(spark, rows), 0.8).collect():
        found.setdefault(r.doc_id, []).append([(s.kind, text[r.doc_id][s.start:s.end]) for s in r.spans])
    for k in range(12):
        words = [w for kind, w in found[1000 + k][0] if kind == 4]
        assert {"Zebrawing", "AC4417X", "zebrawing"} <= set(words) and "z" not in words
    assert (4, "ZEBRAWING") in found[2000][0]
    assert found[None] == [[(4, "zebrawing")]] * 2
    assert (0, "zebra@x.org") in found[3000][0] and (4, "zebra") in found[3000][0] and (4, "ézebra") not in found[3000][0]


def test_plan_is_native_and_empty_table(spark):
    plan = S.find(table(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
    assert S.find(table(spark, [])).count() == 0


def slow_terms(rows, threshold, min_docs):
    """Spans of revealing words in each row, by the definition: rows (doc_id, text)."""
    import math

    texts = [t or "" for _, t in rows]
    words = [{w.lower() for w in re.findall(r"[A-Za-z0-9\x80-\U0010FFFF]+", t)} for t in texts]

    def name(kind, value):
        return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else re.sub('[^0-9]', '', value)}"

    entities = [{name(list(CONTRACT)[k], t[a:b]) for a, k, b in brute(t)} for t in texts]
    n = len(rows)
    shares = {}
    for e in set().union(*entities):
        held = [i for i in range(n) if e in entities[i]]
        if len({texts[i] for i in held}) < min_docs or len(held) == n:
            continue
        for w in set().union(*(words[i] for i in held)):
            both = [i for i in held if w in words[i]]
            if len({texts[i] for i in both}) >= min_docs:
                n_w = sum(w in x for x in words)
                share = math.log2(len(both) * n / (n_w * len(held))) / math.log2(n / len(held))
                if share >= threshold:
                    shares[w] = max(share, shares.get(w, -math.inf))
    out = []
    for t in texts:
        base = brute(t)
        out.append(sorted((m.start(), m.end(), round(shares[m.group().lower()], 9)) for m in re.finditer(r"[A-Za-z0-9\x80-\U0010FFFF]+", t)
                          if m.group().lower() in shares and not any(a < m.end() and m.start() < b for a, _, b in base)))
    return out


@pytest.mark.parametrize("threshold,min_docs", [(0.9, 2), (0.5, 2), (0.6, 3), (0.7, 1)])
def test_revealing_words_from_scratch(spark, threshold, min_docs):
    rng = random.Random(min_docs)
    names = ["Quill", "ÉMILE", "ac4417x", "Zebra", "wrote"]
    mails = ["a@b.cd", "c.d@e.fg", "10.0.0.1", "+1 555 555 0100", "x@y.zz"]
    rows = []
    for k in range(90):
        parts = [prose(rng, rng.randint(0, 4))]
        if rng.random() < 0.5:
            i = rng.randrange(5)
            parts += [names[i], mails[i]] + ([mails[(i + 1) % 5]] if rng.random() < 0.3 else [])
        rng.shuffle(parts)
        rows.append((k, " ".join(parts)))
    rows += [(100 + k, rows[3][1]) for k in range(4)] + [(5, None), (6, "")] + [(None, rows[4][1])] * 2
    got = S.find(table(spark, [(i, t, "s") for i, t in rows]), threshold, min_docs).collect()
    spans = lambda r: sorted((s.start, s.end, round(s.share, 9)) for s in r.spans if s.kind == 4)
    want = slow_terms(rows, threshold, min_docs)
    assert any(want)
    assert sorted(map(str, ((r.doc_id, spans(r)) for r in got))) == sorted(map(str, ((i, w) for (i, _), w in zip(rows, want))))


def test_contact_lists_stay_linear(spark):
    rng = random.Random(8)
    mails = [f"m{k}@list.example.org" for k in range(2000)]
    rows = [(k, prose(rng, 20)) for k in range(40)]
    rows += [(100 + k, " ".join(rng.sample(mails, 2000))) for k in range(2)]  # two lists of the same addresses
    docs = table(spark, [(i, t, "s") for i, t in rows])
    spans = S.spans_of(docs)
    named, texts = S._entity_classes(spans, 2)
    assert named.count() == 2000 and named.select("class").distinct().count() == 1 and texts.count() == 2
    # one long list, and each address once more in a text of its own: words of the short texts are the candidates
    rows = [(0, " ".join(mails))] + [(1 + k, f"{m} {prose(rng, 3)}") for k, m in enumerate(mails[:300])] + [(1000 + k, prose(rng, 4)) for k in range(50)]
    found = {r.doc_id: [s for s in r.spans if s.kind == 4] for r in S.find(table(spark, [(i, t, "s") for i, t in rows])).collect()}
    want = slow_terms(rows, 0.9, 2)
    assert {i: len(found[i]) for i, _ in rows} == {i: len(w) for (i, _), w in zip(rows, want)}


def test_bitmap_and_places(spark):
    terms = spark.createDataFrame([(f"w{k}",) for k in range(500)] + [("é漢",)], "term string")
    bits = S._bitmap(terms)
    assert len(bits) == S.BITS // 8
    df = spark.createDataFrame([(f"w{k}",) for k in range(2000)] + [("é漢",), ("",)], "term string")
    hit = {r.term for r in df.where(S._has_bits(bits, df["term"])).collect()}
    assert {f"w{k}" for k in range(500)} | {"é漢"} <= hit and len(hit) < 505

import re

import pytest
from helpers import odd_rows, table

from sideline.llm import license_scan as L


def labels(text):
    return {label for label, base, _, _ in L.Scanner().scan(text)[1] if not base}


def test_mandatory_wording_must_stand_exactly():
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0"}
    assert labels("released UNDER the terms of the mit license") == {"mit-notice"}
    assert labels("Licensed under the Apache Software License, Version 2.0") == set()
    assert labels("Licensed under the Apache License, Version 1.1") == set()
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3.0"}
    assert labels("under the General Public License as published by the Free Software Foundation; either version 2") == {"gpl-2.0"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-4.0"}
    assert labels("Licensed under a Creative Commons Attribution-ShareAlike 4.0") == {"cc-by-sa-4.0"}
    assert labels("Copyright (c) 2020 Some Name, all rights reserved") == {"all-rights-reserved"}
    assert labels("Copyright one two three four five six seven all rights reserved") == set()


def test_markup_errors():
    for bad in ("a <<endOptional>>", "<<beginOptional>> a", "a <<what>>"):
        with pytest.raises(ValueError):
            L.compile_template("x", bad)
    with pytest.raises(ValueError):
        L.compile_template("x", "<<var;words=2>> a").first_words()


def test_nested_optionals_and_longest_match():
    a = L.compile_template("x", "a<<beginOptional>> b<<beginOptional>> c<<endOptional>><<endOptional>> d<<beginOptional>> e<<endOptional>>")
    ends = {t: a.match(L.words_of(t), 0) for t in ("a d", "a b d", "a b c d e", "a c d", "a b", "a d e")}
    assert ends == {"a d": 2, "a b d": 3, "a b c d e": 5, "a c d": None, "a b": None, "a d e": 3}


def test_base_columns_equal_brute_force(spark):
    texts = [t for _, t, _ in odd_rows()] + [
        "MIT License mit license; MIT-License", "the General Public\nLicense, apache  license", "éMIT License", "mit license" * 3,
        "general general public license public license", "word " * 3000 + "Apache License"]
    got = {r.doc_id: r for r in L.summary(L.scan(table(spark, [(k, t, "s") for k, t in enumerate(texts)]))).collect()}
    for k, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        places = [(i, label) for phrase, label in L.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[k]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert L.scan(table(spark, [])).count() == 0


def filled(markup):
    """A text that a template accepts: first choices, names of three words, optional words left out."""
    plain = re.sub(r"<<beginOptional>>.*?<<endOptional>>", "", markup, flags=re.S)
    plain = re.sub(r"<<var;match=([^|>]*)[^>]*>>", r"\1", plain)
    return re.sub(r"<<var;words=\d+>>", "Some Name Inc", plain)


WHOLE = {"mit-text": "NONINFRINGEMENT", "bsd-2-clause": "ADVISED", "bsd-3-clause": "endorse", "bsd-4-clause": "advertising",
         "bsd-3-clause-clear": "PATENT", "isc": "TORTIOUS", "apache-2.0-text": "indemnify", "gpl-2.0-text": "INACCURATE", "gpl-3.0-text": "INACCURATE"}


@pytest.mark.parametrize("label", WHOLE)
def test_whole_texts_to_their_last_clause(label):
    text = filled(dict(L.TEMPLATES)[label])
    texts = set(WHOLE) & labels(f"Name, 2020. {text} and more")
    assert texts == {label}
    late = WHOLE[label]
    assert late in text
    words = text.split()
    for changed in (text.replace(late, f"not {late}"), text.replace(late, ""), " ".join(words[:-1]),
                    " ".join(words[:30]), " ".join(words[:-20] + ["for", "good", "not", "evil"] + words[-20:])):
        assert not set(WHOLE) & labels(changed)


def test_openings_alone_are_no_license():
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
                  "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software") == set()
    assert labels("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                  "following conditions are met: ask first") == set()
    assert labels("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted") == set()


def test_sql_equals_the_query_on_whole_texts_openings_and_changed_clauses(spark):
    import duckdb

    from sideline.llm import queries

    texts = [t for _, t, _ in odd_rows()] + ["MIT License", "mit license apache license", "Copyright (c) 2020 Some Name, all rights reserved"]
    for label, markup in L.TEMPLATES:
        text = filled(markup)
        optional = re.sub(r"<<(begin|end)Optional>>", "", markup)
        optional = re.sub(r"<<var;words=\d+>>", "", re.sub(r"<<var;match=[^>]*?([^|>]*)>>", r"\1", optional))
        words = text.split()
        texts += [text, f"before {text} after", optional, text.upper(), " ".join(words[:25]), " ".join(words[:-1]),
                  " ".join([*words[:-3], "not", *words[-3:]]), " ".join(words[:-3] + words[-2:])]
    rows = list(enumerate(texts))
    got = {r.doc_id: tuple(r) for r in L.summary(L.scan(table(spark, [(i, t, "s") for i, t in rows]))).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(queries.SQL["op4_license_scan"]).fetchall()
    assert {r[0]: r for r in want} == got
    assert {x for r in want for x in r[6].split(",")} >= {label for label, _ in L.TEMPLATES}

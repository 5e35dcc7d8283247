import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sideline.functions.rules import (CATEGORY, INJURY_TYPE, PLAY_TYPE_REPORT, PLAY_TYPE_WINDOW,
                                      REGION_ETL, REGION_REPORT, RULESETS, SEVERITY, SEVERITY_ETL,
                                      RuleSet, classify, one_scan, with_labels)
from sideline.functions.text import text_of

# Golden labels (hand-derived from the rule tables).
# text, injury_type, E1, E2, E3, E4, E5, E6, E7
INJURY_GOLDEN = [
    ("torn ACL in right knee", None, "HIGH", "HIGH", "HIGH", "KNEE", "KNEE", "TEAR_RUPTURE", "Torn"),
    ("partial tear of left hamstring", None, "HIGH", "HIGH", "HIGH", "HAMSTRING", "HAMSTRING", "TEAR_RUPTURE", "Tear"),
    ("grade 2 sprain of left ankle", None, "MEDIUM", "MEDIUM", "MEDIUM", "ANKLE", "ANKLE", "SPRAIN_STRAIN", "Sprain"),
    ("surgical procedure on nose", None, "UNKNOWN", "HIGH", "HIGH", "OTHER", "HEAD", "OTHER", "Procedure"),
    ("fractured metacarpal", None, "UNKNOWN", "UNKNOWN", "UNKNOWN", "OTHER", "OTHER", "OTHER", "Fracture"),
    ("lumbar soreness", None, "LOW", "LOW", "LOW", "BACK", "OTHER", "OTHER", "Soreness"),
    ("adductor strain", None, "LOW", "LOW", "LOW", "GROIN", "OTHER", "SPRAIN_STRAIN", "Strain"),
    ("broken collarbone", None, "HIGH", "HIGH", "HIGH", "OTHER", "SHOULDER", "FRACTURE", "Other"),
    ("concussion, broken nose", None, "HIGH", "HIGH", "HIGH", "HEAD", "HEAD", "CONCUSSION", "Other"),
    ("back and hip contusion", None, "LOW", "LOW", "LOW", "BACK", "BACK", "CONTUSION", "Contusion"),
    ("dislocation of finger", None, "MEDIUM", "MEDIUM", "MEDIUM", "HAND", "HAND", "OTHER", "Dislocation"),
    ("breakdown in conditioning", None, "UNKNOWN", "UNKNOWN", "UNKNOWN", "OTHER", "OTHER", "OTHER", "Break"),
    ("left foot", "Fracture", "HIGH", "HIGH", "UNKNOWN", "FOOT", "FOOT", "FRACTURE", "Other"),
    ("rest", None, "UNKNOWN", "UNKNOWN", "UNKNOWN", "OTHER", "OTHER", "OTHER", "Other"),
    (None, None, "UNKNOWN", "UNKNOWN", "UNKNOWN", "OTHER", "OTHER", "OTHER", "Other"),
]

# description, actionType, subType, E8, E9
PLAY_GOLDEN = [
    ("James 1' Driving Dunk (2 PTS)", "Made Shot", "Driving Dunk Shot", "DUNK", "DUNK"),
    ("Paul 4' Driving Layup", "Made Shot", "Driving Layup Shot", "LAYUP", "LAYUP"),
    ("Paul drive to the rim", "Other", None, "DRIVE", "OTHER"),
    ("MISS Curry 26' 3PT Jump Shot", "Missed Shot", "Jump Shot", "THREE_POINTER", "THREE_POINTER"),
    ("Durant 15' pullup", "Made Shot", "Pullup", "JUMP_SHOT", "OTHER"),
    ("Durant 15' Jump Shot", "Made Shot", "Jump Shot", "JUMP_SHOT", "JUMP_SHOT"),
    ("Adams REBOUND (Off:1 Def:2)", "Rebound", "Unknown", "REBOUND", "REBOUND"),
    ("Gobert BLOCK (1 BLK)", None, None, "BLOCK", "BLOCK"),
    ("Green P.FOUL (P1.T1)", "Foul", "Personal", "FOUL", "FOUL"),
    ("Harden shot", "Made Shot", "Layup Shot", "OTHER", "LAYUP"),
    (None, None, None, "OTHER", "OTHER"),
]


def test_injury_golden(spark):
    df = spark.createDataFrame([(i, g[0], g[1]) for i, g in enumerate(INJURY_GOLDEN)],
                               "i int, Notes string, Injury_Type string")
    t = text_of("Injury_Type", "Notes")
    out = df.orderBy("i").select(
        classify(t, SEVERITY_ETL), classify(t, SEVERITY), classify(F.lower("Notes"), SEVERITY),
        classify(t, REGION_ETL), classify(t, REGION_REPORT), classify(t, CATEGORY),
        classify(F.lower("Notes"), INJURY_TYPE)).collect()
    assert [tuple(r) for r in out] == [g[2:] for g in INJURY_GOLDEN]


def test_play_golden(spark):
    df = spark.createDataFrame([(i, *g[:3]) for i, g in enumerate(PLAY_GOLDEN)],
                               "i int, description string, actionType string, subType string")
    out = df.orderBy("i").select(
        classify(text_of("description", "actionType"), PLAY_TYPE_WINDOW),
        classify(text_of("description", "actionType", "subType"), PLAY_TYPE_REPORT)).collect()
    assert [tuple(r) for r in out] == [g[3:] for g in PLAY_GOLDEN]


def test_word_boundaries(spark):
    df = spark.createDataFrame([("metacarpal",), ("quadriceps",), ("fractures",), ("sprained",), ("hand",)], "t string")
    got = [r[0] for r in df.select(classify("t", REGION_ETL)).collect()]
    assert got == ["OTHER", "OTHER", "OTHER", "OTHER", "HAND"]


def python_first_match(text, rs):
    """Reference semantics written directly in Python (re, ordered rules)."""
    if text is None:
        return rs.default
    for label, terms in rs.rules:
        if rs.kind == "word":
            if re.search(r"\b(" + "|".join(terms) + r")\b", text):
                return label
        elif any(t in text for t in terms):
            return label
    return rs.default


VOCAB = ["hand", "back", "tear", "partial", "grade", "2", "iii", "sprain", "knee", "ear", "nose", "toe",
         "torn", "rotator", "cuff", "dunk", "3pt", "jump", "shot", "foul", "x", "-", ",", "  ", "é", "surgical"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(VOCAB), max_size=8).map(" ".join), min_size=1, max_size=10),
       st.sampled_from(sorted(RULESETS)))
def test_classify_equals_python_rules(spark, texts, rs_name):
    rs = RULESETS[rs_name]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(classify("t", rs)).collect()]
    assert got == [python_first_match(t, rs) for t in texts]


@pytest.mark.parametrize("rs", [SEVERITY_ETL, REGION_ETL, PLAY_TYPE_WINDOW])
def test_classifier_is_native(spark, rs):
    from sideline.functions.rules import has_label
    base = spark.createDataFrame([("x",)], "t string")
    for df in (base.select(classify("t", rs)), base.filter(has_label("t", rs, rs.rules[0][0]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(VOCAB), max_size=8).map(" ".join)), min_size=1, max_size=10),
       st.sampled_from(sorted(RULESETS)))
def test_has_label_equals_classify(spark, texts, rs_name):
    from sideline.functions.rules import has_label
    rs = RULESETS[rs_name]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for label in [lab for lab, _ in rs.rules] + [rs.default, "NOPE"]:
        got = sorted(r.i for r in df.filter(has_label("t", rs, label)).collect())
        want = sorted(i for i, t in enumerate(texts) if python_first_match(t, rs) == label)
        assert got == want, label


WORD_TABLES = [rs for rs in RULESETS.values() if rs.kind == "word"]
PIECES = [t.replace(r"\s*", gap) for rs in WORD_TABLES for _, ts in rs.rules for t in ts for gap in ("", " ", "\n\t ")] + [
    " ", "  ", ", ", "-", "_", ".", "\n", "é", "ear", "s", "2", "\u0301", " \u0301", "ß", "\u00a0", "\u201c", "grade", "partial", "頭", "cuff", "rotator  cuff", "ACL"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=40))
def test_one_scan_equals_rule_by_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    tables = {rs.name: rs for rs in WORD_TABLES}
    got = with_labels(df, "t", **tables).orderBy("i").collect()
    want = df.select("i", *[classify("t", rs).alias(n) for n, rs in tables.items()]).orderBy("i").collect()
    assert [[r[n] for n in tables] for r in got] == [[r[n] for n in tables] for r in want]


def test_one_scan_golden_and_plan(spark):
    df = spark.createDataFrame([(i, g[0], g[1]) for i, g in enumerate(INJURY_GOLDEN)], "_found int, Notes string, Injury_Type string")
    out = with_labels(df, text_of("Injury_Type", "Notes"), a=SEVERITY_ETL, b=SEVERITY, c=REGION_ETL, d=REGION_REPORT, e=CATEGORY)
    assert out.columns == ["_found", "Notes", "Injury_Type", "a", "b", "c", "d", "e"]
    assert [tuple(r)[3:] for r in out.orderBy("_found").collect()] == [(g[2], g[3], g[5], g[6], g[7]) for g in INJURY_GOLDEN]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "RLIKE" not in plan


def test_overlapping_terms(spark):
    rs = RuleSet("r", (("A", ("left knee pain", "c")), ("B", ("knee",)), ("C", ("left", "pain")), ("D", ("knee pain",))), "none")
    texts = ["left knee", "left knee pain", "left knees pain", "knee pain", "left  knee pain", "painleft", "knee_pain", "left-knee-pain", "abc c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in with_labels(df, "t", x=rs).orderBy("i").collect()]
    assert got == [r.x for r in df.select("i", classify("t", rs).alias("x")).orderBy("i").collect()]
    assert one_scan([rs]) is not None


def test_tables_that_one_scan_cannot_take(spark):
    for rules in ((("A", (r"gr[ae]y",)),), (("A", (r"grade\s*2",)), ("B", ("grade",))), (("A", ("a b",)), ("B", ("ab",))), (("A", ("c++",)),)):
        rs = RuleSet("r", rules, "none")
        assert one_scan([rs]) is None
        if rules[0][1][0] != "c++":
            df = spark.createDataFrame([("grey grade 2 ab",)], "t string")
            assert with_labels(df, "t", x=rs).first().x == df.select(classify("t", rs).alias("x")).first().x
    assert one_scan([INJURY_TYPE]) is None

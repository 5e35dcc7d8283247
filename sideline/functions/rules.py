"""Ordered first-match-wins rule classifiers.

A rule table is data: a list of (label, terms) pairs and a default label.
``classify`` turns it into one CASE WHEN column, evaluated in order, so the
first rule whose terms match decides the label. Two match kinds exist:

* ``"word"``: the text matches ``\\b(t1|t2|...)\\b`` (terms are regex fragments)
* ``"contains"``: the text contains any term as a plain substring

The text is expected lower-case already (see ``text.text_of``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


@dataclass(frozen=True)
class RuleSet:
    name: str
    rules: tuple[tuple[str, tuple[str, ...]], ...]
    default: str
    kind: str = "word"  # or "contains"

    @property
    def labels(self) -> tuple[str, ...]:
        """Every label the rule table can produce (rules in order, then the default)."""
        return tuple(dict.fromkeys([lab for lab, _ in self.rules] + [self.default]))

    def pattern(self, terms: Sequence[str]) -> str:
        return r"\b(" + "|".join(terms) + r")\b"


def literal_probe(term: str) -> str:
    """Longest plain-text prefix of a term fragment (text before any regex syntax)."""
    return re.split(r"[\\.^$|?*+()\[\]{}]", term, maxsplit=1)[0]


def classify(text: ColumnOrName, rs: RuleSet) -> Column:
    """Label of the first matching rule, else ``rs.default``. NULL text gets the default.

    A word rule is guarded by a substring probe: the text can only match
    ``\\b(t1|t2)\\b`` if it contains the literal prefix of t1 or t2, and a
    substring search is far cheaper than a regex scan, so on long texts most
    rules are rejected without running their regex. The guard is exact (a
    necessary condition ANDed with the regex).
    """
    t = _c(text)
    expr = None
    for label, terms in rs.rules:
        cond = _rule_condition(t, rs, terms)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(rs.default) if expr is not None else F.lit(rs.default)


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _rule_condition(t: Column, rs: RuleSet, terms: Sequence[str]) -> Column:
    if rs.kind == "contains":
        return _any([t.contains(term) for term in terms])
    if rs.kind != "word":
        raise ValueError(f"unknown rule kind {rs.kind!r}")
    matched = t.rlike(rs.pattern(terms))
    probes = [literal_probe(term) for term in terms]
    return _any([t.contains(p) for p in dict.fromkeys(probes)]) & matched if all(probes) else matched


def has_label(text: ColumnOrName, rs: RuleSet, label: str) -> Column:
    """Predicate ``classify(text, rs) == label`` for use in filters.

    A filter pushed below the projection that builds the text gets the text
    expression inlined into every rule condition, and filter code generation
    does not share common subexpressions. Here the text is bound once to a
    lambda variable (one evaluation per row) and only the rules up to
    ``label`` are tested, behind the same substring guards: "this rule matches and
    no earlier rule does". A lambda is outside whole-stage codegen; the README has the
    times of both forms.
    """
    labels = [lab for lab, _ in rs.rules]
    if label != rs.default and label not in labels:
        return F.lit(False)

    def pred(x: Column) -> Column:
        if label == rs.default:
            out = F.lit(True)
            for _, terms in rs.rules:
                out = out & ~F.coalesce(_rule_condition(x, rs, terms), F.lit(False))
            return out
        out = None
        for lab, terms in rs.rules:
            c = F.coalesce(_rule_condition(x, rs, terms), F.lit(False))
            if lab == label:
                return c if out is None else (out & c)
            out = ~c if out is None else (out & ~c)
        return F.lit(False)

    return F.exists(F.array(_c(text)), pred)


# --------------------------------------------------------------------------- one scan for many rules
_SPACES = r"\s*"


def _atoms(term: str) -> list[str] | None:
    """A term as plain characters and ``\\s*``; None if it holds other regex syntax."""
    atoms = re.findall(r"\\s\*|.", term)
    return atoms if all(a == _SPACES or not re.match(r"[\\.^$|?*+()\[\]{}]", a) for a in atoms) else None


def _alternation(terms: Sequence[tuple[str, ...]]) -> str:
    """A pattern for any of the terms (as atoms), beginnings shared: the longest of several matches."""
    heads = dict.fromkeys(t[0] for t in terms if t)
    parts = [(a if a == _SPACES else re.escape(a)) + _alternation([t[1:] for t in terms if t and t[0] == a]) for a in heads]
    if not parts:
        return ""
    return parts[0] if len(parts) == 1 and () not in terms else f"(?:{'|'.join(parts)})" + ("?" if () in terms else "")


def _written(term: str) -> str:
    """How a match of a term is looked up: without white space, which ``\\s*`` may match any amount of."""
    return re.sub(r"\s", "", term.replace(_SPACES, ""))


def one_scan(rulesets: Sequence[RuleSet]) -> tuple[str, list[dict[str, int]]] | None:
    """One pattern that finds, at every word start, the longest term of any of the word rule tables, and for each
    table the number of the first rule that such a match (or a shorter term at its start) satisfies. None if
    a table cannot be scanned this way: other match kinds, or regex syntax beyond ``\\s*``.

    Terms may overlap ("partial tear" holds "tear"), so matches are looked at ahead, without being consumed."""
    terms = list(dict.fromkeys(t for rs in rulesets for _, ts in rs.rules for t in ts))
    atoms = [_atoms(t) for t in terms]
    if any(rs.kind != "word" for rs in rulesets) or not all(atoms) or any(not re.match(r"\w.*\w$|\w$", t, re.S) for t in terms):
        return None
    if len({_written(t) for t in terms}) < len(terms):
        return None  # two terms that differ in white space alone
    ranks = []
    for rs in rulesets:
        rank: dict[str, int] = {}
        for t in terms:
            starts = [[i for i, (_, ts) in enumerate(rs.rules) if any(re.match(rf"{x}\b", t.replace(_SPACES, gap)) for x in ts)] for gap in ("", " ")]
            if starts[0] != starts[1]:
                return None  # which shorter terms stand at the start depends on the text
            if starts[0]:
                rank[_written(t)] = min(starts[0])
        ranks.append(rank)
    return rf"\b(?=({_alternation([tuple(a) for a in atoms])})\b)", ranks


def with_labels(df: DataFrame, text: ColumnOrName, **columns: RuleSet) -> DataFrame:
    """``df`` with a label column for each rule table, equal to ``classify(text, table)``, from one scan of the text.

    For long texts and several tables: one regex pass finds the terms that are there, whatever the number of rules;
    a literal map turns each into its rule's number, and the least number is the label. Tables that ``one_scan``
    cannot take are classified one by one."""
    scan = one_scan(list(columns.values()))
    if scan is None:
        return df.select("*", *[classify(text, rs).alias(c) for c, rs in columns.items()])
    pattern, ranks = scan
    found = "_found"
    while found in df.columns:
        found = f"_{found}"
    df = df.withColumn(found, F.regexp_extract_all(_c(text), F.lit(pattern), F.lit(1)))
    if any(re.search(r"\s", t.replace(_SPACES, " ")) for rs in columns.values() for _, ts in rs.rules for t in ts):
        df = df.withColumn(found, F.when(F.size(found) > 0, F.transform(found, lambda m: F.regexp_replace(m, r"\s+", ""))))
    else:
        df = df.withColumn(found, F.when(F.size(found) > 0, F.col(found)))

    def label(rs: RuleSet, rank: dict[str, int]) -> Column:
        numbers = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
        first = F.array_min(F.transform(found, lambda m: F.try_element_at(numbers, m)))
        labels = F.array(*[F.lit(lab) for lab, _ in rs.rules])
        return F.when(F.col(found).isNull(), rs.default).otherwise(F.coalesce(F.get(labels, first), F.lit(rs.default)))

    kept = [c for c in df.columns if c != found]
    return df.select(*[F.col(f"`{c}`") for c in kept],
                     *[(label(rs, rank) if rank else F.lit(rs.default)).alias(c) for (c, rs), rank in zip(columns.items(), ranks)])


# ---------------------------------------------------------------------------
# The rule tables. Labels, terms and their order must stay
# exactly as listed; the order is the evaluation order.
# ---------------------------------------------------------------------------

# Severity, star-ETL variant (text = Injury_Type + Notes).
SEVERITY_ETL = RuleSet(
    "severity_etl",
    (
        ("HIGH", ("surgery", "repair", "fracture", "broken", "rupture", "torn", "tear")),
        ("MEDIUM", (r"grade\s*2", r"grade\s*iii", "partial tear", "dislocation")),
        ("LOW", ("sprain", "strain", "soreness", "contusion", "bruise", "tightness")),
    ),
    "UNKNOWN",
)

# Severity, analysis variant (adds "surgical"); used on Injury_Type + Notes by the
# pre-incident window analysis and on Notes alone by the yearly report.
SEVERITY = RuleSet(
    "severity",
    (
        ("HIGH", ("surgery", "surgical", "repair", "fracture", "broken", "rupture", "torn", "tear")),
        ("MEDIUM", (r"grade\s*2", r"grade\s*iii", "partial tear", "dislocation")),
        ("LOW", ("sprain", "strain", "soreness", "contusion", "bruise", "tightness")),
    ),
    "UNKNOWN",
)

# Body region, star-ETL variant.
REGION_ETL = RuleSet(
    "region_etl",
    (
        ("HEAD", ("concussion", "head", "skull")),
        ("NECK", ("neck", "cervical")),
        ("SHOULDER", ("shoulder", "rotator cuff", "clavicle")),
        ("ELBOW", ("elbow", "ulna", "humerus")),
        ("WRIST", ("wrist", "carpal")),
        ("HAND", ("hand", "thumb", "finger", "metacarp")),
        ("CHEST", ("chest", "rib", "sternum")),
        ("BACK", ("back", "lumbar", "spine")),
        ("HIP", ("hip", "pelvis")),
        ("GROIN", ("groin", "adductor")),
        ("HAMSTRING", ("hamstring",)),
        ("QUAD", ("quad", "quadricep")),
        ("CALF", ("calf", "achilles")),
        ("KNEE", ("knee", "acl", "mcl", "meniscus", "patella")),
        ("ANKLE", ("ankle",)),
        ("FOOT", ("foot", "toe", "plantar")),
    ),
    "OTHER",
)

# Body region, report variant.
REGION_REPORT = RuleSet(
    "region_report",
    (
        ("HEAD", ("head", "concussion", "face", "eye", "nose", "ear", "jaw", "mouth", "tooth")),
        ("NECK", ("neck",)),
        ("SHOULDER", ("shoulder", "collarbone", "clavicle")),
        ("ELBOW", ("elbow",)),
        ("WRIST", ("wrist",)),
        ("HAND", ("hand", "finger", "thumb")),
        ("CHEST", ("chest", "rib", "sternum")),
        ("BACK", ("back", "spine", "spinal")),
        ("HIP", ("hip",)),
        ("GROIN", ("groin",)),
        ("HAMSTRING", ("hamstring",)),
        ("QUAD", ("quad", "quadricep")),
        ("CALF", ("calf", "achilles")),
        ("KNEE", ("knee", "acl", "mcl", "meniscus", "patella")),
        ("ANKLE", ("ankle",)),
        ("FOOT", ("foot", "toe", "plantar")),
    ),
    "OTHER",
)

# Injury category (type-level rollup), star-ETL.
CATEGORY = RuleSet(
    "category",
    (
        ("CONCUSSION", ("concussion",)),
        ("FRACTURE", ("fracture", "broken")),
        ("SPRAIN_STRAIN", ("sprain", "strain")),
        ("TEAR_RUPTURE", ("tear", "torn", "rupture")),
        ("CONTUSION", ("contusion", "bruise")),
    ),
    "OTHER",
)

# Injury type by keyword containment on the notes; label = capitalised keyword.
INJURY_TYPE = RuleSet(
    "injury_type",
    (
        ("Fracture", ("fracture",)),
        ("Sprain", ("sprain",)),
        ("Tear", ("tear",)),
        ("Torn", ("torn",)),
        ("Strain", ("strain",)),
        ("Break", ("break",)),
        ("Contusion", ("contusion",)),
        ("Surgery", ("surgery",)),
        ("Dislocation", ("dislocation",)),
        ("Bruise", ("bruise",)),
        ("Soreness", ("soreness",)),
        ("Procedure", ("procedure",)),
        ("Inflammation", ("inflammation",)),
        ("Rupture", ("rupture",)),
    ),
    "Other",
    kind="contains",
)

# Play type, window-analysis variant (text = description + actionType).
PLAY_TYPE_WINDOW = RuleSet(
    "play_type_window",
    (
        ("DUNK", ("dunk",)),
        ("LAYUP", ("layup",)),
        ("DRIVE", ("drive",)),
        ("THREE_POINTER", ("3pt", "3-pt", "three point", "3-point")),
        ("JUMP_SHOT", ("jump shot", "jumper", "pullup")),
        ("REBOUND", ("rebound",)),
        ("BLOCK", ("block",)),
        ("FOUL", ("foul",)),
    ),
    "OTHER",
    kind="contains",
)

# Play type, report variant (text = description + actionType + subType).
PLAY_TYPE_REPORT = RuleSet(
    "play_type_report",
    (
        ("DUNK", ("dunk",)),
        ("LAYUP", ("layup",)),
        ("THREE_POINTER", ("3pt", "3-pt", "three point", "3-point")),
        ("JUMP_SHOT", ("jump shot", "jumper")),
        ("REBOUND", ("rebound",)),
        ("BLOCK", ("block",)),
        ("FOUL", ("foul",)),
    ),
    "OTHER",
    kind="contains",
)

RULESETS = {rs.name: rs for rs in (SEVERITY_ETL, SEVERITY, REGION_ETL, REGION_REPORT,
                                   CATEGORY, INJURY_TYPE, PLAY_TYPE_WINDOW, PLAY_TYPE_REPORT)}

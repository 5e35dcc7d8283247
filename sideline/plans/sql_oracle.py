"""SQL (DuckDB dialect) building blocks for the oracle twins of the registered queries.

Only phrase tables are shared with the Spark side; every operator, the rule tables
included, is re-stated in SQL independently.
"""

from __future__ import annotations

from ..functions.rules import RuleSet

# The rule tables once more, written out by hand from their definition as SQL
# patterns (label, pattern; then the default label), so that a wrong term on either side shows.
WORD_RULES = {
    "severity_etl": ((
        ("HIGH", r"surgery|repair|fracture|broken|rupture|torn|tear"),
        ("MEDIUM", r"grade\s*2|grade\s*iii|partial tear|dislocation"),
        ("LOW", r"sprain|strain|soreness|contusion|bruise|tightness"),
    ), "UNKNOWN"),
    "severity": ((
        ("HIGH", r"surgery|surgical|repair|fracture|broken|rupture|torn|tear"),
        ("MEDIUM", r"grade\s*2|grade\s*iii|partial tear|dislocation"),
        ("LOW", r"sprain|strain|soreness|contusion|bruise|tightness"),
    ), "UNKNOWN"),
    "region_etl": ((
        ("HEAD", r"concussion|head|skull"),
        ("NECK", r"neck|cervical"),
        ("SHOULDER", r"shoulder|rotator cuff|clavicle"),
        ("ELBOW", r"elbow|ulna|humerus"),
        ("WRIST", r"wrist|carpal"),
        ("HAND", r"hand|thumb|finger|metacarp"),
        ("CHEST", r"chest|rib|sternum"),
        ("BACK", r"back|lumbar|spine"),
        ("HIP", r"hip|pelvis"),
        ("GROIN", r"groin|adductor"),
        ("HAMSTRING", r"hamstring"),
        ("QUAD", r"quad|quadricep"),
        ("CALF", r"calf|achilles"),
        ("KNEE", r"knee|acl|mcl|meniscus|patella"),
        ("ANKLE", r"ankle"),
        ("FOOT", r"foot|toe|plantar"),
    ), "OTHER"),
    "region_report": ((
        ("HEAD", r"head|concussion|face|eye|nose|ear|jaw|mouth|tooth"),
        ("NECK", r"neck"),
        ("SHOULDER", r"shoulder|collarbone|clavicle"),
        ("ELBOW", r"elbow"),
        ("WRIST", r"wrist"),
        ("HAND", r"hand|finger|thumb"),
        ("CHEST", r"chest|rib|sternum"),
        ("BACK", r"back|spine|spinal"),
        ("HIP", r"hip"),
        ("GROIN", r"groin"),
        ("HAMSTRING", r"hamstring"),
        ("QUAD", r"quad|quadricep"),
        ("CALF", r"calf|achilles"),
        ("KNEE", r"knee|acl|mcl|meniscus|patella"),
        ("ANKLE", r"ankle"),
        ("FOOT", r"foot|toe|plantar"),
    ), "OTHER"),
    "category": ((
        ("CONCUSSION", r"concussion"),
        ("FRACTURE", r"fracture|broken"),
        ("SPRAIN_STRAIN", r"sprain|strain"),
        ("TEAR_RUPTURE", r"tear|torn|rupture"),
        ("CONTUSION", r"contusion|bruise"),
    ), "OTHER"),
}
SUBSTRING_RULES = {
    "injury_type": ((
        ("Fracture", r"fracture"), ("Sprain", r"sprain"), ("Tear", r"tear"), ("Torn", r"torn"),
        ("Strain", r"strain"), ("Break", r"break"), ("Contusion", r"contusion"), ("Surgery", r"surgery"),
        ("Dislocation", r"dislocation"), ("Bruise", r"bruise"), ("Soreness", r"soreness"),
        ("Procedure", r"procedure"), ("Inflammation", r"inflammation"), ("Rupture", r"rupture"),
    ), "Other"),
    "play_type_window": ((
        ("DUNK", r"dunk"), ("LAYUP", r"layup"), ("DRIVE", r"drive"),
        ("THREE_POINTER", r"3pt|3-pt|three point|3-point"), ("JUMP_SHOT", r"jump shot|jumper|pullup"),
        ("REBOUND", r"rebound"), ("BLOCK", r"block"), ("FOUL", r"foul"),
    ), "OTHER"),
    "play_type_report": ((
        ("DUNK", r"dunk"), ("LAYUP", r"layup"),
        ("THREE_POINTER", r"3pt|3-pt|three point|3-point"), ("JUMP_SHOT", r"jump shot|jumper"),
        ("REBOUND", r"rebound"), ("BLOCK", r"block"), ("FOUL", r"foul"),
    ), "OTHER"),
}

# Word characters for a Unicode-aware word boundary (letters, decimal digits,
# non-spacing marks, underscore). RE2's \b is ASCII-only, so whole-text rules
# over non-ASCII prose are matched with explicit boundary classes instead.
_WORD = r"\pL\p{Nd}\p{Mn}_"


def sql_classify(text: str, rs: RuleSet, unicode_words: bool = False) -> str:
    """CASE expression of the rule table of that name (nothing else of ``rs`` is used)."""
    words = rs.name in WORD_RULES
    rules, default = WORD_RULES[rs.name] if words else SUBSTRING_RULES[rs.name]
    parts = []
    for label, alt in rules:
        if not words:
            pat = f"({alt})"
        elif unicode_words:
            pat = rf"(^|[^{_WORD}])({alt})([^{_WORD}]|$)"
        else:
            pat = rf"\b({alt})\b"
        parts.append(f"WHEN regexp_matches({text}, '{pat}') THEN '{label}'")
    return f"(CASE {' '.join(parts)} ELSE '{default}' END)"


def sql_text_of(*cols: str) -> str:
    return f"lower(concat_ws(' ', {', '.join(cols)}))"


def sql_title(expr: str) -> str:
    """Python-style title case of stripped text."""
    stripped = rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"
    runs = rf"regexp_extract_all({stripped}, '([\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def sql_initial_last(expr: str) -> str:
    parts = f"string_split({expr}, ' ')"
    return (f"(CASE WHEN length({parts}[1]) > 0 "
            f"THEN substr({parts}[1], 1, 1) || '. ' || {parts}[-1] END)")


def sql_last_token(expr: str) -> str:
    stripped = rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"
    return rf"(regexp_split_to_array({stripped}, '\s+')[-1])"


def sql_pct(share: str) -> str:
    return f"(round_even(CAST({share} AS DOUBLE) * 100.0 * 100.0, 0) / 100.0)"


def sql_date_any(expr: str, formats: tuple[str, ...] = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y")) -> str:
    return "CAST(coalesce(" + ", ".join(f"try_strptime({expr}, '{f}')" for f in formats) + ") AS DATE)"

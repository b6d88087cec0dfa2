"""Disposition classifiers: tables of patterns and precedence, compiled to one conditional expression each."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.functions import dates
from docketeer.functions.text import blank, let

OUTCOMES = ("granted", "denied", "continued", "off_calendar", "appearance_required", "other")


def _branches(pattern: str) -> list[str]:
    """The alternatives of a pattern outside of groups."""
    out, depth = [""], 0
    for piece in re.findall(r"\\.|\[[^]]*\]|.", pattern, re.S):
        depth += (piece == "(") - (piece == ")")
        if piece == "|" and not depth:
            out.append("")
        else:
            out[-1] += piece
    return out


@lru_cache(maxsize=None)
def needed(pattern: str) -> tuple[str, ...]:
    """Plain texts of which every match of the pattern has at least one; none where that can't be told.

    Each branch gives its longest stretch of letters and blanks outside of groups; a word with an ending that must be
    one of a list, as in den(?:ied|ies|y), gives each of its forms."""
    out = []
    for branch in _branches(pattern):
        branch = re.sub(r"\\.|\[[^]]*\]", "\x00", branch)
        forms = re.search(r"([a-z]{3,})\(\?:([a-z]+(?:\|[a-z]+)*)\)(?![?*{])", branch)
        if forms:
            out += [forms[1] + ending for ending in forms[2].split("|")]
            continue
        while branch != (branch := re.sub(r"\([^()]*\)", "\x01", branch)):
            pass
        out.append(max(re.findall(r"[a-z ]+", re.sub(r"[a-z ][?*{]", "\x00", branch)), key=len, default=""))
    return tuple(dict.fromkeys(out)) if min(map(len, out)) > 2 else ()


def _first(pattern: str) -> set[str]:
    """The letters that a match can start with; none where that can't be told."""
    out = set()
    for branch in _branches(pattern):
        rest = re.sub(r"^(?:\\b)+", "", branch)
        group = re.match(r"\(\?:((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)(\?)?", rest)
        if group:
            found = [_first(group[1])] + ([_first(rest[group.end() :])] if group[2] else [])
        else:
            found = [{rest[0]}] if re.match(r"[a-z](?![?*{])", rest) else [set()]
        if not all(found):
            return set()
        out |= set().union(*found)
    return out


@lru_cache(maxsize=None)
def quick(pattern: str) -> str:
    """The same pattern, with a look at the next letter before all else: word boundaries at every character are slow."""
    letters = "".join(sorted(_first(pattern)))
    return f"(?=[{letters}])(?:{pattern})" if letters else pattern


def has(small: Column, pattern: str, plain: Callable[[str], Column] | None = None) -> Column:
    """Whether lower-cased text has the pattern.  An expression is tried at every character, which is slow; texts that lack
    all of its plain texts are told by these alone (plain: whether the text has one)."""
    texts = [plain(x) if plain else F.contains(small, F.lit(x)) for x in needed(pattern)]
    found = small.rlike(quick(pattern))
    return _any(texts) & found if texts else found


def _any(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out | c
    return out


@dataclass(frozen=True)
class Rules:
    """Patterns by outcome on lower-cased text, the order in which they are tried, and patterns that veto an outcome.

    xor: granted and denied together are "other" (else the one earlier in the order wins).
    """

    patterns: dict[str, str]
    order: tuple[str, ...]
    veto: dict[str, str] = field(default_factory=dict)
    conditional: str = "absent objection"
    xor: bool = False

    def hit(self, test: Callable[[str], Column], outcome: str) -> Column:
        """Whether text has the outcome's patterns; test tells whether it has one."""
        found = test(self.patterns[outcome])
        if outcome in self.veto:
            found = found & ~test(self.veto[outcome])
        if self.xor and outcome in ("granted", "denied"):
            found = found & ~test(self.patterns["denied" if outcome == "granted" else "granted"])
        return found

    def tested(self, test: Callable[[str], Column]) -> Column:
        """The outcome of text that has the patterns that test tells."""
        out = F.lit("other")
        for outcome in reversed(self.order):
            out = F.when(self.hit(test, outcome), outcome.partition(":")[0]).otherwise(out)
        return out

    def outcome_of(self, small: Column) -> Column:
        """The outcome of text that is lower-cased and not null."""
        return self.tested(lambda pattern: has(small, pattern))

    def outcome(self, text: Column) -> Column:
        return let(F.lower(blank(text)), self.outcome_of)

    def is_conditional(self, text: Column) -> Column:
        return let(F.lower(F.coalesce(text, F.lit(""))), lambda small: has(small, self.conditional))

    def continued_to(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        continued = (lambda small: F.contains(small, F.lit("continued"))) if self.xor else lambda small: self.hit(lambda pattern: has(small, pattern), "continued")
        return F.when(let(F.lower(text), continued), dates.continued_to(text))

    def sql_outcome(self, text: str) -> str:
        """The same in SQL for an engine with RE2 expressions; text: an SQL expression that isn't null."""
        test = lambda pattern: f"regexp_matches(lower({text}), '{pattern.replace(chr(39), chr(39) * 2)}')"
        cases = []
        for outcome in self.order:
            found = test(self.patterns[outcome])
            if outcome in self.veto:
                found += f" AND NOT {test(self.veto[outcome])}"
            if self.xor and outcome in ("granted", "denied"):
                found += f" AND NOT {test(self.patterns['denied' if outcome == 'granted' else 'granted'])}"
            cases.append(f"WHEN {found} THEN '{outcome.partition(':')[0]}'")
        return "CASE " + " ".join(cases) + " ELSE 'other' END"


# The phrases that each court's rulings use.
_DENY = r"\bden(?:ied|ies|y)\b|\bdismiss(?:ed|es)?\b"
_DENY_PAST = r"\bdenied\b|\bdenies\b|\bdismissed?\b"
_GRANT = r"\bgrant(?:ed|s)?\b|\bsustained\b|\bapproved\b"
_GRANT_SOME = r"\bgranted?\b|\bsustained\b"
_GRANT_APPROVE = r"\bgranted?\b|\bsustained\b|\bapproved\b"
_OFF = r"\boff\s+calendar\b|\bvacated\b|\bdropped\s+from\b"
_APPEAR = r"\bappearances?\s+(?:are\s+)?(?:required|necessary)\b"
_APPEAR_ASKED = r"\bappearances?\s+(?:are\s+)?(?:required|requested|necessary)\b"
_APPEAR_ONE = r"\bappearance\s+(?:is\s+)?(?:required|necessary)\b|\bappearances?\s+required\b"
_NO_APPEAR = r"no\s+appearance\s+(?:is\s+)?(?:required|necessary)"
_DGCOA = ("denied", "granted", "continued", "off_calendar", "appearance_required")
_DGCAO = ("denied", "granted", "continued", "appearance_required", "off_calendar")


def _table(denied: str, granted: str, continued: str, off_calendar: str, appearance: str, order: tuple[str, ...] = _DGCOA, **more) -> Rules:
    return Rules({"denied": denied, "granted": granted, "continued": continued, "off_calendar": off_calendar, "appearance_required": appearance}, order, **more)


SHARED = Rules(
    {
        "off_calendar": r"off[ -]calendar",
        "continued": r"continued",
        "appearance_required": r"appearance required|appearance is required|appearance ordered|parties shall appear|parties are ordered to appear",
        "granted": r"\bgrant(?:ed|s|ing)?\b|\bsustain(?:ed|s)?\b|\brecommended\s+for\s+approval\b",
        "denied": r"\bden(?:y|ied|ies)\b|\boverrule(?:d|s)?\b",
    },
    ("off_calendar", "continued", "appearance_required", "granted", "denied"),
    conditional=r"\b(?:absent|unless|if)\b.{0,80}\bobjection",
    xor=True,
)

COUNTY_RULES: dict[str, Rules] = {
    "amador": Rules(
        {
            "denied": _DENY_PAST,
            "granted": _GRANT_SOME,
            "continued": r"\bcontinued to\b|\bhearing (?:is )?continued\b|\bis continued for\b|\bmatter is continued\b",
            "off_calendar": _OFF,
            "appearance_required:none": r"there is no tentative ruling|no tentative ruling issued",
            "appearance_required": _APPEAR + r"|\bordered to appear\b|\bappear personally\b",
        },
        ("denied", "granted", "continued", "off_calendar", "appearance_required:none", "appearance_required"),
        veto={"appearance_required": r"no appearances? necessary"},
    ),
    "calaveras": _table(_DENY, _GRANT, r"\bcontinued\s+to\b|\bcontinued\s+osc\b|\bis\s+continued\b", _OFF, _APPEAR),
    "contra_costa": _table(r"\bdenied\b|\bdenies\b|\bdismisses?\b", _GRANT_SOME, r"\bcontinued to\b|\bhearing (?:is )?continued\b", r"(?m)^\s*vacated\b|\bvacated\.|\boff\s+calendar\b|\bdropped\s+from\b", r"\bappearance\s+required\b|\bhearing\s+required\b"),
    "el_dorado": _table(r"\bdenied\b|\bdismisses\b", r"\bgranted\b", r"\bcontinued to\b|\bhearing continued\b|\bcontinues the matter\b", r"\boff calendar\b|\bdropped from (?:the )?calendar\b", r"\bappearances are required\b", _DGCAO),
    "fresno": _table(_DENY, _GRANT, r"\bcontinued\s+to\b|\bis\s+continued\b", r"\boff\s+calendar\b|\bvacated\b", _APPEAR_ASKED),
    "merced": _table(_DENY, _GRANT, r"\bcontinued\s+to\b|\bis\s+continued\b|\bmatter\s+continued\b", _OFF, _APPEAR_ONE, veto={"appearance_required": _NO_APPEAR}),
    "nevada": _table(
        r"\bden(?:ied|ies)\b|\bdismiss(?:ed|es)?\b",
        _GRANT_APPROVE,
        r"\b(?:is\s+|hereby\s+)?continued\s+(?:on|to|until)\b|\bcontinues\s+(?:the\s+(?:matter|case\s+management|hearing)|(?:this\s+|the\s+)?cmc)\b|\bmatter\s+is\s+continued\b",
        _OFF,
        r"\bappearances?\s+(?:are\s+)?required\b|\bappear(?:ance)?\s+(?:is\s+)?required\b|\bpersonal\s+appearance\b",
        ("continued", "off_calendar", "denied", "granted", "appearance_required"),
        veto={"appearance_required": r"\bno\s+appearances?\s+(?:are\s+)?(?:necessary|required)\b|\bappearance\s+is\s+not\s+necessary\b"},
    ),
    "orange": _table(_DENY + r"|\bmotion\s+is\s+overruled\b|\bdemurrer\s+is\s+overruled\b", _GRANT_APPROVE, r"\bcontinued\s+to\b|\bmatter\s+is\s+continued\b|\bcontinues\s+the\b", _OFF, _APPEAR + r"|\bordered\s+to\s+appear\b|\bpart(?:y|ies|ie)\s+(?:are\s+)?(?:directed|requested)\s+to\s+appear\b"),
    "placer": _table(_DENY_PAST, _GRANT_SOME, r"\bcontinued to\b|\bhearing (?:is )?continued\b", _OFF, r"\bappearances?\s+(?:are\s+|is\s+)?(?:required|necessary)\b", _DGCAO),
    "plumas": _table(_DENY, _GRANT, r"\bcontinued\s+to\b|\bcontinue\s+to\b|\bis\s+continued\b", _OFF, _APPEAR_ONE, veto={"appearance_required": _NO_APPEAR}),
    "riverside": _table(_DENY, _GRANT, r"\bcontinued\s+to\b|\bcontinues\s+the\b|\bis\s+continued\b", r"\boff\s+calendar\b|\bvacated\b|\bmoot\b", _APPEAR_ASKED + r"|\bno\s+tentative\s+ruling\b"),
    "san_bernardino": _table(_DENY + r"|\boverruled\b", _GRANT, r"\bcontinued\s+to\b|\bsets?\s+the\s+case\b|\bosc\s+re:\s+status\b", r"\boff\s+calendar\b|\bvacated\b|\bmoot\b", _APPEAR_ASKED + r"|\bwill\s+hear\s+argument\b"),
    "san_francisco": _table(_DENY + r"|\bdisallowed\b", _GRANT_APPROVE, r"\bcontinued\s+to\b|\bmatter\s+is\s+continued\b|\bcontinues\s+the\b|\bhearing\s+(?:is\s+)?continued\b", _OFF, _APPEAR + r"|\bappear(?:ance)?\s+is\s+required\b|\bparties\s+are\s+ordered\s+to\s+appear\b"),
    "santa_clara": _table(_DENY + r"|\bmotion\s+is\s+overruled\b|\bdemurrer\s+is\s+overruled\b", _GRANT_APPROVE, r"\bcontinued\s+to\b|\bcontinued\s+for\b|\bhearing\s+(?:is|must)\s+(?:be\s+)?continued\b|\bmatter\s+is\s+continued\b", _OFF, _APPEAR + r"|\bordered\s+to\s+come\s+to\s+the\s+hearing\b|\bordered\s+to\s+appear\b"),
    "shasta": _table(_DENY + r"|\bmotion\s+is\s+overruled\b", _GRANT_APPROVE + r"|\bpetition\s+is\s+(?:hereby\s+)?allowed\b", r"\bcontinued\s+to\b|\bcontinues\s+(?:the|this)\b|\bmatter\s+is\s+continued\b", _OFF, _APPEAR + r"|\bappear(?:ance)?\s+(?:is\s+)?(?:necessary|required)\b|\bappear\s+to\s+discuss\b|\bordered\s+to\s+appear\b"),
    "solano": _table(r"\bden(?:ied|ies)\b|\bdismiss(?:ed|es)?\b|\bmotion\s+(?:is\s+)?overruled\b", _GRANT_APPROVE, r"\b(?:is\s+)?continued\s+to\b|\bcontinues\s+the\b|\bcourt\s+continues\b", _OFF, r"\bparties\s+(?:and\s+counsel\s+)?(?:are\s+)?to\s+appear\b|\bappearances?\s+(?:are\s+)?required\b|\bappear\s+for\s+hearing\b"),
    "tuolumne": _table(_DENY, _GRANT, r"\bcontinued\s+to\b|\bset\s+for\s+hearing\b|\bwill\s+be\s+set\b", _OFF, r"\bappearances?\s+(?:are\s+)?(?:required|necessary)\b|\bmust\s+appear\b"),
}

#: Counties whose rulings go by the shared rules.
SHARED_COUNTIES = ("butte", "imperial", "los_angeles", "marin", "monterey", "napa", "san_benito", "san_luis_obispo", "san_mateo", "santa_barbara", "santa_cruz", "sierra", "sonoma", "stanislaus", "tulare", "ventura", "yolo")


def rules_for(county: str) -> Rules:
    return COUNTY_RULES.get(county, SHARED)


def classify_by_county(county: Column, text: Column) -> Column:
    """The outcome by the rules of each row's county."""


    def by_county(small: Column) -> Column:
        out = SHARED.outcome_of(small)
        for name, rules in sorted(COUNTY_RULES.items()):
            out = F.when(county == name, rules.outcome_of(small)).otherwise(out)
        return out

    return let(F.lower(blank(text)), by_county)


def outcomes(rows: DataFrame, text: Column, rules: dict[str, Rules]) -> DataFrame:
    """rows plus the outcome by each of the rules, under its name.  What many rules ask of a text is found once a row."""
    patterns = list(dict.fromkeys(p for r in rules.values() for p in (*r.patterns.values(), *r.veto.values())))
    texts = list(dict.fromkeys(x for p in patterns for x in needed(p)))
    small = F.col("__small")
    plain = {x: F.col(f"__text{i}") for i, x in enumerate(texts)}
    found = {p: F.col(f"__found{i}") for i, p in enumerate(patterns)}
    lowered = rows.select("*", F.lower(blank(text)).alias("__small"))
    read = lowered.select("*", *(F.contains(small, F.lit(x)).alias(f"__text{i}") for i, x in enumerate(texts)))
    tried = read.select(*rows.columns, *(has(small, p, plain.__getitem__).alias(f"__found{i}") for i, p in enumerate(patterns)))
    return tried.select(*rows.columns, *(r.tested(found.__getitem__).alias(name) for name, r in rules.items()))

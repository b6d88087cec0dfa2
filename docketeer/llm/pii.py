"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds.

Every text gets the spans of four base rules (email, ip, card, phone), which always stay.  Generators also propose
looser, overlapping candidates: obfuscated addresses, numbers with other separators or without a plus, dashed and
IPv6 addresses.  Boosted trees score each candidate, and those over their kind's threshold that touch no base span
are added.

Training needs no labels from the base rules: into a bounded sample of documents, each of other values, forms are planted
that the base rules miss (at-signs and dots spelled out, other separators, a number without its plus, IPv6), bare or
behind a cue, and beside them things that only look so (card numbers whose check digit is wrong, dates, times, sums,
sections, identifiers, secrets).  Planted forms are the positive candidates; planted look-alikes and the documents' own
candidates are the negative ones, but for own candidates that keep all of the kind's rules and touch no letter: whether
these are anybody's can't be known, so they are left out, as are all that touch a base span.  One half fits the trees, the
other sets for each kind the lowest threshold with MIN_PRECISION; a kind without positives adds nothing.  Where there
are more candidates than MAX_CANDIDATES, each half's positives and negatives are sampled by a hash of the candidate's
place, the smaller ones of these four groups the least, and what is left of a group weighs as much as all of it when
thresholds are set.

Defined results: null text is empty and has no spans; rows with equal or null doc_id are separate.  Offsets are code points,
end exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketeer.llm import boosting
from docketeer.llm.common import slices, written

KINDS = ("email", "ip", "card", "phone")
#: Documents and candidates that training may see, and the precision that thresholds must keep.
MAX_DOCS, MAX_CANDIDATES, MIN_PRECISION = 4_000, 20_000, 0.98
#: Values planted in a document with so many spaces: forms and look-alikes by turns.
PLANTED = 10

Span = tuple[int, int, int]  # kind number, start, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")  # from a number's first digit alone: else long numbers are read once for each of theirs
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The accepted matches of the four base rules, by kind, then start.

    Emails are found from their at-sign and dotted numbers four parts at a time, which gives the same leftmost
    matches as the plain patterns do but reads each character a bounded number of times.
    """
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _NAME_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    for run in _DOTTED.finditer(text):
        parts = [(m.start(), m.end()) for m in _NUMBER.finditer(text, run.start(), run.end())]
        for i in range(0, len(parts) - 3, 4):
            if all(b - a <= 3 + _zeros(text, a, b) and int(text[b - 3 if b - a > 3 else a : b]) <= 255 for a, b in parts[i : i + 4]):
                found.append((1, parts[i][0], parts[i + 3][1]))
    for match in _CARD.finditer(text):
        digits = _digits(match[0]) if match.end() - match.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, match.start(), match.end()))
    for match in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
            found.append((3, match.start(), match.end()))
    return found


def _zeros(text: str, start: int, end: int) -> int:
    """Leading zeros of a number beyond its last three digits."""
    return len(text[start:end]) - 3 if end - start > 3 and not text[start : end - 3].strip("0") else 0


# --- candidates -----------------------------------------------------------------------------------------------------

_AT = re.compile("@")
_AT_BRACKETED = re.compile(r" ?[\[(]at[\])] ?")
_AT_WORD = re.compile(r" at (?=[a-zA-Z0-9-]+(?: dot |\.[a-zA-Z]| ?[\[(]dot[\])]))")
_FAR = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| dot | ?[\[(]dot[\])] ?)[A-Za-z0-9-]+)+")
_RUN = re.compile(r"[+(]?[0-9](?:[ ().\-/]*[0-9])+")
#: Digits that candidates of a kind hold, at least and at most.
_WINDOWS = ((2, 12, 20), (3, 7, 16))
_QUAD = re.compile(r"[0-9]{1,3}(?:[.\-][0-9]{1,3}){3}")
_V6 = re.compile(r"(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}")


def _number_windows(text: str, start: int, end: int) -> Iterator[Span]:
    """Of a run of digits and separators the whole where it has few enough digits for the kind, else from each of its
    numbers on the longest stretch that has."""
    numbers = [(m.start(), m.end()) for m in _NUMBER.finditer(text, start, end)]
    total = sum(b - a for a, b in numbers)
    for kind, low, high in _WINDOWS:
        if total <= high:
            if total >= low:
                yield kind, start, end
            continue
        upto = held = 0
        for i, (a, b) in enumerate(numbers):
            if upto <= i:
                upto, held = i, 0
            while upto < len(numbers) and held + numbers[upto][1] - numbers[upto][0] <= high:
                held += numbers[upto][1] - numbers[upto][0]
                upto += 1
            if held >= low and (i == 0 or upto == len(numbers) or numbers[upto][0] > numbers[upto - 1][1]):
                yield kind, a - (a > start and text[a - 1] in "+("), numbers[upto - 1][1]
            held -= b - a if upto > i else 0


def candidates(text: str) -> list[Span]:
    """Proposed spans; they may overlap, and a stretch may be proposed for several kinds."""
    found: set[Span] = set()
    marks = [*_AT.finditer(text), *_AT_WORD.finditer(text)]
    if "at]" in text or "at)" in text:
        marks += _AT_BRACKETED.finditer(text)
    for mark in marks:
        near = mark.start()
        while near and text[near - 1] in _NAME_CHARS:
            near -= 1
        far = _FAR.match(text, mark.end())
        if near < mark.start() and far:
            found.add((0, near, far.end()))
    for match in _RUN.finditer(text):
        found.update(_number_windows(text, match.start(), match.end()))
    for pattern in (_QUAD, _V6) if text.count(":") > 2 else (_QUAD,):
        found |= {(1, m.start(), m.end()) for m in pattern.finditer(text)}
    return sorted(found)


_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
FEATURES = ("is_email", "is_ip", "is_card", "is_phone", "length", "digits", "letters", "separators", "groups", "longest", "shortest", "plus", "at_sign", "dots", "hyphens", "spaces", "colons", "luhn", "octets", "before", "after", "word_before", "colon_before", "digits_around", "bars_around", "cue", "year", "last")


#: Words before a value that tell its kind, in the order of KINDS.
_CUE_WORDS = tuple(re.compile(rf"(?i)\b(?:{words})\W*\Z") for words in ("e-?mail|write to|contact", "ip|host|address|server", "card|card no|card number|visa|mastercard", "tel|phone|fax|call|mobile"))


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    inside, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 24]
    numbers = _NUMBER.findall(inside) or [""]
    digits = "".join(numbers)
    kind_of = lambda c: 0.0 if not c else 1.0 if c.isspace() else 3.0 if c.isalnum() else 2.0
    word = before.rstrip().rpartition(" ")[2]
    return [
        *(float(kind == k) for k in range(4)),
        len(inside),
        len(digits),
        sum(c.isalpha() for c in inside),
        sum(not c.isalnum() for c in inside),
        len(numbers),
        max(map(len, numbers)),
        min(map(len, numbers)),
        inside.startswith("+"),
        "@" in inside,
        inside.count("."),
        inside.count("-"),
        inside.count(" "),
        inside.count(":"),
        12 <= len(digits) <= 19 and luhn(digits),
        len(numbers) == 4 and all(int(x or 0) <= 255 for x in numbers),
        kind_of(before[-1:]),
        kind_of(after[:1]),
        len(word),
        word.endswith((":", "=")),
        sum(c.isdigit() for c in before + after),
        (before + after).count("|"),
        next((1.0 + k for k, cue in enumerate(_CUE_WORDS) if cue.search(before)), 0.0),
        any(1900 <= int(n[:4]) < 2040 for n in numbers if len(n) in (4, 14)),
        len(inside) - len(inside.rstrip(_ALNUM)),
    ]


# --- planted forms --------------------------------------------------------------------------------------------------

_SYLLABLES = ("an", "be", "co", "di", "el", "fa", "go", "hu", "in", "ka", "lo", "mi", "no", "or", "pe", "ru", "sa", "to", "ul", "vi")
#: What may stand before a value, by kind; most values stand without.
_CUES = (("mail", "e-mail:", "write to", "contact"), ("ip", "host", "from", "address:"), ("card", "card no.", "visa", "paid with"), ("tel", "tel.", "phone:", "call", "fax"))


def _name(rng: random.Random) -> str:
    return "".join(rng.choices(_SYLLABLES, k=rng.randrange(2, 5)))


def _number(rng: random.Random, n: int) -> str:
    return str(rng.randrange(1, 10)) + "".join(rng.choices("0123456789", k=n - 1))


def _card(rng: random.Random) -> str:
    head = rng.choice("3456") + _number(rng, 14)
    return next(head + c for c in "0123456789" if luhn(head + c))


def planted_form(rng: random.Random, kind: int) -> str:
    """A value of the kind as the base rules don't take it."""
    if kind == 0:
        local = _name(rng) + rng.choice(("", ".", "_")) + rng.choice((_name(rng), str(rng.randrange(1000))))
        at, dot = (" at ", " dot ") if rng.random() < 0.3 else (rng.choice((" [at] ", "[at]", "(at)", " (at) ")), rng.choice((".", "[dot]", "(dot)", " dot ")))
        return local + at + dot.join([_name(rng), *([_name(rng)] if rng.random() < 0.3 else []), rng.choice(("com", "org", "net", "de", "fr", "es"))])
    if kind == 1:
        if rng.random() < 0.5:
            return "-".join(str(rng.randrange(256)) for _ in range(4))
        return ":".join(f"{rng.randrange(1 << 16):x}" for _ in range(8))
    if kind == 2:
        digits, between = _card(rng), rng.choice(("/", ".", "  ", " - "))
        return between.join(digits[i : i + 4] for i in range(0, 16, 4))
    area, first, last = str(rng.randrange(200, 999)), str(rng.randrange(200, 999)), _number(rng, 4)
    return rng.choice((f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}", f"1/{area}/{first}/{last}", f"00{rng.randrange(1, 99)} {area} {first} {last}", f"1 ({area}) {first}-{last}"))


def _mistyped(rng: random.Random) -> str:
    """A card number with one digit wrong, so that its check fails, in one of the usual or unusual ways of writing."""
    digits, at = _card(rng), rng.randrange(16)
    digits = digits[:at] + str((int(digits[at]) + rng.randrange(1, 10)) % 10) + digits[at + 1 :]
    return rng.choice(("", "", " ", "-", "/", ".", "  ", " - ")).join(digits[i : i + 4] for i in range(0, 16, 4))


def look_alike(rng: random.Random) -> str:
    """Something that generators propose and that is nobody's data."""
    year, month, day = rng.randrange(1900, 2040), rng.randrange(1, 13), rng.randrange(1, 29)
    return rng.choice(
        (
            f"{year}-{month:02}-{day:02}",
            f"{day:02}.{month:02}.{year}",
            f"{year}-{year + rng.randrange(1, 30)}",
            f"{year}{month:02}{day:02}{rng.randrange(24):02}{rng.randrange(60):02}{rng.randrange(60):02}",
            ":".join(f"{rng.randrange(60):02}" for _ in range(rng.randrange(4, 6))),
            ".".join(str(rng.randrange(1, 20)) for _ in range(rng.randrange(5, 8))),
            f"{rng.randrange(1, 999)}.{rng.randrange(1000):03}.{rng.randrange(1000):03},{rng.randrange(100):02}",
            " ".join(str(rng.randrange(10, 999)) for _ in range(rng.randrange(4, 9))),
            f"{_name(rng)} = \"{rng.getrandbits(160):040x}\"",
            f"{_name(rng).upper()}{_number(rng, rng.randrange(9, 17))}{rng.choice(_SYLLABLES)}",
            f"look at {_name(rng)} dot {_name(rng)}",
            _mistyped(rng),
            _mistyped(rng),
            f"978-{rng.randrange(10)}-{_number(rng, 2)}-{_number(rng, 6)}-{rng.randrange(10)}",
        )
    )


def planted(text: str, seed: int) -> tuple[str, list[Span], list[tuple[int, int]]]:
    """text with values planted between its words: (text, the spans of the planted forms, places of the look-alikes)."""
    rng = random.Random(seed)
    gaps = [m.start() for m in re.finditer(" ", text)]
    where = sorted(rng.sample(gaps, min(PLANTED, len(gaps)))) if gaps else [len(text)]
    out, spans, others, size, at = [], [], [], 0, 0
    for number, gap in enumerate(where):
        out.append(text[at:gap] + " ")
        size += gap - at + 1
        if number % 2 == 0:
            kind = rng.randrange(4)
            cue = rng.choice(_CUES[kind]) + " " if rng.random() < 0.4 else ""
            form = planted_form(rng, kind)
            spans.append((kind, size + len(cue), size + len(cue) + len(form)))
            value = cue + form
        else:
            value = look_alike(rng)
            others.append((size, size + len(value)))
        out.append(value)
        size, at = size + len(value), gap
    return "".join([*out, text[at:]]), spans, others


# --- model ----------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    trees: boosting.Trees
    thresholds: tuple[float, ...]  # by kind

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Of each text the candidates over their threshold that touch no base span; the best of overlapping ones."""
        where, rows, spans = [], [], []
        for i, (text, own) in enumerate(zip(texts, base, strict=True)):
            for span in candidates(text):
                if self.thresholds[span[0]] <= 1 and not any(s[1] < span[2] and span[1] < s[2] for s in own):
                    where.append(i)
                    rows.append(features(text, span))
                    spans.append(span)
        out: list[list[Span]] = [[] for _ in texts]
        if not rows:
            return out
        p = self.trees.probabilities(np.array(rows, float))
        for k in np.argsort(-p, kind="stable").tolist():
            span, own = spans[k], out[where[k]]
            if p[k] >= self.thresholds[span[0]] and not any(s[1] < span[2] and span[1] < s[2] for s in own):
                own.append(span)
        return [sorted(own) for own in out]


def _matches(span: Span, truth: list[Span]) -> bool:
    """Whether the span is of a true kind and covers most of it."""
    return any(t[0] == span[0] and 2 * (min(t[2], span[2]) - max(t[1], span[1])) > max(t[2] - t[1], span[2] - span[1]) for t in truth)


def _may_be(text: str, span: Span) -> bool:
    """Whether a document's own candidate keeps all rules of its kind, so that nobody can say that it isn't one."""
    kind, start, end = span
    numbers = _NUMBER.findall(text, start, end)
    digits = "".join(numbers)
    if any(c.isalnum() for c in text[start - 1 : start] + text[end : end + 1]):
        return False
    if kind == 1:
        return ":" in text[start:end] or all(int(n) <= 255 for n in numbers)
    return kind == 0 or (13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15 and len(numbers) > 1)


def labelled(text: str, seed: int) -> list[tuple[int, Span, str]]:
    """(label, span, text) of the candidates in a document with planted values."""
    seen, truth, others = planted(text, seed)
    base, out = base_spans(seen), []
    for span in candidates(seen):
        if any(s[1] < span[2] and span[1] < s[2] for s in base):
            continue
        if _matches(span, truth):
            out.append((1, span, seen))
        elif any(s[1] < span[2] and span[1] < s[2] for s in truth) or any(a < span[2] and span[1] < b for a, b in others) or not _may_be(seen, span):
            out.append((0, span, seen))
    return out


def training_rows(docs: DataFrame, limit: int = MAX_DOCS) -> DataFrame:
    """label, half, features and place (a hash) of the candidates of at most limit documents, those with the smallest
    hash of doc_id and text; rows that are equal in both count once."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text", F.lit(3)).alias("h"))
    chosen = rows.select("h").distinct().orderBy("h").limit(limit)
    sample = rows.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("text").alias("text")).select("text", F.pmod(F.col("h"), F.lit(2)).cast("int").alias("half"), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            labels, halves, rows, places = [], [], [], []
            for text, half, h in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for label, span, seen in labelled(text, h):
                    labels.append(label)
                    halves.append(half)
                    rows.append([float(v) for v in features(seen, span)])
                    places.append(int.from_bytes(hashlib.blake2b(repr((h, span)).encode(), digest_size=8).digest(), "little", signed=True))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(halves, pa.int32()), pa.array(rows, pa.list_(pa.float64())), pa.array(places, pa.int64())], names=["label", "half", "features", "place"])

    return sample.mapInArrow(run, "label int, half int, features array<double>, place long")


def shares(counts: dict[tuple[int, int], int], most: int) -> dict[tuple[int, int], int]:
    """How many of each group to keep, `most` in all: the smaller groups whole, the others alike."""
    out = {}
    for left, group in zip(range(len(counts), 0, -1), sorted(counts, key=lambda g: (counts[g], g))):
        out[group] = min(counts[group], (most - sum(out.values())) // left)
    return out


def train(docs: DataFrame, limit: int = MAX_DOCS) -> Model:
    rows = written(training_rows(docs, limit), "candidates")
    counts = {(r["half"], r["label"]): r["count"] for r in rows.groupBy("half", "label").count().collect()}
    if not counts:
        return Model(boosting.Trees(0.0, 3), (2.0,) * 4)
    kept = shares(counts, MAX_CANDIDATES)
    if kept != counts:
        groups = [rows.where((F.col("half") == h) & (F.col("label") == k)).orderBy("place", "features").limit(n) for (h, k), n in sorted(kept.items())]
        rows = reduce(DataFrame.union, groups)
    rows = rows.orderBy("half", "label", F.xxhash64("features"), "features").toPandas()
    x, y, half = np.stack(rows["features"].to_numpy()), rows["label"].to_numpy(), rows["half"].to_numpy()
    trees = boosting.fit(x[half == 0], y[half == 0])
    other = half == 1
    weights = np.array([counts[g] / kept[g] for g in zip(half.tolist(), y.tolist())])[other]
    p = trees.probabilities(x[other])
    return Model(trees, tuple(boosting.threshold_for(p[x[other][:, k] == 1], y[other][x[other][:, k] == 1], MIN_PRECISION, weights=weights[x[other][:, k] == 1]) for k in range(4)))


OUT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """keep columns (doc_id by default) plus OUT."""
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    schema = T.StructType(source.select(*keep).schema.fields + T.StructType.fromDDL(OUT).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for part in slices(batches):
            texts = part.column(len(keep)).to_pylist()
            base = [base_spans(t) for t in texts]
            added = model.added(texts, base)
            counts = [[sum(s[0] == k for s in own) for own in base] for k in range(4)]
            made = [*counts, [hashlib.sha256(_joined(own).encode()).hexdigest() for own in base], [_joined(own + more) for own, more in zip(base, added, strict=True)], [len(more) for more in added]]
            kept = [c.cast(f.type) for c, f in zip(part.columns[: len(keep)], arrow)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(m, f.type) for m, f in zip(made, list(arrow)[len(keep):], strict=True))], schema=arrow)

    return source.mapInArrow(run, schema)


def redact(text: str, spans: list[Span]) -> str:
    """text with each span replaced by its kind in brackets; of overlapping spans the earlier one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
            at = end
    return "".join([*out, text[at:]])


def document_pii(docs: DataFrame) -> DataFrame:
    """The columns of op3_pii: training on a bounded sample, then every whole text."""
    return find(docs, train(docs))

"""Personal data in texts: rules, and a semi-Markov conditional random field for what the rules miss.

The rules find e-mail addresses, IP addresses, card and phone numbers in their usual forms; what they find stays.
Other forms ("jo (at) mail (dot) net", "(743) 555-3824") are found by the field: it scores whole candidate
segments by features of the span as a whole (its numbers of digits, its pattern, the Luhn sum, the words around
it), and dynamic programming over the tokens of a window chooses boundaries and kinds together. Segments have at most
``LONGEST`` tokens and must be of a possible form, so that a window costs time in proportion to its tokens; outside
of windows nothing can be a segment.

The field is learned here from the rules: windows of a bounded sample of documents with what the rules find, in
the form they have and in other forms it may be written in, beside windows without personal data.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.tables import others, with_text
from lamina.llm.words import slices
from lamina.runtime import materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LONGEST = 24  # tokens of a segment
_AROUND = 32  # characters on both sides of a window that features look at
_REACH = 80  # characters on both sides of an at-sign in words that may belong to an address

Span = tuple[int, int, int]  # kind, first character, last character (exclusive)

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY_DIGIT = re.compile(r"[0-9]")
# Digits with what stands between the digits of one number, and at-signs that are spelled out.
_NUMERIC = re.compile(r"[(+\[]{0,2}[0-9](?:[0-9()\[\].+/\-]| (?=[0-9(+\[.\-]))*")
_SPELLED = re.compile(r"[(\[{] ?[aA][tT] ?[)\]}]")
_PLAIN_AT = re.compile(r" [aA][tT] [A-Za-z0-9-]{1,63}(?: [dD][oO][tT] )")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_AT = re.compile(r" ?[(\[{] ?at ?[)\]}] ?| at |@", re.I)
_DOT = re.compile(r" ?[(\[{] ?dot ?[)\]}] ?| dot |\.", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _number(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # By the at-signs: what stands before one is a run of local characters that begins behind the last match.
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            done = domain.end()
            yield first, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    # Chains of numbers and dots, taken four by four.
    for chain in _CHAIN.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        while len(parts) >= 4:
            size = sum(map(len, parts[:4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts[:4]):
                yield at, at + size
            at += size + 1
            parts = parts[4:]


def base_spans(text: str) -> list[Span]:
    """What the rules find, by kind and start.

    Each kind by itself, leftmost matches that do not overlap; a match whose numbers do not fit (parts of an address
    above 255, 13 to 19 digits with a Luhn sum, 9 to 15 digits) is dropped and not tried again otherwise.
    """
    found: list[Span] = [(EMAIL, a, b) for a, b in _emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text):
        found += [(IP, a, b) for a, b in _addresses(text)]
        for m in _DIGITS.finditer(text):
            digits = _number(m[0]) if m.end() - m.start() < 64 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((CARD, m.start(), m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_number(m[0])) <= 15:
                found.append((PHONE, m.start(), m.end()))
    return found


def windows(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Stretches of a text in which segments may lie, apart from each other and from the spans taken."""
    found = []
    if _ANY_DIGIT.search(text):
        for m in _NUMERIC.finditer(text):
            if m.end() - m.start() >= 7:
                found.append((m.start(), m.end()))
    signs = [m.span() for m in _SPELLED.finditer(text)]
    signs += [(m.start(), m.start() + 4) for m in _PLAIN_AT.finditer(text)]
    at = text.find("@")
    held = iter([(a, b) for kind, a, b in taken if kind == EMAIL])
    own = next(held, None)
    while at >= 0:
        while own and own[1] <= at:
            own = next(held, None)
        if not own or at < own[0]:
            signs.append((at, at + 1))
        at = text.find("@", at + 1)
    for a, b in signs:
        # The local part is one run of characters before the sign, the domain what may follow it on its line.
        first = a
        while first > a - _REACH and first > 0 and (text[first - 1] in _LOCAL or (first == a and text[first - 1] == " ")):
            first -= 1
        line = text.find("\n", b, b + _REACH)
        found.append((first, line if line >= 0 else min(len(text), b + _REACH)))
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    # What is left of them between the spans taken.
    parts: list[tuple[int, int]] = []
    cuts = sorted((a, b) for _, a, b in taken)
    at = 0
    for a, b in merged:
        while at < len(cuts) and cuts[at][1] <= a:
            at += 1
        free, i = a, at
        while i < len(cuts) and cuts[i][0] < b:
            if cuts[i][0] > free:
                parts.append((free, cuts[i][0]))
            free = max(free, cuts[i][1])
            i += 1
        if free < b:
            parts.append((free, b))
    return parts


def _form(span: str) -> tuple[int, str] | None:
    """The kind that a segment may be of by its characters alone, and its pattern; None if of none."""
    at = _AT.search(span)
    if at:
        local, domain = span[: at.start()], span[at.end() :]
        labels = _DOT.split(domain)
        if local and all(c in _LOCAL for c in local) and len(labels) > 1 and all(map(_LABEL.fullmatch, labels)):
            dots = {d.strip().lower() for d in _DOT.findall(domain)}
            return EMAIL, at[0].strip().lower() + ",".join(sorted(dots))
        return None
    if not span[-1].isdigit() or not (span[0].isdigit() or span[0] in "+("):
        return None
    digits = _number(span)
    if not 4 <= len(digits) <= 19:
        return None
    pattern = re.sub(r"[0-9]+", "d", span)
    if re.fullmatch(r"d( ?[\[(]?\.[\])]? ?)d(\1d){2}", pattern) and all(int(p) <= 255 for p in _number_parts(span)):
        return IP, pattern
    if len(digits) >= 13 and re.fullmatch(r"d([ ./-]?d)*", pattern):
        return CARD, "".join(sorted(set(pattern) - {"d"}))
    if 7 <= len(digits) <= 15 and re.fullmatch(r"[+(]*d[ ().d/-]*d|d", pattern):
        return PHONE, pattern
    return None


def _number_parts(span: str) -> list[str]:
    return re.findall(r"[0-9]+", span)


def _features(text: str, first: int, last: int, kind: int, pattern: str) -> list[str]:
    """Features of a whole segment, each for its kind."""
    span, name = text[first:last], KINDS[kind]
    before = text[max(0, first - _AROUND) : first]
    behind = text[last : last + 1]
    word = next(iter(_WORD.findall(before)[-1:]), "").lower()
    joint = lambda c: "" if not c else "a" if c.isalnum() else " " if c.isspace() else "."
    out = [f"{name}", f"{name} pattern {pattern}", f"{name} joint {joint(before[-1:])}|{joint(behind)}", f"{name} word {word}"]
    digits = _number(span)
    if kind == EMAIL:
        last_label = re.split(r"[^A-Za-z]+", span)[-1]
        out.append(f"{name} top {pattern if 2 <= len(last_label) <= 4 else 'long'}")
    elif kind == CARD:
        out += [f"{name} luhn {luhn(digits)}", f"{name} digits {len(digits)}"]
    elif kind == PHONE:
        groups = _number_parts(span)
        out += [f"{name} digits {len(digits)}", f"{name} groups {','.join(str(len(g)) for g in groups[-3:])}"]
        out += [f"{name} parts {min(len(groups), 6)}", f"{name} least {min(map(len, groups))}"]
        year = len(groups) > 1 and len(groups[0]) == 4 and groups[0][:2] in ("19", "20")
        out.append(f"{name} year {year}")
    return out


Candidate = tuple[int, int, int, int, int, list[str]]  # tokens from and to, kind, characters from and to, features


def candidates(text: str, first: int, last: int) -> tuple[int, list[Candidate]]:
    """The number of tokens of a window, and all segments of a possible form in it."""
    tokens = [m.span() for m in _TOKEN.finditer(text, first, last)]
    found: list[Candidate] = []
    for i, (a, _) in enumerate(tokens):
        c = text[a]
        if not (c in _LOCAL or c == "("):
            continue
        # A token inside a longer word or number begins nothing.
        if a > 0 and text[a - 1].isalnum() and c.isalnum():
            continue
        digits, sign = 0, False
        for j in range(i, min(len(tokens), i + LONGEST)):
            x, y = tokens[j]
            if j > i and x - tokens[j - 1][1] > 1:
                break
            digits += (y - x) if text[x].isdigit() else 0
            sign |= text[x:y] in ("@", "at", "At", "AT")
            if (digits < 4 and not sign) or not text[y - 1].isalnum() or (y < len(text) and text[y].isalnum() and text[y] != "_"):
                continue
            form = _form(text[a:y])
            if form:
                found.append((i, j + 1, form[0], a, y, _features(text, a, y, *form)))
    return len(tokens), found


@dataclass(frozen=True)
class SpanField:
    """Weights of the features; a field without any finds nothing."""

    weights: dict[str, float]

    def find(self, text: str, taken: list[Span]) -> list[Span]:
        """Segments that the best labelling of the windows of a text has beside the spans taken."""
        if not self.weights:
            return []
        found: list[Span] = []
        for first, last in windows(text, taken):
            n, possible = candidates(text, first, last)
            if not possible:
                continue
            ending: dict[int, list[tuple[int, int, int, int, float]]] = {}
            for i, j, kind, a, b, features in possible:
                score = sum(self.weights.get(f, 0.0) for f in features)
                if score > 0:
                    ending.setdefault(j, []).append((i, kind, a, b, score))
            # The best labelling of the first t tokens, and the segment that ends there if any.
            best, back = [0.0], [None]
            for t in range(1, n + 1):
                value, choice = best[t - 1], None
                for i, kind, a, b, score in ending.get(t, ()):
                    if best[i] + score > value:
                        value, choice = best[i] + score, (i, kind, a, b)
                best.append(value)
                back.append(choice)
            t = n
            while t > 0:
                if back[t] is None:
                    t -= 1
                else:
                    i, kind, a, b = back[t]
                    found.append((kind, a, b))
                    t = i
        return found


# ---------------------------------------------------------------------------------------------------------------
# Learning


def _other_forms(kind: int, span: str) -> list[tuple[str, bool]]:
    """Other forms a span may be written in, and things that look like it; whether each is personal data."""
    if kind == EMAIL:
        local, _, domain = span.partition("@")
        labels = domain.split(".")
        spelled = " dot ".join(labels)
        sentence = " dot ".join([*labels[2:], "there"])  # words, and no top-level domain at the end
        bracketed = domain.replace(".", " (dot) ")
        return [
            (f"{local} (at) {domain}", True), (f"{local} [at] {bracketed.replace('(', '[').replace(')', ']')}", True),
            (f"{local} at {spelled}", True), (f"{local}(at){bracketed}", True), (f"{local} @ {domain}", True),
            (f"{local} at {labels[0]} dot {sentence}", False), (f"{local} (at) {labels[0]}", False),
        ]
    parts = _number_parts(span)
    digits = "".join(parts)
    if kind == IP:
        return [("[.]".join(parts), True), (" . ".join(parts), True), ("(.)".join(parts), True), (".".join(parts[:3]), False)]
    if kind == CARD:
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + int(digits[0]) % 8) % 10)
        return [(".".join(fours), True), ("/".join(fours), True), (wrong, False), (".".join([*fours[:-1], wrong[-4:]]), False)]
    # Phone numbers without the code of the country; dates and plain numbers are none.
    local = parts[1:] if len(parts) > 2 else [digits[-10:-7], digits[-7:-4], digits[-4:]]
    if not all(local):
        return [(digits, False)]
    date = f"20{digits[-2:]}-0{int(digits[-3]) % 9 + 1}-1{digits[-1]} 1{digits[-4]}"
    return [
        (f"({local[0]}) {'-'.join(local[1:])}", True), ("-".join(local), True), (".".join(local), True),
        (digits, False), (date, False), (digits[-7:], False), (" ".join(digits), False),
    ]


@dataclass
class _Example:
    """The candidates of a window and which of them are right."""

    tokens: int
    possible: list[Candidate]
    right: list[bool]


def _examples(snippet: str) -> list[_Example]:
    """Windows of a snippet as it is, and of the snippet with its spans in other forms."""
    taken = base_spans(snippet)
    out = []
    for first, last in windows(snippet, []):
        n, possible = candidates(snippet, first, last)
        right = [(kind, a, b) in taken for _, _, kind, a, b, _ in possible]
        out.append(_Example(n, possible, right))
    for kind, a, b in taken:
        for form, personal in _other_forms(kind, snippet[a:b]):
            text = snippet[:a] + form + snippet[b:]
            others = [(k, x, y) for k, x, y in base_spans(text) if y <= a or x >= a + len(form)]
            for first, last in windows(text, others):
                if first <= a < last or first < a + len(form) <= last:
                    n, possible = candidates(text, first, last)
                    right = [personal and (k, x, y) == (kind, a, a + len(form)) for _, _, k, x, y, _ in possible]
                    out.append(_Example(n, possible, right))
    return [e for e in out if e.possible]


def _fit(examples: list[_Example], rounds: int, ridge: float) -> dict[str, float]:
    """Weights of greatest conditional likelihood of the right labellings, by gradient steps."""
    names: dict[str, int] = {}
    rows, starts = [], [0]
    for e in examples:
        for _, _, _, _, _, features in e.possible:
            rows.extend(names.setdefault(f, len(names)) for f in features)
            starts.append(len(rows))
    flat, cut = np.array(rows), np.array(starts[:-1])
    of = np.repeat(np.arange(len(cut)), np.diff(starts))
    observed = np.concatenate([np.array(e.right, float) for e in examples])
    weights, seen = np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(rounds):
        scores = np.add.reduceat(weights[flat], cut).tolist()
        expected, at = np.empty(len(cut)), 0
        for e in examples:
            own = scores[at : at + len(e.possible)]
            expected[at : at + len(own)] = marginals(e.tokens, [(c[0], c[1]) for c in e.possible], own)
            at += len(own)
        gradient = np.bincount(flat, (observed - expected)[of], minlength=len(names)) - ridge * weights
        seen += gradient**2
        weights += 0.5 * gradient / np.sqrt(seen)
    return {name: float(weights[i]) for name, i in names.items()}


def marginals(tokens: int, segments: list[tuple[int, int]], scores: list[float]) -> list[float]:
    """Chance of each segment in the distribution over all labellings of a window: sets of segments apart.

    A labelling weighs the exponential of the scores of its segments.
    """
    ending: list[list[int]] = [[] for _ in range(tokens + 1)]
    beginning: list[list[int]] = [[] for _ in range(tokens + 1)]
    for k, (i, j) in enumerate(segments):
        ending[j].append(k)
        beginning[i].append(k)
    forward = [0.0] * (tokens + 1)
    for t in range(1, tokens + 1):
        forward[t] = _log_sum([forward[t - 1], *[forward[segments[k][0]] + scores[k] for k in ending[t]]])
    backward = [0.0] * (tokens + 1)
    for t in range(tokens - 1, -1, -1):
        backward[t] = _log_sum([backward[t + 1], *[backward[segments[k][1]] + scores[k] for k in beginning[t]]])
    return [math.exp(forward[i] + s + backward[j] - forward[tokens]) for (i, j), s in zip(segments, scores)]


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit_field(
    docs: DataFrame, sample: int = 600, text_column: str = "text", rounds: int = 30, ridge: float = 0.05
) -> SpanField:
    """A field learned from windows of the documents, ``sample`` different ones at most (by their smallest hash).

    Windows are taken from about ``16 * sample`` documents, chosen by a hash of the text, from more where these have
    too few, and from all of a small table; each comes with at most 32 characters on both sides, so the sample is
    bounded in bytes too. Half of the windows at most have nothing that the rules find. Without any window that has
    something the field finds nothing.
    """
    texts = docs.select(F.col(f"`{text_column}`").alias("text"))
    part = max(1, docs.count() // (16 * sample))
    while True:
        own = texts.where(F.pmod(F.xxhash64("text"), F.lit(part)) == 0)
        drawn = own.mapInArrow(_snippets, "snippet string, has boolean").distinct()
        drawn = materialize(drawn.withColumn("draw", F.xxhash64("snippet")), "field-snippets")
        # Many copies of few texts: more of the texts are taken.
        if part == 1 or drawn.count() >= sample:
            break
        part = max(1, part // 16)
    held: list[str] = []
    for has in (True, False):
        first = drawn.where(F.col("has") == has).orderBy("draw", "snippet").limit(sample // 2)
        held += [row["snippet"] for row in first.collect()]
    examples = [e for s in held for e in _examples(s)]
    return SpanField(_fit(examples, rounds, ridge) if any(any(e.right) for e in examples) else {})


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with what is around them, and whether the rules find something there."""
    for batch in batches:
        for part in slices(batch, "text"):
            snippets, has = [], []
            for text in part.column("text").to_pylist():
                for a, b in windows(text, []) if text else ():
                    if b - a <= 4 * _REACH:
                        snippets.append(text[max(0, a - _AROUND) : b + _AROUND])
                        has.append(bool(base_spans(snippets[-1])))
            yield pa.RecordBatch.from_pydict({"snippet": pa.array(snippets, pa.string()), "has": pa.array(has, pa.bool_())})


# ---------------------------------------------------------------------------------------------------------------

_SPANS = "array<struct<kind:string,start:long,end:long>>"
_ADDED = f"base {_SPANS}, spans {_SPANS}"


def find_personal_data(docs: DataFrame, field: SpanField, text_column: str = "text") -> DataFrame:
    """Every row with ``base``, the spans of the rules, and ``spans``, these and those that the field adds.

    Spans are (kind, start, end), in characters, the end exclusive, by kind in the order of ``KINDS`` and then start.
    Base spans of different kinds may overlap; added ones overlap with nothing. Null and empty texts have none. Repeated
    rows are texts of their own and whole texts are read, whatever their length. An empty table gives no rows. Other
    columns stay as they are; those that are called like an added one, in any case of letters, are replaced.
    """
    added = T._parse_datatype_string(_ADDED)
    kept = others(docs, added.names)
    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)
    texts, name = with_text(docs, kept, text_column)
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, name):
                base, spans = [], []
                for text in part.column(name).to_pylist():
                    rules = base_spans(text) if text else []
                    base.append(rules)
                    spans.append(sorted(rules + field.find(text, rules)) if text else [])
                columns = [part.column(i) for i in range(len(kept))] + [_listed(base), _listed(spans)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(find, schema)


def _listed(spans: list[list[Span]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, spans)]).astype(np.int32)
    flat = [s for own in spans for s in own]
    parts = pa.StructArray.from_arrays(
        [
            pa.array([KINDS[k] for k, _, _ in flat], pa.string()),
            pa.array([a for _, a, _ in flat], pa.int64()),
            pa.array([b for _, _, b in flat], pa.int64()),
        ],
        names=["kind", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(ends), parts)


def joined(spans: str) -> F.Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

"""Personal data: the rules against plain patterns, the field against brute force over labellings."""

import hashlib
import itertools
import math
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute_base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return (
        [(0, *m.span()) for m in EMAIL.finditer(text)]
        + [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        + [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
        + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    )


@settings(max_examples=400, deadline=None)
@given(st.text("a1@.-_+ ()é2", max_size=40))
def test_rules_on_any_text(text):
    assert pii.base_spans(text) == brute_base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "1.2.3.4", "300.1.2.3", ".5", "+1", " ", "-", "x@y.z", "@", "(2)", "000255", "9"]), max_size=12))
def test_rules_on_composed_texts(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute_base(text)


def test_marginals_are_those_of_all_labellings():
    draw = random.Random(1)
    for _ in range(30):
        n = draw.randint(1, 6)
        segments = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if draw.random() < 0.5 for _ in range(draw.randint(1, 2))]
        scores = [draw.uniform(-2, 2) for _ in segments]
        total, each = 0.0, [0.0] * len(segments)
        for chosen in itertools.chain.from_iterable(itertools.combinations(range(len(segments)), r) for r in range(n + 1)):
            if all(segments[a][1] <= segments[b][0] or segments[b][1] <= segments[a][0] for a, b in itertools.combinations(chosen, 2)):
                weight = math.exp(sum(scores[k] for k in chosen))
                total += weight
                for k in chosen:
                    each[k] += weight
        got = pii.marginals(n, segments, scores)
        assert all(abs(a - b / total) < 1e-9 for a, b in zip(got, each))


def best_by_brute_force(field, text, taken):
    """The greatest score that segments apart from each other reach, window by window."""
    total = 0.0
    for first, last in pii.windows(text, taken):
        _, possible = pii.candidates(text, first, last)
        scored = [(i, j, sum(field.weights.get(f, 0.0) for f in fs)) for i, j, _, _, _, fs in possible]
        scored = [s for s in scored if s[2] > 0]
        best = 0.0
        for r in range(4):
            for chosen in itertools.combinations(scored, r):
                if all(a[1] <= b[0] or b[1] <= a[0] for a, b in itertools.combinations(chosen, 2)):
                    best = max(best, sum(s[2] for s in chosen))
        total += best
    return total


def corpus(n=300):
    draw = random.Random(7)
    word = lambda: draw.choice("the quick brown fox jumps over lazy dogs near rivers while mail arrives".split())
    rows = []
    for i in range(n):
        words = [word() for _ in range(draw.randint(5, 60))]
        extra = draw.randrange(8)
        digits = "".join(str(draw.randint(0, 9)) for _ in range(16))
        card = next(digits[:-1] + c for c in "0123456789" if luhn(digits[:-1] + c))
        if extra < 6:
            words.insert(
                draw.randrange(len(words)),
                [
                    f"{word()}.{draw.randint(0, 99)}@mail{draw.randint(1, 9)}.example.com",
                    ".".join(str(draw.randint(1, 255)) for _ in range(4)), card,
                    f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}", digits, str(draw.randint(0, 10**8)),
                ][extra],
            )
        rows.append((i, " ".join(words)))
    return rows


def test_field_finds_other_forms(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    field = pii.fit_field(docs, sample=300)
    assert field.weights
    for text, kind, span in [
        ("please write to jo.doe (at) mail3 (dot) example (dot) org now", "email", "jo.doe (at) mail3 (dot) example (dot) org"),
        ("mail jo at example dot com today", "email", "jo at example dot com"),
        ("call (743) 555-3824 while dogs", "phone", "(743) 555-3824"),
        ("the 743.555.3824 fox", "phone", "743.555.3824"),
        ("paid 4111.1111.1111.1111 over", "card", "4111.1111.1111.1111"),
        ("host 10[.]20[.]30[.]40 near", "ip", "10[.]20[.]30[.]40"),
    ]:
        assert pii.base_spans(text) == []
        found = field.find(text, [])
        assert [(pii.KINDS[k], text[a:b]) for k, a, b in found] == [(kind, span)], text
    # What is no personal data stays alone.
    for text in [
        "no numbers at all", "the year 2024 and 3.14159", "id 7435553824 fox", "on 2024-01-15 10:30 we met", "look at the dot there",
        "number 4111111111111112 fails", "1 2 3 4 5 6 7 8 9 10", "version 1.2.3 and 10.000.000,50", "a@b", "we meet at noon (at) nine",
    ]:
        assert field.find(text, pii.base_spans(text)) == [], text
    for _, text in corpus(80):
        taken = pii.base_spans(text)
        found = field.find(text, taken)
        assert all(b <= x or y <= a for _, a, b in found for _, x, y in taken)
        score = 0.0
        for kind, a, b in found:
            possible = [c for w in pii.windows(text, taken) for c in pii.candidates(text, *w)[1]]
            score += max(sum(field.weights.get(f, 0.0) for f in c[5]) for c in possible if (c[2], c[3], c[4]) == (kind, a, b))
        assert abs(score - best_by_brute_force(field, text, taken)) < 1e-9
    assert pii.fit_field(docs, sample=300) == field


def odd_rows():
    return [
        (1, None), (2, ""), (3, "é@x.y ü+49 (30) 1234567, 1.2.3.4"), (3, "é@x.y ü+49 (30) 1234567, 1.2.3.4"), (None, "a.b@c.d"),
        (4, "1" * 200_000), (5, "a" * 200_000 + "@"), (6, "@" * 2_000), (7, "1.1.1.1." * 500), (8, "(" * 50_000 + "+1((((((" * 500),
        (9, "0 " * 3_000), (10, " ".join(t for _, t in corpus(200))), (11, "\U0001f600 jo@x.org \U0001f600"),
    ]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in odd_rows()], "doc_id long, text string, Spans string, `a.b` int")
    field = pii.fit_field(docs, sample=100)
    found = pii.find_personal_data(docs, field)
    assert found.columns == ["doc_id", "text", "a.b", "base", "spans"]
    rows = found.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        base = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.base]
        spans = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans]
        assert base == brute_base(r.text if r.doc_id not in (4, 5) else "") and set(base) <= set(spans) and spans == sorted(spans)
    nothing = docs.limit(0)
    assert pii.fit_field(nothing).weights == {}
    assert pii.find_personal_data(nothing, field).count() == 0


def test_many_copies_of_few_texts(spark):
    text = "write to jo@example.com or +1 (743) 555-3824"
    docs = spark.range(5000).selectExpr("id AS doc_id", f"'{text}' AS text")
    assert pii.fit_field(docs, sample=10).weights


def test_query_by_brute_force(spark, folder):
    rows = corpus(120) + [(None, "x@y.zz"), (500, None), (501, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_semimarkov_pii"](spark, folder).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = brute_base(text)
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in range(4))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r.spans.split(","))
        assert zlib.crc32(r.spans.encode()) or not listed

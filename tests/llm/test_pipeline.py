"""Every stage of the pipeline, and the whole of it, against plain Python on a small corpus with planted cases."""

import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lamina.llm import mixing, quality
from lamina.llm.queries import DOMAIN_WEIGHTS, quality_model
from tests.llm.test_operators import lowered

SPACED_WORDS, ALNUM_WORDS = rb"[^\x20\x09-\x0D]+", rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_features(text):
    """The features of the passages of a text, word by word."""
    words = [w for w in re.findall(SPACED_WORDS, (text or "").encode())]
    rows = []
    for at in range(0, max(len(words), 1), 64):
        own = words[at : at + 64]
        if not own:
            rows.append([0.0] * 12)
            continue
        lower = [lowered(w.decode(errors="surrogateescape"), SPACED_WORDS)[0] if w.isascii() else w.lower() for w in own]
        n = len(own)
        of = lambda w, test: sum(map(test, w))
        letters = [of(w, lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80) for w in own]
        digits = [of(w, lambda b: 0x30 <= b <= 0x39) for w in own]
        marks = [len(w) - a - d for w, a, d in zip(own, letters, digits)]
        length = max(sum(map(len, own)) / n, 1e-6)
        rows.append([
            len(set(lower)) / n, sum(a == b for a, b in zip(lower, lower[1:])) / n, math.log1p(length),
            of(own, lambda w: len(w) > 20) / n, sum(marks) / n / length, of(marks, lambda m: m > 1) / n, of(marks, lambda m: m > 2) / n,
            of(letters, lambda a: a == 0) / n, sum(digits) / n / length,
            sum(of(w, lambda b: 0x41 <= b <= 0x5A) for w in own) / n / length,
            sum(of(w, lambda b: b >= 0x80) for w in own) / n / length, math.log1p(n),
        ])
    return rows


def brute_score(model, text):
    """Gated attention over the passages, number by number."""
    if model.weights is None:
        return model.constant
    w = {k: v.tolist() if hasattr(v, "tolist") else v for k, v in model.weights.items()}
    times = lambda x, m: [sum(a * row[j] for a, row in zip(x, m)) for j in range(len(m[0]))]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    hidden = []
    for x in brute_features(text):
        x = [(v - m) / s for v, m, s in zip(x, model.mean.tolist(), model.scale.tolist())]
        hidden.append([math.tanh(a + b) for a, b in zip(times(x, w["encode"]), w["encode0"])])
    energy = []
    for h in hidden:
        value, gate = times(h, w["value"]), times(h, w["gate"])
        energy.append(dot([math.tanh(a) / (1 + math.exp(-g)) for a, g in zip(value, gate)], w["attend"]))
    raised = [math.exp(e - max(energy)) for e in energy]
    pooled = [sum(r * h[j] for r, h in zip(raised, hidden)) / sum(raised) for j in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, dot(pooled, w["out"]) + w["out0"]))))


def brute_groups(rows, n=5, num=80, den=100):
    """Of rows linked by shingles, directly or over others, the one of the smallest id stays."""
    sets = []
    for r in rows:
        words = lowered(r["text"], SPACED_WORDS)
        size = min(n, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if find(i) not in best or key < best[find(i)][0]:
            best[find(i)] = key, i
    return [rows[i] for _, i in best.values()]


def brute_cut(rows, items):
    """Spans of item windows cut from the first to the last word; rows of more than half such words go."""
    windows = set()
    for text in items:
        words = lowered(text, ALNUM_WORDS)
        k = min(10, len(words))
        windows |= {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    out = []
    for r in rows:
        raw = (r["text"] or "").encode()
        found = list(re.finditer(rb"[0-9A-Za-z\x80-\xff]+", raw))
        words = lowered(r["text"], ALNUM_WORDS)
        hit = [False] * len(words)
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit[i : i + k] = [True] * k
        if sum(hit) > 0.5 * len(words):
            continue
        keep, at, i = [], 0, 0
        while i < len(words):
            if hit[i]:
                j = i
                while j < len(words) and hit[j]:
                    j += 1
                keep.append(raw[at : found[i].start()])
                at, i = found[j - 1].end(), j
            else:
                i += 1
        if keep:
            text = b"".join([*keep, raw[at:]]).decode()
            r = {**r, "text": text, "n_chars": len(text)}
        out.append(r)
    return out


def brute_shards(rows, n=16):
    """Row by row its shard and slot: groups of equal texts in the order of their digests, the largest shard minimal."""
    sized = [(hashlib.md5(r["text"].encode()).hexdigest() if r["text"] is not None else "", r) for r in rows]
    groups = collections.Counter()
    for key, r in sized:
        groups[key] += len((r["text"] or "").encode()) + 1
    order = sorted(groups)

    def needed(capacity):
        shards, free = 0, 0
        for key in order:
            if groups[key] > capacity:
                return n + 1
            if groups[key] > free:
                shards, free = shards + 1, capacity
            free -= groups[key]
        return shards

    low, high = 1, sum(groups.values())
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= n else (middle + 1, high)
    return low


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    draw = random.Random(11)
    stems = "river stone light walked over under green house small morning winter paper".split()
    prose = lambda n: " ".join(draw.choice(stems) + draw.choice("abcdefghij") + draw.choice(["", "", "", ",", "."]) for _ in range(n))
    items = [prose(draw.randint(12, 30)) for _ in range(6)] + ["", None]
    rows, labels = [], []
    for i in range(140):
        text = prose(draw.randint(40, 160))
        toxic = i % 9 == 4
        if i % 7 == 3:
            text = " ".join(draw.choice(["%%%", "$$$ 12", "WIN!!!!", "###"]) + w for w in text.split())
        elif toxic:
            text = " ".join(w if draw.random() > 0.2 else "nastyword" for w in text.split())
        elif i % 10 == 5:
            words = text.split()
            text = " ".join([*words[:20], items[i % 6], *words[20:]])
        rows.append((i, text))
        labels.append((i, int(i % 7 != 3), int(toxic)))
    clean = [t for i, t in rows if i % 7 != 3 and i % 9 != 4]
    rows += [(200 + i, clean[0]) for i in range(6)]
    rows += [(300 + i, clean[i] + " and " + prose(3)) for i in range(1, 8)]
    rows += [(400, items[0]), (401, None), (402, ""), (402, ""), (3, clean[3]), (None, clean[5])]
    folder = str(tmp_path_factory.mktemp("corpus"))
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def counted(rows):
    return collections.Counter(tuple(sorted(r.items(), key=lambda kv: kv[0])) for r in rows)


def test_every_stage_and_the_whole(spark, corpus, tmp_path):
    folder, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs_after = spark.read.parquet(f"{tmp_path}/{name}")
        after = [r.asDict() for r in docs_after.collect()]
        if name == "quality":
            model = quality_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            scores = {id(r): brute_score(model, r["text"]) for r in before}
            told = {r.text: r.score for r in quality.score_quality(docs, model).collect()}
            assert all(abs(told[r["text"]] - scores[id(r)]) < 1e-3 for r in before)
            assert counted(after) == counted([r for r in before if scores[id(r)] >= 0.3])
            assert len(after) < len(before)
        elif name == "near duplicates":
            # Equal rows of one id are told apart by their places only.
            assert counted(after) == counted(brute_groups(before)) and len(after) < len(before)
        elif name == "decontamination":
            assert counted(after) == counted(brute_cut(before, items)) and counted(after) != counted(before)
        elif name == "mixing":
            labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("domain", mixing.domain_of_labels())
            mixed = mixing.mix(docs, labels, DOMAIN_WEIGHTS, "clean").collect()
            draw = docs.select("doc_id", "text", (F.pmod(F.xxhash64(F.lit("copies"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)).alias("draw"))
            draws = {(r.doc_id, r.text): r.draw for r in draw.collect()}
            rate = rates([(r.n_tokens, [r[f"p_{d}"] for d in DOMAIN_WEIGHTS]) for r in mixed])
            expected = []
            for r, own in zip(mixed, rate):
                assert r.n_tokens == len(lowered(r.text, SPACED_WORDS)) and r.rate == pytest.approx(own, abs=1e-6)
                copies = math.floor(r.rate) + (draws[r.doc_id, r.text] < r.rate - math.floor(r.rate))
                expected += [{k: r[k] for k in before[0]}] * copies
            assert counted(after) == counted(expected)
        else:
            largest = brute_shards(before)
            sizes, slots = collections.Counter(), collections.defaultdict(list)
            for r in after:
                sizes[r["shard"]] += r["size"]
                slots[r["shard"]].append(r["slot"])
                assert r["size"] == len((r["text"] or "").encode()) + 1
            assert max(sizes.values()) == largest and all(sorted(s) == list(range(len(s))) for s in slots.values())
            assert counted([{k: r[k] for k in before[0]} for r in after]) == counted(before)
        docs = docs_after
        outputs[name] = after
    assert counted([r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]) == counted(outputs["sharding"])


def rates(rows, steps=60, tolerance=1e-4):
    """Projected gradient steps over all rows, one by one."""
    weights = list(DOMAIN_WEIGHTS.values())
    total = lambda rate: [sum(r * n * p[d] for r, (n, p) in zip(rate, rows)) for d in range(len(weights))]
    rate = [1.0] * len(rows)
    present = reached = total(rate)
    targets = [w * present[list(DOMAIN_WEIGHTS).index("clean")] / DOMAIN_WEIGHTS["clean"] for w in weights]
    before = math.inf
    for _ in range(steps):
        surplus = [(x - t) / s if s > 0 else 0.0 for x, t, s in zip(reached, targets, present)]
        loss = sum(e * e * s for e, s in zip(surplus, present)) / max(sum(present), 1.0)
        if loss < tolerance**2 or before - loss <= 1e-4 * loss:
            break
        before = loss
        rate = [max(0.0, r - sum(a * e for a, e in zip(p, surplus))) for r, (_, p) in zip(rate, rows)]
        reached = total(rate)
    return rate

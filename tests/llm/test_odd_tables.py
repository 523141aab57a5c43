"""Odd tables that operators must take: copies, letters, names of columns, damaged files."""

import hashlib
import os
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from lamina.llm import decontaminate, fixity, language, mixing, quality, sharding
from lamina.llm.files import new_folder
from tests.llm.test_operators import sentence


def test_only_letters_have_a_language():
    model = language.LanguageModel(["de", "en"], {}, [{}])
    scorer = language.Scorer(model)
    for start in range(0, sys.maxunicode + 1, 64):
        for code in range(start, min(start + 64, sys.maxunicode + 1)):
            if 0xD800 <= code < 0xE000:
                continue
            text = chr(code)
            # Lower case of some signs is another character; what counts is the text as it is.
            if unicodedata.category(text)[0] == "L":
                assert scorer.predict(text)[0] == "de", hex(code)
            else:
                assert scorer.predict(f"{text} {text}")[0] == "und", hex(code)


def test_a_language_of_copies_is_learned(spark):
    german = "der schnelle braune fuchs springt heute über den faulen hund und schläft danach lange ein"
    english = [f"the quick brown fox number {i} jumps over the lazy dog again and sleeps" for i in range(50)]
    rows = [(i, t, "en") for i, t in enumerate(english)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").union(
        spark.range(20_000).select(F.lit(99).cast("long"), F.lit(german), F.lit("de")))
    model = language.fit_language(docs, sample_per_language=20)
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame([(1, "der hund schläft über den fuchs"), (2, "the lazy dog jumps")], "doc_id long, text string")
    assert [r.lang_pred for r in sorted(language.predict_language(asked, model).collect())] == ["de", "en"]


def test_language_is_learned_in_as_many_jobs_for_many_languages(spark):
    def jobs(n):
        rows = [(i, f"word{i % n} other{i % n} third", f"l{i % n:03d}") for i in range(300)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        name = f"languages{n}"
        spark.sparkContext.setJobGroup(name, name)
        model = language.fit_language(docs, sample_per_language=5)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(model.languages) == n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs(30) <= jobs(2) + 1


def test_backoff_by_plain_python(spark):
    """The scores of a text as the method says them, word by word."""
    import math

    rows = [(i, f"{'rot blau' if i % 2 else 'red blue'} {'haus' if i % 2 else 'house'}", "de" if i % 2 else "en") for i in range(20)]
    model = language.fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), longest=3)
    for text in ("red haus", "rotes", "blueberry rot", "zzz", "red zzz häuser"):
        total = [0.0, 0.0]
        for word in text.split():
            known = model.words.get(word)
            for n, grams in zip((3, 2, 1), model.grams):
                if known is not None:
                    break
                padded = f" {word} "
                found = [grams[g] for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g != " " and g in grams]
                if found:
                    known = [sum(float(f[k]) for f in found) / len(found) for k in (0, 1)]
            if known is not None:
                total = [a + float(b) for a, b in zip(total, known)]
        best = max(total)
        expected = model.languages[total.index(best)], 1 / sum(math.exp(t - best) for t in total)
        got = language.Scorer(model).predict(text)
        assert got[0] == expected[0] and got[1] == pytest.approx(expected[1], rel=1e-5)


def test_one_repeated_label_does_not_fill_the_sample(spark):
    good = [(i, sentence(i, 60)) for i in range(60)]
    bad = [(1000 + i, "%%% $$$ 123 " * 20) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad[1:]], "doc_id long, quality int")
    labels = labels.union(spark.range(4000).selectExpr("1000L AS doc_id", "0 AS quality"))
    model = quality.fit_quality(docs, labels, sample=300)
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert min(scores[i] for i, _ in good) > 0.5 > max(scores[i] for i, _ in bad)


def test_columns_of_any_name(spark):
    rows = [(i, sentence(i, 30), "s", 1, "w", 2.5, i) for i in range(40)]
    schema = "doc_id long, text string, Spans string, `a.b` int, w0 string, Score double, `__w0` long"
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(1, sentence(3, 30))], "item_id long, text string")
    kept = ["doc_id", "text", "a.b", "w0", "Score", "__w0"]
    found = decontaminate.find_items(docs, items)
    assert found.columns == [*kept, "n_words", "spans", "items"] and found.where("size(spans) > 0").count() == 1
    clean = decontaminate.remove_items(docs, items)
    assert clean.columns == docs.columns and clean.count() == 39 and {r["a.b"] for r in clean.collect()} == {1}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    labelled = labels.withColumn("domain", mixing.domain_of_labels())
    plain = docs.drop("__w0")
    mixed = mixing.mix(plain, labelled, {"clean": 0.5, "junk": 0.5}, "clean")
    assert set(plain.columns) <= set(mixed.columns) and mixed.count() == 40 and {r["a.b"] for r in mixed.collect()} == {1}
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    assert scored.columns == ["doc_id", "text", "Spans", "a.b", "w0", "__w0", "score"] and scored.count() == 40
    told = language.predict_language(docs, None)
    assert told.columns == ["doc_id", "text", "Spans", "a.b", "w0", "__w0", "lang_pred", "score"] and told.count() == 40
    placed = sharding.minimax_shards(docs, n_shards=4)
    assert placed.columns == [*docs.columns, "size", "shard", "slot"] and {r["a.b"] for r in placed.collect()} == {1}


@pytest.fixture()
def archive(spark):
    rows = [(i, f"http://h/{i}", sentence(i, 20)) for i in range(70)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    ours, theirs = new_folder(spark, "odd-warc"), new_folder(spark, "odd-warc")
    records = fixity.write_warc(pages, ours)
    return records, ours, fixity.copy_replica(records, ours, theirs), theirs


def damages(*archive):
    return {r.page_id: r.damage for r in fixity.audit(*archive).collect() if not r.intact}


def path(folder, name):
    return f"{folder}/{name}".removeprefix("file:")


def test_bytes_around_records_are_audited(spark, archive):
    records, ours, replica, theirs = archive
    assert damages(*archive) == {}
    last = replica.groupBy("file").agg(F.max_by("page_id", "ordinal").alias("page_id")).collect()
    with open(path(theirs, last[0].file), "ab") as out:
        out.write(b"x" * 700)
    assert damages(*archive) == {last[0].page_id: "around"}
    # Bytes put between two records, and the places of those behind them moved on.
    third = replica.where("ordinal = 3").first()
    raw = open(path(theirs, third.file), "rb").read()
    with open(path(theirs, third.file), "wb") as out:
        out.write(raw[: third.offset] + b"?" * 9 + raw[third.offset :])
    moved = replica.withColumn("offset", F.col("offset") + F.when((F.col("file") == third.file) & (F.col("ordinal") >= 3), 9).otherwise(0))
    expected = {third.page_id: "around", last[0].page_id: "around"}
    assert damages(records, ours, moved, theirs) == expected


def test_missing_files_and_records(spark, archive):
    records, ours, replica, theirs = archive
    gone = replica.first().file
    lost = {r.page_id for r in replica.where(F.col("file") == gone).collect()}
    os.remove(path(theirs, gone))
    assert damages(*archive) == dict.fromkeys(lost, "missing")
    got = {r.page_id: r for r in fixity.audit(*archive).collect()}
    assert len(got) == 70 and all((got[i].replica_sha256 is None) == (i in lost) for i in got)
    # Records that the replica lacks, and records that only the replica has.
    few = fixity.copy_replica(records.where("page_id NOT IN (5, 60)"), ours, new_folder(spark, "odd-warc"))
    short = new_folder(spark, "odd-warc")
    few = fixity.copy_replica(records.where("page_id NOT IN (5, 60)"), ours, short)
    assert {i: d for i, d in damages(records, ours, few, short).items() if d == "missing"} == {5: "missing", 60: "missing"}
    assert {i: d for i, d in damages(few, short, records, ours).items() if d == "extra"} == {5: "extra", 60: "extra"}
    # A record that is cut off.
    end = few.groupBy("file").agg(F.max_by(F.struct("page_id", "offset"), "ordinal").alias("r")).first()
    os.truncate(path(short, end.file), end.r.offset + 10)
    assert damages(few, short, few, short) == {}
    whole = {r.page_id: r.damage for r in fixity.audit(records, ours, few, short).collect() if not r.intact}
    assert whole[end.r.page_id] == "missing"


def test_tree_by_brute_force(spark, archive):
    records, ours, _, _ = archive
    levels = fixity.merkle_levels(records, ours)
    rows = sorted(records.collect(), key=lambda r: (r.part, r.ordinal))
    nodes = {}
    for r in rows:
        raw = open(path(ours, r.file), "rb").read()
        whole = max(x.offset + x.length for x in rows if x.file == r.file) == r.offset + r.length
        stop = len(raw) if whole else r.offset + r.length
        own = [x.offset + x.length for x in rows if x.file == r.file and x.ordinal < r.ordinal]
        since = max(own, default=0)
        head = f"{r.offset - since} {r.length} {stop - since}\n".encode()
        nodes[r.part, r.ordinal] = hashlib.sha256(head + raw[since:stop]).hexdigest()
    assert {(r.part, r.idx): r.hash for r in levels[0].collect()} == nodes
    for level in levels[1:]:
        inside = max(i for _, i in nodes) > 0
        up = {}
        for (part, idx), value in sorted(nodes.items(), key=lambda n: n[0]):
            key = (part, idx >> 4) if inside else (part >> 4, idx)
            up.setdefault(key, []).append(value)
        nodes = {k: hashlib.sha256("".join(v).encode()).hexdigest() for k, v in up.items()}
        assert {(r.part, r.idx): r.hash for r in level.collect()} == nodes
    assert len(nodes) == 1

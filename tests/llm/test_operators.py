"""The corpus operators against brute force, exact round trips and held-out accuracy, on odd tables."""

import collections
import hashlib
import random
import re
import warnings
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lamina.llm import (
    components, decontaminate, fixity, jaccard, language, mixing, onebit, quality, separators, sharding, token_files,
)
from lamina.llm import encoder as encoder_module
from lamina.llm.encoder import Encoder
from lamina.llm.files import Input, Output, new_folder
from lamina.llm.words import ALNUM, SPACED, Texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, score string, shard int, spans string, n_tokens string, row string"
BYTES = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def lowered(text, pattern):
    return re.findall(pattern, (text or "").encode().translate(BYTES))


def sentence(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(["alpha", "Béta", "gamma,", "delta", "eps", "x1"]) + str(draw.randint(0, 40)) for _ in range(n))


def texts():
    base = sentence(1, 60)
    near = base.replace("alpha", "alpha", 1) + " tail"
    return [
        (10, base), (11, base), (12, near), (13, None), (14, ""), (15, "one two"), (16, "one two"),
        (17, sentence(2, 30_000)), (18, sentence(3, 40)), (10, base), (None, sentence(4, 30)), (19, " \t\n"),
        (20, "word"), (21, "<|endoftext|> İΣ ς \x85 #!"),
    ]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "mine", 7, "mine", "mine", "mine") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_encoder_gives_the_ids_of_the_whole_text():
    encoder, plain = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text in [t for _, t in texts() if t] + ["it's 'S ''s x²3¼ \x1c a\xa0b", "ÀÉ ß µ don't"]:
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(Encoder(TOKENIZER, literal=True).encode("<|endoftext|>"), "<u4").max() < 49_406


def test_encoder_remembers_words_and_pieces_once():
    encoder, plain = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    signs = [chr(c) for c in range(256)]
    texts = ["stone stone, STONE", "stone", "river7 stone,", *signs, *[f"a{c}b{c}{c} 's{c}" for c in signs], "x" * 80, "é" * 70 + "! x"]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode_all(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    few = Encoder(TOKENIZER)
    few.encode_all(["stone stone, river7", "stone"])
    assert sorted(few._memo.held) == [",", "7", "river", "river7", "stone", "stone,"]


def test_encoder_takes_back_what_an_older_generation_holds(monkeypatch):
    monkeypatch.setattr(encoder_module, "_REMEMBERED", 20)
    encoder, plain = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for seed in range(30):
        some = [sentence(seed, 12), sentence(seed // 2, 12), "alpha, stone"]
        for text, ids in zip(some, encoder.encode_all(some)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_encoder_does_not_go_through_its_older_generation():
    class Closed(dict):
        def __iter__(self):
            raise AssertionError("all words of the older generation were visited")

    encoder, plain = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    encoder._memo._older = Closed({w: encoder.encode(w) for w in ("stone", "river7")})
    encoder._memo.held = {}
    got = np.frombuffer(encoder.encode("stone river7, alpha"), "<u4").tolist()
    assert got == plain.encode("stone river7, alpha", add_special_tokens=False).ids
    assert "stone" in encoder._memo.held


def test_encoder_takes_whole_columns(monkeypatch):
    import pyarrow as pa

    encoder, plain = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    asked, look_up = [], encoder._look_up
    monkeypatch.setattr(encoder, "_look_up", lambda words: asked.extend(words) or look_up(words))
    texts = ["dropped", " Stone  stone,\tstone\n", None, "", "  ", "漢字 stone", "STONE stone", "<|endoftext|> x", "a\x85b", "ÀÉ ß don't", "漢", "x" * 80]
    for kind in (pa.string(), pa.large_string()):
        asked.clear()
        ids, ends = encoder.encode_column(pa.array(texts, kind).slice(1))
        got = [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
        assert len(asked) == len(set(asked)) and "dropped" not in asked
    for some in ([], [None], ["漢"], [" "]):
        ids, ends = encoder.encode_column(pa.array(some, pa.string()))
        assert ids.tolist() == [i for t in some for i in plain.encode(t or "", add_special_tokens=False).ids] and len(ends) == len(some)


def test_words_are_those_of_the_patterns():
    import pyarrow as pa

    rows = [t for _, t in texts()] + ["\x00a b", "x" * 5000 + " y", "é z"]
    for table, pattern in ((SPACED, rb"[^\x20\x09-\x0D]+"), (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = Texts(pa.array(rows, pa.string()), table)
        hashes = {}
        for i, text in enumerate(rows):
            expected = lowered(text, pattern)
            starts, ends = found.spans(i)
            raw = (text or "").encode().translate(BYTES)
            assert [raw[a:b] for a, b in zip(starts, ends)] == expected
            for word, value in zip(expected, found.words(i).tolist()):
                assert hashes.setdefault(word, value) == value
        assert len(set(hashes.values())) == len(hashes)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing_round_trip(bits):
    draw = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = draw.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        packed = token_files.pack(ids, bits)
        assert len(packed) == -(-n * bits // 8)
        assert token_files.unpack(packed, bits, n).tolist() == ids.tolist()


def test_token_files(spark, docs, empty):
    folder = new_folder(spark, "test-tokens")
    manifest = token_files.write_token_files(docs, folder, TOKENIZER, 49_408, 2, block_ids=1024)
    plain = Tokenizer.from_file(TOKENIZER)
    rows = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
    expected = collections.Counter()
    for doc_id, text in texts():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        expected[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert [r.doc_id for r in rows] == sorted((i for i, _ in texts()), key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    # Random access, across blocks.
    for name in [r.file for r in manifest.collect()]:
        file = token_files.TokenFile(folder, name)
        whole = np.concatenate([file.block(k) for k in range(file.n_blocks)])
        assert file.ids(5, len(whole) - 3).tolist() == whole[5:-3].tolist()
        assert file.document(len(file.doc_ends) - 1)[-1] == 2
    other = new_folder(spark, "test-tokens")
    token_files.write_token_files(empty, other, TOKENIZER, 49_408, 2)
    assert token_files.read_documents(spark, other).count() == 0
    with pytest.raises(ValueError):
        token_files.TokenWriter(folder, "x", 4, 1024).add(1, np.array([16], np.uint32))


def brute_components(rows, n=3, num=90, den=100):
    sets = []
    for _, text in rows:
        w = lowered(text, rb"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    linked = [
        [j for j, b in enumerate(sets) if j != i and a and b and den * len(a & b) >= num * len(a | b)]
        for i, a in enumerate(sets)
    ]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None, len(linked[i])))
    return collections.Counter(out)


def near_copies(n, seed):
    """Chains and clusters of texts around the bound, more of one group than a block holds."""
    draw = random.Random(seed)
    rows = []
    for group in range(n):
        words = [f"w{group}x{i}" for i in range(draw.choice([9, 12, 20, 60, 150]))]
        for _ in range(draw.randint(1, 7)):
            rows.append((len(rows), " ".join(words)))
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = f"v{draw.random()}"
            if draw.random() < 0.3:
                words = words[: int(len(words) * 0.95)]
    base = [f"h{i}" for i in range(100)]
    for i in range(330):  # a large group; two changed words part from the others
        words = list(base)
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(100)] = f"c{draw.randint(0, 40)}"
        rows.append((len(rows), " ".join(words)))
    return rows


def test_jaccard_loses_no_link(spark, docs, empty):
    found = jaccard.jaccard_components(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert collections.Counter(map(tuple, found.collect())) == brute_components(texts())
    rows = near_copies(40, 6)
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collections.Counter(map(tuple, found.collect())) == brute_components(rows)
    assert jaccard.jaccard_components(empty).count() == 0


def test_linked_is_exact_for_long_texts():
    bands, step = jaccard.Bands(90, 100), np.arange(1, 20_000, 7)
    for a, b, overlap in ((19 * step, 19 * step, 18 * step), (100 * step, 90 * step, 90 * step)):
        assert bands.linked(a, b, overlap.astype(np.float32)).all()
        assert not bands.linked(a, b, (overlap - 1).astype(np.float32)).any()


def loose_copies(n, seed):
    """Copies of similarities about 0.75 to 0.95, all with one common line, and texts of little but that line."""
    draw = random.Random(seed)
    line = [f"l{i}" for i in range(12)]
    rows = []
    for group in range(n):
        words = [f"w{group}x{i}" for i in range(draw.choice([4, 5, 7, 20, 60, 200, 700]))]
        for _ in range(draw.randint(1, 5)):
            rows.append((len(rows), " ".join(line + words if group % 3 else words)))
            kind = draw.randrange(4)
            if kind == 0:
                words = words + [f"a{draw.random()}" for _ in range(int(len(words) * draw.uniform(0.05, 0.25)))]
            elif kind == 1:
                words = words[: max(1, int(len(words) * draw.uniform(0.8, 0.95)))]
            else:
                words = list(words)
                for _ in range(int(len(words) * draw.uniform(0.0, 0.025))):
                    words[draw.randrange(len(words))] = f"v{draw.random()}"
    return rows + [(len(rows) + i, " ".join(line + [f"t{i // 2}", f"u{i}"][: i % 3])) for i in range(30)]


@pytest.mark.parametrize("bound", [80, 85])
def test_jaccard_loses_no_link_at_looser_bounds(spark, docs, empty, bound):
    rows = loose_copies(60, bound)
    expected = brute_components(rows, 5, bound)
    assert sum(n * (x[3] > 0) for x, n in expected.items()) > 40
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, bound)
    assert collections.Counter(map(tuple, found.collect())) == expected
    found = jaccard.jaccard_components(docs, 5, bound)
    assert collections.Counter(map(tuple, found.collect())) == brute_components(texts(), 5, bound)
    assert jaccard.jaccard_components(empty, 5, bound).count() == 0


def test_a_common_line_makes_no_candidates_at_looser_bounds(spark, monkeypatch):
    line = " ".join(f"l{i}" for i in range(30))
    rows = [(i, line + " " + " ".join(f"w{i}x{j}" for j in range(150))) for i in range(40)]
    rows += [(50, rows[7][1] + " " + " ".join(f"y{j}" for j in range(25)))]
    kept, rarest = [], jaccard._rarest
    monkeypatch.setattr(jaccard, "_rarest", lambda *a: kept.append(rarest(*a)) or kept[-1])
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert sorted(r.doc_id for r in found.collect() if r.n_links) == [7, 50]
    assert kept[0].select("node").distinct().count() == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, 9), (9, 3), (None, 5)]
    found = components.connected_components(spark.createDataFrame(chain, "a long, b long"))
    expected = {i: 100 for i in range(100, 161)} | {7: 7, 3: 3, 9: 3}
    assert {r.node: r.root for r in found.collect()} == expected


def brute_items(rows, items, window=10):
    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = collections.defaultdict(set)
    for item_id, text in items:
        w = lowered(text, pattern)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if w else ():
            windows[tuple(w[i : i + k])].add(item_id)
    out = []
    for doc_id, text in rows:
        w, hit, found = lowered(text, pattern), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= {str(x) for x in windows[tuple(w[i : i + k])] if x is not None}
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return collections.Counter(out)


ITEMS = [
    (1, sentence(1, 60)[20:200]), (2, "one two"), (3, None), (4, "..."), (5, "word"), (6, sentence(2, 400)),
    (7, sentence(2, 400)), (None, sentence(18, 12)), (8, "a a a a a a a a a a a a"), (9, sentence(3, 40).upper()),
]


@pytest.mark.parametrize("group_bytes", [1 << 20, 300])
def test_decontamination_finds_every_window(spark, docs, empty, group_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    more = [(30, "a " * 25 + "b"), (31, sentence(18, 12))]
    own = docs.select("doc_id", "text", "spans").union(
        spark.createDataFrame([(*r, "mine") for r in more], "doc_id long, text string, spans string")
    )
    found = decontaminate.find_items(own, items, group_bytes=group_bytes)
    rows = found.select("doc_id", "n_words", decontaminate.hit_words(), "items").collect()
    got = collections.Counter((a, b, c, tuple(d)) for a, b, c, d in rows)
    assert got == brute_items(texts() + more, ITEMS)
    assert decontaminate.find_items(empty, items).count() == 0
    assert decontaminate.find_items(docs, items.limit(0)).where("size(spans) > 0").count() == 0


def test_decontamination_cuts_spans(spark, docs, empty):
    passage = sentence(50, 14)
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = sentence(51, 30)
    rows = [(1, f"{kept} {passage}. {kept}", 5, "a"), (2, passage, 6, "b"), (3, kept, 7, "c"), (4, None, None, "d")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, items string")
    got = {r.doc_id: tuple(r) for r in decontaminate.remove_items(table, items, length_column="n_chars").collect()}
    cut = f"{kept} . {kept}"
    assert set(got) == {1, 3, 4}
    assert got[1] == (1, cut, len(cut), "a")
    assert got[3][1] == kept and got[4] == (4, None, None, "d")
    assert decontaminate.remove_items(docs, items).columns == docs.columns
    assert decontaminate.remove_items(empty, items).count() == 0


def test_shards_are_minimax(spark, docs, empty):
    rows = [(i, sentence(i, 1 + i % 23)) for i in range(300)] + [(500 + i, "hot copy") for i in range(150)] + texts()
    table = spark.createDataFrame([(*r, 99) for r in rows], "doc_id long, text string, slot int").repartition(5)
    got = sharding.minimax_shards(table, 8).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)
    groups = collections.Counter()
    for _, text in rows:
        groups[hashlib.md5(text.encode()).hexdigest() if text is not None else ""] += len((text or "").encode()) + 1
    order = [groups[k] for k in sorted(groups)]

    def fits(capacity):
        shards = at = 0
        for size in order:
            if size > capacity:
                return False
            if not shards or at + size > capacity:
                shards, at = shards + 1, 0
            at += size
        return shards <= 8

    least = next(c for c in range(max(order), sum(order) + 1) if fits(c))
    held = collections.defaultdict(list)
    where = collections.defaultdict(set)
    for r in got:
        held[r.shard].append(r)
        where[r.text].add(r.shard)
    assert max(sum(r["size"] for r in own) for own in held.values()) == least
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in held.values())
    assert all(len(s) == 1 for s in where.values())
    placed = sharding.minimax_shards(docs, 16)
    assert set(placed.columns) == {*docs.columns, "size", "slot"} and placed.count() == len(texts())
    assert sharding.minimax_shards(empty, 16).count() == 0


def test_separator_scan(spark, docs, empty):
    folder = new_folder(spark, "test-flat")
    draw = np.random.default_rng(3)
    names, expected = [], []
    for k, n in enumerate((0, 1, 50, 4096)):
        ids = draw.integers(0, 9, n).astype("<u2")
        if k == 2:
            ids[-1] = 7
        out = Output(folder, f"f{k}", ".ids")
        out.write(ids.tobytes())
        out.close()
        names.append((out.name,))
        start = 0
        for ordinal, end in enumerate(np.flatnonzero(ids == 7)):
            expected.append((out.name, ordinal, start, int(end) - start, True))
            start = int(end) + 1
        if start < n:
            expected.append((out.name, int((ids == 7).sum()), start, n - start, False))
    for block in (3, 64, 1 << 20):
        got = separators.count_tokens(spark.createDataFrame(names, "file string"), folder, 7, block=block)
        assert sorted(map(tuple, got.collect())) == sorted(expected)
    encoder = Encoder(TOKENIZER, literal=True)
    counted = separators.count_document_tokens(spark, docs, new_folder(spark, "test-flat"), TOKENIZER, 49_407)
    lengths = collections.Counter((i, len(encoder.encode(t)) // 4) for i, t in texts())
    assert collections.Counter((r.doc_id, r.n_tokens) for r in counted.collect()) == lengths
    assert separators.count_document_tokens(spark, empty, new_folder(spark, "x"), TOKENIZER, 49_407).count() == 0


def test_fixity_finds_what_was_damaged(spark):
    rows = [(i, f"http://h/{i}", sentence(i, 20)) for i in range(90)] + [(None, None, None), (5, "u", ""), (5, "u", "")]
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame(rows, schema).repartition(3)
    ours, theirs = new_folder(spark, "test-warc"), new_folder(spark, "test-warc")
    records = fixity.write_warc(pages, ours)
    for wrong in (set(), {3}, {0, 17, 18, 40, 89}):
        replica = fixity.copy_replica(records, ours, theirs, F.coalesce(F.col("page_id").isin(list(wrong) or [-1]), F.lit(False)))
        got = fixity.audit(records, ours, replica, theirs).collect()
        assert len(got) == len(rows)
        assert {r.page_id for r in got if not r.intact} == wrong
        assert all((r.sha256 == r.replica_sha256) == r.intact for r in got)
    one = records.where("page_id = 7").first()
    raw = Input(ours, one.file).read(one.offset, one.length)
    assert raw == fixity.warc_record(7, "http://h/7", rows[7][2])
    assert hashlib.sha256(raw).hexdigest() == next(r.sha256 for r in got if r.page_id == 7)
    none = fixity.write_warc(pages.limit(0), ours)
    assert fixity.audit(none, ours, none, theirs).count() == 0
    # A record that the replica does not have.
    short = fixity.copy_replica(records.where("page_id is null or page_id != 60"), ours, theirs)
    assert 60 in {r.page_id for r in fixity.audit(records, ours, short, theirs).collect() if not r.intact}


def labelled_corpus(spark):
    draw = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        words = [draw.choice(["river", "stone", "light", "walked", "over", "and", "the"]) + "abcdefghij"[draw.randrange(10)] for _ in range(90)]
        kind = i % 4
        if kind == 1:
            words = [w + "%%%" for w in words[:45]] + words[45:]
        elif kind == 2:
            words[10] = words[30] = words[50] = "nasty"
        rows.append((i, " ".join(words), "mine"))
        labels.append((i, int(kind != 1), int(kind == 2)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_quality_on_held_out_documents(spark, docs, empty):
    corpus, labels = labelled_corpus(spark)
    model = quality.fit_quality(corpus, labels.where("doc_id % 5 != 0"))
    rows = quality.score_quality(corpus, model).join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    assert np.mean([(r.score >= 0.3) == r.quality for r in rows]) >= 0.95
    odd = quality.score_quality(docs, model)
    assert odd.count() == len(texts()) and all(0 <= r.score <= 1 for r in odd.collect())
    assert quality.score_quality(empty, model).count() == 0
    assert {r.score for r in quality.score_quality(docs, quality.fit_quality(corpus, labels.limit(0))).collect()} == {0.5}
    only = quality.fit_quality(corpus, labels.where("quality = 1"))
    assert {r.score for r in quality.score_quality(corpus, only).collect()} == {1.0}


def test_quality_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    corpus, labels = labelled_corpus(spark)
    hot = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("hot "), "id").alias("text"))
    many = corpus.select("doc_id", "text").unionByName(hot)
    bags, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda x, ends, y: bags.append(len(y)) or train(x, ends, y))
    again = quality.fit_quality(many, labels.unionByName(labels.where("doc_id = 1")))
    assert bags == [241]
    other = quality.fit_quality(many.repartition(7), labels.unionByName(labels.where("doc_id = 1")))
    assert all((again.weights[k] == other.weights[k]).all() for k in again.weights)


def test_attention_gradients():
    draw = np.random.default_rng(1)
    x, ends, labels = draw.standard_normal((9, 4)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    shapes = {"encode": (4, 3), "encode0": (3,), "value": (3, 3), "gate": (3, 3), "attend": (3,), "out": (3,), "out0": ()}
    w = {k: draw.standard_normal(s) for k, s in shapes.items()}

    def loss():
        p = quality._forward(w, x, ends)["score"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for k, g in quality._gradients(w, x, ends, labels).items():
        for at in np.ndindex(shapes[k]):
            w[k] = np.array(w[k], float)
            held = w[k][at]
            w[k][at] = held + 1e-6
            up = loss()
            w[k][at] = held - 1e-6
            slope = (up - loss()) / 2e-6
            w[k][at] = held
            assert abs(slope - np.asarray(g)[at]) < 1e-5


def test_language(spark, docs, empty):
    draw = random.Random(4)
    stems = {"en": ["the", "house", "walk", "green"], "de": ["der", "häuser", "gehen", "grün"]}
    ends = {"en": ["ing", "ly", ""], "de": ["ung", "keit", ""]}
    rows = []
    for i in range(120):
        lang = "en" if i % 2 else "de"
        made = [draw.choice(stems[lang]) + draw.choice(ends[lang]) for _ in range(30)]
        rows.append((i, " ".join(made), lang if i % 7 else None, "mine"))
    corpus = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = language.fit_language(corpus.where("doc_id % 4 != 2"))
    found = language.predict_language(corpus, model).collect()
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "de") for r in found)
    # Unseen words are told by their character n-grams.
    unseen = [(1, "Greenhouse walkinghouse"), (2, "Grünhäuser gehenkeit"), (3, None), (4, "12 ..."), (5, "ÑÑÑ")]
    got = language.predict_language(spark.createDataFrame(unseen, "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "de"]
    assert [r.score for r in got][2:4] == [0.0, 0.0] and all(0 <= r.score <= 1 for r in got)
    assert language.predict_language(docs, model).count() == len(texts())
    assert language.predict_language(empty, model).count() == 0
    assert language.fit_language(corpus.limit(0)) is None
    assert {r.lang_pred for r in language.predict_language(corpus, None).collect()} == {"und"}


def test_nearest_are_those_of_brute_force(spark):
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((600, 24)).astype(np.float32)
    vectors[300:420] = vectors[100]  # copies, with ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [0.0] * 24, [nan] * 24, [inf] * 24, [None] + [1.0] * 23, [1.0, 2.0], []]
    table = spark.createDataFrame(
        [(*r, 1) for r in rows] + [(700 + 100 * i, b, 1) for i, b in enumerate(bad)] + [(None, rows[0][1], 1)],
        "vec_id long, embedding array<float>, rank int",
    ).repartition(4)
    got = collections.defaultdict(list)
    for r in onebit.nearest(table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    exact = vectors.astype(float)
    assert sorted(got) == list(range(0, 600, 100))
    for q, found in got.items():
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]
        assert [x[0] for x in found] == list(range(1, 11))
        assert [x[1] for x in found] == order
        assert np.allclose([x[2] for x in found], d[order], rtol=1e-12)
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in onebit.nearest(few).where("query_id = 0").collect()].__len__() == 3
    assert onebit.nearest(few.limit(0)).count() == 0


def test_mixing_reaches_targets_by_brute_force(spark, docs, empty):
    corpus, labels = labelled_corpus(spark)
    labels = labels.withColumn("domain", mixing.domain_of_labels())
    weights = {"clean": 0.9, "toxic": 0.05, "junk": 0.05}
    mixed = mixing.mix(corpus.withColumn("rate", F.lit("mine")), labels, weights, "clean")
    rows = mixed.join(labels.select("doc_id", "domain"), "doc_id").collect()
    # The classifier knows the domains, and chances add up.
    assert np.mean([max(weights, key=lambda d: r[f"p_{d}"]) == r.domain for r in rows]) >= 0.95
    p = np.array([[r[f"p_{d}"] for d in weights] for r in rows])
    t = np.array([r.n_tokens for r in rows], float)
    assert np.allclose(p.sum(axis=1), 1) and set(t) == {90.0}
    # The same projected steps on one machine.
    present = t @ p
    targets = np.minimum(np.array(list(weights.values())) / 0.9 * present[0], present)
    rate = np.ones(len(t))
    for _ in range(500):
        rate = np.maximum(rate - p @ ((rate * t @ p - targets) / present), 0)
    reached = np.array([r.rate for r in rows]) * t @ p
    assert np.allclose(reached, rate * t @ p, rtol=0.01, atol=5)
    assert np.allclose(reached, targets, rtol=0.05, atol=20)
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    out = mixing.taken(mixed, ["doc_id", "text"])
    assert out.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs, labels, weights, "clean").count() == len(texts())
    assert mixing.mix(docs, labels.limit(0), weights, "clean").count() == len(texts())
    assert mixing.mix(empty, labels, weights, "clean").count() == 0


def test_mixing_brings_scarce_domains_up(spark):
    corpus, labels = labelled_corpus(spark)
    # 76 % clean, and 12 % each of the others.
    less = "doc_id % 4 IN (0, 3) OR doc_id < 76"
    labels = labels.withColumn("domain", mixing.domain_of_labels())
    weights = {"clean": 0.5, "toxic": 0.25, "junk": 0.25}
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        mixed = mixing.mix(corpus.where(less), labels, weights, "clean")
    found = {r.domain: r for r in mixing.shares(mixed, weights).collect()}
    assert set(found) == set(weights)
    for d, w in weights.items():
        assert found[d].wanted == w and abs(found[d].reached - w) < 0.01 and abs(found[d].dealt - w) < 0.05
    assert mixed.where("rate > 1.5").count() > 0


def test_mixing_says_which_targets_it_misses(spark):
    corpus, labels = labelled_corpus(spark)
    labels = labels.withColumn("domain", mixing.domain_of_labels()).where("domain = 'clean'")
    weights = {"clean": 0.5, "toxic": 0.25, "junk": 0.25}
    with pytest.warns(UserWarning, match="toxic 0.2500 wanted"):
        mixed = mixing.mix(corpus.where("doc_id % 4 = 0"), labels, weights, "clean")
    found = {r.domain: r for r in mixing.shares(mixed, weights).collect()}
    assert found["toxic"].reached < 0.2 and found["toxic"].wanted == 0.25


def test_mixing_model_of_some_labels(spark):
    corpus, labels = labelled_corpus(spark)
    labels = labels.withColumn("domain", mixing.domain_of_labels())
    domains = ["clean", "toxic", "junk"]
    model = mixing.fit_domains(corpus, labels.unionByName(labels), domains, sample=150)
    found = mixing.domain_posteriors(corpus, model, domains).join(labels, "doc_id").where("domain IS NOT NULL")
    rows = found.collect()
    right = [r[f"p_{r.domain}"] == max(r[f"p_{d}"] for d in domains) for r in rows]
    assert sum(right) >= 0.95 * len(right)


def test_mixing_keeps_all_telling_words(spark):
    rows = [(i, " ".join(f"k{i % 2}x{j}" for j in range(26_000))) for i in range(80)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(80)], "doc_id long, domain string")
    words, _ = mixing.fit_domains(corpus, labels, ["a", "b"])
    assert words.count() >= 52_000


def test_mixing_is_the_same_without_broadcast(spark):
    corpus, labels = labelled_corpus(spark)
    labels = labels.withColumn("domain", mixing.domain_of_labels())
    weights = {"clean": 0.9, "toxic": 0.05, "junk": 0.05}
    got = [
        {r.doc_id: (round(r.rate, 6), r.copies) for r in mixing.mix(corpus, labels, weights, "clean", broadcast_words=n).collect()}
        for n in (0, 200_000)
    ]
    assert got[0] == got[1]


def test_mixing_plan_has_no_python(spark):
    corpus, labels = labelled_corpus(spark)
    labels = labels.withColumn("domain", mixing.domain_of_labels())
    from tests.support import plan

    text = plan(mixing.mix(corpus, labels, {"clean": 0.9, "toxic": 0.05, "junk": 0.05}, "clean"))
    assert not re.search("Python|Pandas|Arrow", text)

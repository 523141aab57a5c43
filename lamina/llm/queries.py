"""The operators of this subpackage on the driver's tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import tune
from lamina.llm import (
    decontaminate, fixity, jaccard, language, mixing, onebit, pii, quality, runs, search, separators, sharding, token_files,
)
from lamina.llm.files import new_folder

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    target = new_folder(spark, "token-files")
    token_files.write_token_files(
        docs, target, public_tokenizers.path(TOKENIZER), VOCABULARY, end_id=2
    )
    return token_files.read_documents(spark, target)


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return jaccard.jaccard_components(docs, n=3, num=90, den=100)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, _table(spark, folder, "benchmark"), window=10)
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op4_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    placed = sharding.minimax_shards(docs, n_shards=16, columns=["doc_id", "text_crc32"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


END_OF_TEXT = 49_407  # of the tokenizer file; its string in a text is encoded as ordinary text


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    target = new_folder(spark, "flat-tokens")
    path = public_tokenizers.path(TOKENIZER)
    return separators.count_document_tokens(spark, docs, target, path, END_OF_TEXT).select("doc_id", "n_tokens")


def op6_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as WARC files, a replica in which about one record in 100 was damaged, and its audit."""
    ours, theirs = new_folder(spark, "warc"), new_folder(spark, "warc-replica")
    records = fixity.write_warc(_table(spark, folder, "pages"), ours)
    damaged = F.pmod(F.crc32(F.col("page_id").cast("string")), F.lit(100)) == 3
    replica = fixity.copy_replica(records, ours, theirs, damaged)
    audited = fixity.audit(records, ours, replica, theirs)
    return audited.select("page_id", "length", "sha256", "replica_sha256", "intact")


DOMAIN_WEIGHTS = {"clean": 0.97, "toxic": 0.01, "junk": 0.02}


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").withColumn("domain", mixing.domain_of_labels())
    docs = _table(spark, folder, "documents")
    return mixing.mix(docs, labels, DOMAIN_WEIGHTS, anchor="clean", columns=["doc_id"])


def _remainder(of: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.AttentionModel:
    """Learned from labelled rows outside the held-out fifth."""
    return quality.fit_quality(docs, labels.where(_remainder(5) != 0), sample=3000)


def op8_quality_attention(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model(docs, _table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        (_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_language_backoff(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.fit_language(docs.where(_remainder(4) != 2), sample_per_language=600)
    found = language.predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op10_onebit_codes(spark: SparkSession, folder: str) -> DataFrame:
    return onebit.nearest(_table(spark, folder, "embeddings"), k=10, every=100)


def op11_semimarkov_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit_field(docs, sample=600))
    return found.select(
        "doc_id",
        *[pii.of_kind("base", kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return search.search(docs, _table(spark, folder, "benchmark"), k=10)


def op13_grammar_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth document by its hash has its words repeated from some word on before runs are looked for."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    hashed = F.crc32(F.col("doc_id").cast("string"))
    number = F.when(F.pmod(hashed, F.lit(10)) == 0, F.floor(hashed / 10).cast("long"))
    found = runs.find_runs(runs.repeat_tails(docs, number), least=12)
    best = runs.longest("runs")
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(F.lit(1000) * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_decontamination": op3_decontamination,
    "op4_minimax_shards": op4_minimax_shards,
    "op5_token_counts": op5_token_counts,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_mixing": op7_mixing,
    "op8_quality_attention": op8_quality_attention,
    "op9_language_backoff": op9_language_backoff,
    "op10_onebit_codes": op10_onebit_codes,
    "op11_semimarkov_pii": op11_semimarkov_pii,
    "op12_lexical_search": op12_lexical_search,
    "op13_grammar_runs": op13_grammar_runs,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_ngram_jaccard": f"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
        END AS grams
    FROM split),
cells AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM cells a JOIN cells b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce(l.least, s.doc_id)) AS component_id, coalesce(d.n, 0) AS n_links
FROM sets s LEFT JOIN least l ON l.a = s.doc_id LEFT JOIN degree d ON d.a = s.doc_id""",
    "op3_decontamination": f"""
WITH items AS (
    SELECT item_id, list_filter(regexp_split_to_array({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                                lambda x: x <> '') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS k,
           unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ')
                   FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS run
    FROM items WHERE len(w) > 0),
split AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                               lambda x: x <> '') AS w FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split),
runs AS (
    SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS run
    FROM placed CROSS JOIN (SELECT DISTINCT k FROM windows) WHERE i + k - 1 <= len(w)),
found AS (SELECT DISTINCT doc_id, i, r.k, item_id FROM runs r JOIN windows x ON x.k = r.k AND x.run = r.run),
hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN hits h ON h.doc_id = s.doc_id LEFT JOIN listed t ON t.doc_id = s.doc_id""",
    "op12_lexical_search": f"""
WITH split AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                               lambda x: x <> '') AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM split),
wanted AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(list_filter(
              regexp_split_to_array({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS term
          FROM benchmark)
    GROUP BY item_id, term),
counted AS (
    SELECT doc_id, n, term, count(*) AS tf
    FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM split)
    WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, n, term),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM counted CROSS JOIN total GROUP BY term),
part AS (
    SELECT doc_id, term,
           weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))) AS part
    FROM counted JOIN weight USING (term) CROSS JOIN total),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * part) AS BIGINT) AS score
    FROM wanted JOIN part USING (term) GROUP BY item_id, doc_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_grammar_runs": """
WITH bits AS (
    SELECT doc_id, text, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda x: [CAST(ord(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS bit FROM documents),
hashed AS (
    SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295, bit),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) AS h FROM bits),
split AS (
    SELECT doc_id, h, h // 10 AS g,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM hashed),
begun AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM split),
measured AS (SELECT *, 1 + (len(w) - a) // (3 + g % 8) AS p FROM begun),
placed AS (SELECT doc_id, w, a, p, unnest(range(len(w))) AS i FROM measured),
words AS (
    SELECT doc_id, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word FROM placed),
grams AS (
    SELECT doc_id, i, hash(word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d,
                           lead(word, 4) OVER d, lead(word, 5) OVER d) AS gram,
           lead(i, 5) OVER d AS whole
    FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
twins AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y USING (doc_id, gram)
    WHERE x.i < y.i AND x.whole IS NOT NULL AND y.whole IS NOT NULL),
islands AS (
    SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 6 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM twins)
    GROUP BY doc_id, q, island),
found AS (
    SELECT doc_id, start, length, min(q) AS period FROM islands
    WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
listed AS (
    SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start, length, period), [-length, start, period]) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
    FROM found GROUP BY doc_id),
dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
    FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM split s LEFT JOIN listed l ON l.doc_id = s.doc_id LEFT JOIN kept k ON k.doc_id = s.doc_id""",
}

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import cover_tree, hidden_markov, language, packing, phrases, piece_table, quality, sharding, simhash, spelling, token_file, toxicity, winnowing
from ordermill.llm.shipping import ship
from ordermill.sources.scratch import scratch_path

SLOTS = sharding.table_size(sharding.SHARDS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id")
    return sharding.place(documents, ["doc_id"], sharding.shard_names(sharding.SHARDS))


SHARDING_SQL = f"""
WITH RECURSIVE shards AS (
    SELECT n AS shard,
           ('0x' || substr(md5('offset:shard-' || lpad(n::VARCHAR, 5, '0')), 1, 15))::BIGINT % {SLOTS} AS "offset",
           ('0x' || substr(md5('step:shard-' || lpad(n::VARCHAR, 5, '0')), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS step
    FROM range({sharding.SHARDS}) AS r(n)
), orders AS (
    SELECT shard, list_transform(range({SLOTS}), lambda k: ("offset" + k * step) % {SLOTS}) AS slots FROM shards
), claims AS (
    SELECT 0 AS turn, list_transform(range({SLOTS}), lambda k: -1) AS owner
    UNION ALL
    SELECT turn + 1, list_transform(owner, lambda who, place: CASE WHEN place = claimed THEN turn % {sharding.SHARDS} ELSE who END)
    FROM (SELECT turn, owner, list_filter(slots, lambda s: owner[s + 1] < 0)[1] + 1 AS claimed
          FROM claims JOIN orders ON shard = turn % {sharding.SHARDS}
          WHERE turn < {SLOTS})
), filled AS (SELECT owner FROM claims WHERE turn = {SLOTS}),
slots AS (SELECT unnest(range({SLOTS})) AS slot, unnest(owner) AS shard FROM filled),
placed AS (
    SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS}) AS slot
    FROM documents
)
SELECT doc_id, slot::INTEGER AS slot, shard::INTEGER AS shard FROM placed JOIN slots USING (slot)
"""


def op5_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.edit_report(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        winnowing.digest(F.col("marks")).alias("fingerprint"),
        winnowing.digest(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited", "near_next", F.size("marks").alias("n_marks"),
    )


def op2_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, folder, "embeddings"))


COVER_TREE_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN roots r ON r.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    found = toxicity.detect(documents, model)
    return found.withColumn("n_offending", F.size("offending")).drop("offending")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return language.identify(documents, language.fit(documents))


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = piece_table.encode_decode(documents, vocabulary("piece_bpe_32k.model"), with_values=False)
    return found.drop("ids", "decoded")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return packing.pack(documents, vocabulary("word_bpe_49k.json"), with_ids=False).drop("ids")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.classify(documents, quality.fit(documents, table(spark, folder, "labels")))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_file.write(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), path)
    return token_file.read(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(table(spark, folder, "documents"))


SPELLING_SQL = """
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b::BIGINT], range(8)),
        lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), runs AS (
    SELECT doc_id, run FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents))
    WHERE length(run) >= 6
), pairs AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, times, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id || ':' || run, ''),
            lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END))),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h
    FROM pairs, crc_table
), spelled AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, times
    FROM hashed
), words AS (
    SELECT word, sum(times)::BIGINT AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cut AS (
    SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)
), near AS (
    SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
), ranked AS (
    SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, o.n AS other_n, w.n,
           row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS rank
    FROM near JOIN words o ON o.word = other JOIN words w ON w.word = near.word
), forms AS (
    SELECT word, n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
    FROM ranked WHERE rank = 1
), chain AS (
    SELECT word, form AS root, 1 AS step FROM forms WHERE form IS NOT NULL
    UNION ALL
    SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON forms.word = root WHERE forms.form IS NOT NULL
), ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""


def op12_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hidden_markov.score_documents(table(spark, folder, "documents"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


PHRASES_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces),
runs AS (
    SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
    FROM split, range(1, 6) AS s(size) WHERE len(words) >= size
), counted AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
often AS (SELECT * FROM counted WHERE f >= 100),
long AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM often WHERE size > 1),
inner_ones AS (
    SELECT lang, a, unnest(list_transform(range(1, size - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
    FROM long, range(2, 5) AS s(k) WHERE k < size
), kept AS (
    SELECT * FROM long WHERE NOT EXISTS (SELECT 1 FROM inner_ones i WHERE i.lang = long.lang AND i.phrase = long.phrase AND 100 * i.a >= 100 * long.a)
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest
    FROM kept, range(1, 5) AS s(k) WHERE k < size
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts JOIN often x ON x.lang = cuts.lang AND x.phrase = first JOIN often y ON y.lang = cuts.lang AND y.phrase = rest
    JOIN totals t ON t.lang = cuts.lang
), weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_cover_tree": op2_cover_tree,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_winnowing": op5_winnowing,
    "op6_pieces": op6_pieces,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_simhash": op9_simhash,
    "op10_token_files": op10_token_files,
    "op11_spelling": op11_spelling,
    "op12_hidden_markov": op12_hidden_markov,
    "op13_phrases": op13_phrases,
}
SQL: dict[str, str] = {"op1_sharding": SHARDING_SQL, "op2_cover_tree": COVER_TREE_SQL, "op11_spelling": SPELLING_SQL, "op13_phrases": PHRASES_SQL}

"""Registered queries of the training-data operators, each over its whole
table with production parameters, and their oracle SQL where SQL can express
the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    bpe, chat, divergence, fingerprints, hard_negatives, jaccard, language, neighbours, packing, pitman_yor, quality, simhash,
    tokens,
)
from quarry.llm.common import crc_mod, read, saved


def held_out(n: int, part: int) -> Column:
    return F.coalesce(crc_mod("doc_id", n) == part, F.lit(False)).alias("held_out")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model, stats = quality.fit_documents(docs, labels, crc_mod("doc_id", 4) != 2)
    scored = stats.select("doc_id", held_out(4, 2), model.score(F.col("statistics")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.KEEP).cast("int"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Digest columns of the packed documents."""
    pieces = packing.token_pieces(docs, tokens.tokenizer_path())
    digest = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(saved(digest, "pieces")).drop("slot")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows.where(F.col("vec_id") % 20 == 0), rows, k=20)


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "conv_id bigint, turn bigint, role string, text string"
    extra = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], schema
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_chats(rows.unionByName(extra)))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"), tokens.tokenizer_path())


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


def round_trip(docs: DataFrame) -> DataFrame:
    """Digest columns of the ids of the documents and of their decoded text."""
    path = tokens.tokenizer_path()
    both = bpe.decode(bpe.encode(docs, path), path)
    as_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(as_text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    models = language.fit(docs, crc_mod("doc_id", 4) != 2)
    return language.identify(docs, models).select(
        "doc_id", held_out(4, 2), "lang_pred", "score", "accepted"
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learn = crc_mod("doc_id", 10) != 0
    model, counts = pitman_yor.fit(docs, learn)
    return pitman_yor.score(docs, model, counts, learn).select(
        "doc_id", held_out(10, 0), "n_tokens", "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def shifted_label() -> Column:
    """The label, moved on by one where vec_id is divisible by 7."""
    label = F.col("label").cast("bigint")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(read(spark, sf_dir, "embeddings"), shifted_label())
    return hard_negatives.mine(rows.where(F.col("vec_id") % 100 == 0), rows)


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_chat_format": op5_chat_format,
    "op6_token_counts": op6_token_counts,
    "op7_fingerprints": op7_fingerprints,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_language_id": op9_language_id,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_hard_negatives": op13_hard_negatives,
}

_MARKS = r"""\\\\|<</SYS>>|<<SYS>>|\[/INST\]|\[INST\]|\[/ROLE\]|\[ROLE\]|\[/OTHER\]|</s>|<s>"""

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS w FROM documents
        ),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(
                       range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
            FROM words
        ),
        sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
        each AS (SELECT doc_id, unnest(s) AS x FROM sets),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
        ),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sizes
            UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        near AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT doc_id, n AS n_shingles, component_id,
               coalesce(n_links, 0)::BIGINT AS n_links
        FROM sizes JOIN least ON least.a = doc_id LEFT JOIN near ON near.a = doc_id""",
    "op5_chat_format": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
            UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
        ),
        m AS (
            SELECT *, length(text) + len(regexp_extract_all(text, '{_MARKS}')) AS escaped,
                   length(role) + len(regexp_extract_all(role, '{_MARKS}')) AS escaped_role,
                   lag(role) OVER w AS before, row_number() OVER w AS no,
                   count(*) OVER (PARTITION BY conv_id) AS turns
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no))
                   AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(escaped + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13
                   WHEN 'assistant' THEN 7 ELSE 21 + escaped_role END)::BIGINT AS formatted_chars,
               bool_and(CASE role WHEN 'system' THEN no = 1 WHEN 'user' THEN
                   no = 1 OR before IN ('system', 'assistant')
                   WHEN 'assistant' THEN no > 1 AND before = 'user' ELSE false END
                   AND (no < turns OR role = 'assistant')) AS valid_order
        FROM m GROUP BY conv_id""",
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        each AS (SELECT no, lang, source, unnest(terms) AS term FROM docs),
        kept AS (
            SELECT lang, term, count(*) AS in_lang FROM each GROUP BY lang, term
            HAVING count(DISTINCT no) >= 30
        ),
        counted AS (
            SELECT lang, source, term, count(*) AS c FROM each SEMI JOIN kept USING (lang, term)
            GROUP BY lang, source, term
        ),
        langs AS (SELECT lang, count(*) AS v, sum(in_lang) AS n FROM kept GROUP BY lang),
        totals AS (SELECT lang, source, sum(c) AS n FROM counted GROUP BY lang, source),
        groups AS (
            SELECT lang, source, coalesce(t.n, 0) AS n
            FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN totals t USING (lang, source)
        ),
        p AS (
            SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                   1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (g.n + 5 * l.v) AS p,
                   1 + (1000000000::HUGEINT * (k.in_lang + 5)) // (l.n + 5 * l.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ),
        found AS (
            SELECT g.lang, g.source, 'pair' AS part, o.source AS item,
                   coalesce(sum(abs(a.p - b.p)), 0)::BIGINT AS value
            FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
            LEFT JOIN p a ON a.lang = g.lang AND a.source = g.source
            LEFT JOIN p b ON b.lang = o.lang AND b.source = o.source AND b.term = a.term
            WHERE a.term IS NULL OR b.term IS NOT NULL
            GROUP BY ALL
            UNION ALL
            SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q
        )
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part
                   ORDER BY value DESC, encode(item)))::INTEGER AS rank
        FROM found QUALIFY part = 'pair' OR rank <= 50""",
    "op13_hard_negatives": """
        WITH ok AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                   list_inner_product(a.v, r.v)::BIGINT AS score
            FROM ok a JOIN ok r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE same QUALIFY row_number() OVER (
                PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, (row_number() OVER (
                   PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER
                   AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score
          AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op4_nearest_neighbours": """
        WITH ok AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND list_bool_and(list_transform(
                    embedding, lambda x: x IS NOT NULL AND isfinite(x)))
              AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
        ),
        pair AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM ok q JOIN ok c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, (row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id, score
        FROM pair QUALIFY rank <= 20""",
}

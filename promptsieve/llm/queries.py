"""The registered queries of this subpackage, each over its whole table, and SQL
for those that SQL can express."""

from __future__ import annotations

from promptsieve.llm import exact_dedup, importance, interaction, language, mixing, ngram_join, packing, pii, quality, repeats, token_counts, token_files, topk
from promptsieve.llm.texts import table
from promptsieve.session import shared_dir

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
# Only where the session has no spark.promptsieve.pii.key.
PII_KEY = "not-a-secret"


def vocabulary(name: str) -> str:
    """Where the installed public vocabulary files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key=spark.conf.get("spark.promptsieve.pii.key", PII_KEY))


def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(PIECE_VOCABULARY))


def op4_identify_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labelled = quality.sample(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, quality.train(labelled))


def op5_token_files(spark, sf_dir):
    path = shared_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, vocabulary(WORD_TOKENIZER), end_id=1)
    return token_files.digests(spark, path)


def op7_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(WORD_TOKENIZER), end_id=0)


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op9_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_mix_sources(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


def op11_repeated_passages(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400)


def op12_filter_interaction(spark, sf_dir):
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_pseudonyms": op1_pseudonyms,
    "op2_ngram_join": op2_ngram_join,
    "op3_token_counts": op3_token_counts,
    "op4_identify_language": op4_identify_language,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_pack": op7_pack,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_top_k": op9_top_k,
    "op10_mix_sources": op10_mix_sources,
    "op11_repeated_passages": op11_repeated_passages,
    "op12_filter_interaction": op12_filter_interaction,
    "op13_importance_resampling": op13_importance_resampling,
}

SQL = {
    "op11_repeated_passages": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents
        ), windows AS (
            SELECT row, i, md5(b[i + 1:i + 400]) AS w
            FROM (SELECT row, b, unnest(range(octet_length(b) - 399)) AS i FROM d WHERE octet_length(b) >= 400)
        ), repeated AS (
            SELECT row, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)
        ), begun AS (
            SELECT row, i, coalesce(i > lag(i) OVER (PARTITION BY row ORDER BY i) + 400, true)::INTEGER AS begins FROM repeated
        ), spans AS (
            SELECT row, min(i) AS low, max(i) + 400 AS high
            FROM (SELECT row, i, sum(begins) OVER (PARTITION BY row ORDER BY i) AS span FROM begun) GROUP BY row, span
        ), gaps AS (
            SELECT row, coalesce(lag(high) OVER (PARTITION BY row ORDER BY low), 0) AS low, low AS high FROM spans
            UNION ALL SELECT row, max(high), octet_length(any_value(b)) FROM spans JOIN d USING (row) GROUP BY row
        ), rests AS (
            SELECT row, string_agg(hex(b[low + 1:high]), '' ORDER BY low) FILTER (high > low) AS rest FROM gaps JOIN d USING (row) GROUP BY row
        ), totals AS (SELECT row, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
        SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(rest, ''))) END AS kept_sha256
        FROM d LEFT JOIN totals USING (row) LEFT JOIN rests USING (row)""",
    "op12_filter_interaction": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
        ), measured AS (
            SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   min(doc_id) OVER (PARTITION BY text) AS first_id
            FROM d
        ), judged AS (
            SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
                   100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
                   regexp_matches(text, '[#$%&*|]') AS d, doc_id > first_id AS e,
                   coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
            FROM measured LEFT JOIN labels USING (doc_id)
        ), masks AS (
            SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM judged GROUP BY ALL
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        orders AS (
            SELECT v.l || w.l || x.l || y.l || z.l AS filter_order FROM letters v, letters w, letters x, letters y, letters z
            WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5
        ), steps AS (
            SELECT filter_order, step, instr('ABCDE', substr(filter_order, step, 1)) AS f,
                   [instr('ABCDE', substr(filter_order, i, 1)) FOR i IN range(1, step)] AS earlier
            FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
        ), counted AS (
            SELECT part, filter_order, step, f,
                   sum(n) AS total,
                   coalesce(sum(n) FILTER (fails[f] AND NOT gone), 0) AS removed,
                   coalesce(sum(n) FILTER (fails[f] AND gone), 0) AS redundant,
                   coalesce(sum(n) FILTER (fails[f] AND NOT others), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (fails[f] AND NOT gone), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (fails[f] AND NOT gone), 0) AS toxic_lost
            FROM (
                SELECT *, list_contains([fails[i] FOR i IN earlier], true) AS gone,
                       list_contains([fails[i] AND i <> f FOR i IN range(1, 6)], true) AS others
                FROM masks, steps
            ) GROUP BY part, filter_order, step, f
        )
        SELECT part, filter_order, step,
               (total - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step))::BIGINT AS kept,
               removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
               good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM counted""",
    # crc32 bit by bit, once for each distinct word.
    "op13_importance_resampling": r"""
        WITH bits AS (
            SELECT list_transform(range(256), lambda b: list_reduce([b::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)) AS step
        ), found AS (
            SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS row, text FROM documents
            UNION ALL SELECT 'b', item_id, row_number() OVER (), text FROM benchmark
        ), listed AS (
            SELECT side, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM found
        ), counted AS (SELECT side, row, word, count(*) AS n FROM listed GROUP BY ALL),
        spelt AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counted)),
        placed AS (
            SELECT word, xor(4294967295::UBIGINT, list_reduce(
                list_concat([4294967295::UBIGINT], list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
                lambda c, b: xor(step[(xor(c % 256, b) + 1)::BIGINT], c // 256))) % 10000 AS bucket
            FROM spelt, bits
        ), features AS (SELECT side, row, bucket, sum(n)::BIGINT AS n FROM counted JOIN placed USING (word) GROUP BY ALL),
        buckets AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
            FROM features GROUP BY bucket
        ), sums AS (SELECT sum(s) AS every_s, sum(t) AS every_t FROM buckets),
        gained AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (every_s + 10000) / ((s + 1) * (every_t + 10000))))::BIGINT AS gain FROM buckets, sums
        ), weighed AS (
            SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
            FROM features JOIN gained USING (bucket) WHERE side = 'd' GROUP BY row
        ), scored AS (
            SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM found LEFT JOIN weighed USING (row) WHERE side = 'd'
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                   count(*) FILTER (n_features >= 20) OVER () AS eligible
            FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM ranked""",
    "op9_top_k": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, x -> floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT * FROM ranked WHERE rank <= 5""",
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept,
               text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}

"""Registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from floortally.llm import (
    chat_windows, debruijn, decontamination, filter_audit, fingerprints, lm_scoring, mixing, near_dedup, periodic_runs, sharding, suffix_dedup, tokens, toxicity,
)
from floortally.llm.tables import table

TOKENIZER = "byte_bpe_50k.json"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_classes(table(spark, sf_dir, "documents"))
    known = lambda c: F.nullif(F.col(c), F.lit(near_dedup.LAST)).alias(c if c != "doc" else "doc_id")
    return found.select(known("doc"), known("text_class"), known("near_class"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return tokens.count_tokens(table(spark, sf_dir, "documents"), file.read())


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: The tree of the mixture: script family, language, source. Unnamed nodes weigh 1.
MIX_WEIGHTS = {"domain": {"germanic": 0.55, "romance": 0.45}, "lang": {"en": 0.7, "de": 0.3, "fr": 0.5, "es": 0.5}, "source": {}}
MIX_PART, MIX_EPOCHS, MIX_SEED = 0.8, 2, 42


def mix_levels() -> dict:
    lang = F.coalesce(F.col("lang"), F.lit(""))
    return {
        "domain": F.when(lang.isin("en", "de"), "germanic").when(lang.isin("fr", "es"), "romance").otherwise("other"),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_PART, MIX_EPOCHS, MIX_SEED).drop("text_hash")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(table(spark, sf_dir, "documents"))


def op8_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.scored(documents, model).select("doc_id", "held_out", "score", "predicted")


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        tokenizer = file.read()
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    both = given.unionByName(spark.createDataFrame(control, "conv_id long, turn long, role string, text string"))
    return chat_windows.digests(chat_windows.chat_windows(both, tokenizer))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents")))
    by_exponent = F.expr(
        "array_sort(runs, (a, b) -> case when a.length * b.period > b.length * a.period then -1"
        " when a.length * b.period < b.length * a.period then 1 when a.start < b.start then -1 when a.start > b.start then 1"
        " when a.period < b.period then -1 when a.period > b.period then 1 else 0 end)"
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.get(by_exponent, F.lit(0))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_fingerprints, op3_token_counts, op4_sharding, op5_mixing, op6_suffix_dedup, op7_lm_scores,
        op8_debruijn_dedup, op9_decontamination, op10_toxicity, op11_chat_windows, op12_periodic_runs, op13_filter_audit,
    )
}
ORACLES: dict[str, str] = {
    "op2_fingerprints": r"""
    WITH read AS (
        SELECT doc_id, coalesce(text, '') AS text FROM documents
    ), following AS (
        SELECT *, coalesce(lead(text) OVER by_id, first_value(text) OVER by_id) AS next_text
        FROM read WINDOW by_id AS (ORDER BY doc_id NULLS FIRST, text)
    ), changed AS (
        SELECT *, substr(text, 1, length(text) - length(text) // 4) || substr(next_text, 1, length(text) // 4) AS edited FROM following
    ), texts AS (
        SELECT row_number() OVER () AS row_id, doc_id, text, next_text, edited FROM changed
    ), marked AS (
        -- Section ends, after two line breaks or more, carry a mark of their own; then line ends, then sentence ends.
        SELECT row_id, kind, string_split(regexp_replace(replace(body, chr(10), chr(10) || chr(57344)),
            '(^|[^' || chr(57344) || '])' || chr(10) || chr(57344), '\1' || chr(10), 'g'), chr(57344)) AS sections
        FROM (SELECT row_id, unnest(['text', 'edited', 'next']) AS kind, unnest([text, edited, next_text]) AS body FROM texts)
    ), trees AS (
        SELECT row_id, kind, [[[sha256(piece) FOR piece IN string_split(
            regexp_replace(line, '([.!?。！？] )', '\1' || chr(57344), 'g'), chr(57344))]
            FOR line IN string_split(replace(part, chr(10), chr(10) || chr(57344)), chr(57344))] FOR part IN sections] AS tree
        FROM marked
    ), nodes AS (
        SELECT row_id, kind, tree, list_distinct(flatten(flatten(tree))) AS leaves,
            sha256(array_to_string([sha256(array_to_string([sha256(array_to_string(line, '')) FOR line IN part], '')) FOR part IN tree], '')) AS root
        FROM trees
    ), paired AS (
        SELECT t.*, a.tree, a.root, a.leaves, b.tree AS edited_tree, b.root AS edited_root, b.leaves AS edited_leaves, c.leaves AS next_leaves,
            nullif(coalesce(list_position([a.tree[i] IS NOT DISTINCT FROM b.tree[i] FOR i IN range(1, greatest(len(a.tree), len(b.tree)) + 1)], FALSE), 0), 0) AS branch
        FROM texts t JOIN nodes a ON a.row_id = t.row_id AND a.kind = 'text' JOIN nodes b ON b.row_id = t.row_id AND b.kind = 'edited'
        JOIN nodes c ON c.row_id = t.row_id AND c.kind = 'next'
    )
    SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, root AS fingerprint, edited_root AS edited_fingerprint,
        len(list_intersect(leaves, edited_leaves)) / (len(leaves) + len(edited_leaves) - len(list_intersect(leaves, edited_leaves))) AS near_edited,
        len(list_intersect(leaves, next_leaves)) / (len(leaves) + len(next_leaves) - len(list_intersect(leaves, next_leaves))) AS near_next,
        CAST(len(tree) AS INT) AS n_sections, CAST(list_sum([len(part) FOR part IN tree]) AS INT) AS n_paragraphs,
        CAST(branch - 1 AS INT) AS edit_section,
        CAST(CASE WHEN branch IS NOT NULL THEN list_position([tree[branch][i] IS NOT DISTINCT FROM edited_tree[branch][i]
            FOR i IN range(1, greatest(coalesce(len(tree[branch]), 0), coalesce(len(edited_tree[branch]), 0)) + 1)], FALSE) - 1 END AS INT) AS edit_paragraph
    FROM paired
    """,
    "op8_debruijn_dedup": r"""
    WITH read AS (
        SELECT row_number() OVER () AS row_id, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), windows AS (
        SELECT row_id, doc, i, array_to_string(words[i + 1 : i + 50], ' ') AS said
        FROM (SELECT *, unnest(range(len(words) - 49)) AS i FROM read WHERE len(words) >= 50)
    ), firsts AS (
        SELECT said, min(doc) AS first_doc FROM windows GROUP BY said HAVING count(*) > 1
    ), gone AS (
        SELECT DISTINCT row_id, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (said) WHERE first_doc < doc
    ), words AS (
        SELECT row_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM read
    ), kept AS (
        SELECT row_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM words ANTI JOIN gone USING (row_id, place) GROUP BY row_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(text, '')) AS kept_sha256
    FROM read LEFT JOIN kept USING (row_id)
    """,
    "op13_filter_audit": r"""
    WITH read AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM read
    ), masked AS (
        SELECT doc_id, part,
            CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
            + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
            + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
            + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
            + CASE WHEN first_id < doc_id THEN 16 ELSE 0 END AS mask
        FROM split
    ), flags AS (
        SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
        FROM labels GROUP BY doc_id
    ), cells AS (
        SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
        FROM masked LEFT JOIN flags USING (doc_id) GROUP BY part, mask
    ), names(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
    ), orders AS (
        SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM names a, names b, names c, names d, names e
        WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
    ), steps AS (
        SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS earlier
        FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
    ), counted AS (
        SELECT part, filter_order, step, bit,
            sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM cells, steps GROUP BY part, filter_order, step, bit
    )
    SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
        CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
        CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted
    """,
}

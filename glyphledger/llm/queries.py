"""Registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op07_simhash import near_groups

    groups = near_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op09_language import Profiles, held_out, language, learn_profiles, training_rows

    docs = documents(spark, sf_dir)
    profiles = Profiles.collect(learn_profiles(training_rows(docs)))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language(profiles, F.col("text")).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op02_packing import pack_documents

    return pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


@query(
    # Every window as a list of words, counted; covered words go.
    """
    WITH words AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), windows AS (
      SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)
    ), repeated AS (
      SELECT s FROM windows GROUP BY s HAVING count(*) > 1
    ), covered AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows JOIN repeated USING (s)
    ), gone AS (
      SELECT doc_id, list(i) AS g FROM covered GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
      sha256(array_to_string(list_filter(w, lambda x, i: g IS NULL OR NOT list_contains(g, i)), ' ')) AS kept_sha256
    FROM words LEFT JOIN gone USING (doc_id)
    """
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op03_substrings import digest_kept

    return digest_kept(documents(spark, sf_dir))


@query()
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op05_personal import personal_data

    return personal_data(documents(spark, sf_dir))


@query()
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op08_fingerprints import fingerprint_neighbours

    return fingerprint_neighbours(documents(spark, sf_dir))


@query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op10_licenses import license_scan

    return documents(spark, sf_dir).select("doc_id", license_scan(F.col("text")).alias("s")).select("doc_id", "s.*")


@query()
def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op06_language_model import score_documents

    return score_documents(documents(spark, sf_dir))


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op04_sentencepiece import checked

    return checked(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


@query(
    # Every pair, then the least vector reachable over links.
    """
    WITH RECURSIVE good AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
      SELECT a.vec_id AS u, b.vec_id AS w FROM good a JOIN good b
      ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
    ), reach AS (
      SELECT vec_id AS u, vec_id AS w FROM embeddings
      UNION
      SELECT reach.u, links.w FROM reach JOIN links ON reach.w = links.u
    ), least AS (
      SELECT u, min(w) AS component_id FROM reach GROUP BY u
    ), degree AS (
      SELECT u, count(*) AS n FROM links GROUP BY u
    )
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON vec_id = least.u LEFT JOIN degree ON vec_id = degree.u
    """
)
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op01_embeddings import near_vectors

    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _quality_sql() -> str:
    """The same measures over word and line lists, and the threshold table as conditions."""
    from glyphledger.llm import op11_quality as q

    conditions = []
    for r in q.RULES:
        value = f"{r.measure}::DOUBLE" if r.per is None else f"CASE WHEN {r.per} > 0 THEN {r.measure}::DOUBLE / {r.per} ELSE 0 END"
        low = [] if r.low is None else [f"({value}) >= {r.low}"]
        high = [] if r.high is None else [f"({value}) <= {r.high}"]
        conditions.append((r.name, " AND ".join(low + high)))
    stops = ", ".join(f"'{w}'" for w in q.STOP_WORDS)
    names = ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in conditions)
    return f"""
    WITH read AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
    ), cut AS (
      SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
      FROM read
    ), windows AS (
      SELECT r, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM cut)
    ), again AS (
      SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1
    ), covered AS (
      SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
    ), measured AS (
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word,
        len(regexp_extract_all(t, '[!?]')) AS n_shouts,
        len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) AS n_loud_words,
        len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
        len(ls) AS n_lines, len(list_filter(ls, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullet_lines,
        len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$'))) AS n_ellipsis_lines
      FROM cut LEFT JOIN covered USING (r)
    ), judged AS (
      SELECT *, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED} * n_words AS base_failed,
        array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ',') AS failed_rules
      FROM measured
    )
    SELECT doc_id, {", ".join(q.BASE)}, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM judged
    """


@query(_quality_sql())
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op11_quality import quality_report

    return quality_report(documents(spark, sf_dir))


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op12_alignment import link_report

    return link_report(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphledger.llm.op13_runs import run_digests

    return run_digests(documents(spark, sf_dir))

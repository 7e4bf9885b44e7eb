"""Registered queries of these operators, and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.llm import centroid_clusters, license_scan, ranked_search
from regiopanel.llm.exact_dedup import exact_dedup
from regiopanel.llm.jaccard_join import jaccard_join
from regiopanel.llm.language_id import identify, labelled_sample
from regiopanel.llm import pii, secret_scan, sentencepiece_codec
from regiopanel.llm.line_dedup import line_classes
from regiopanel.llm.packing import pack
from regiopanel.llm.quality_rules import judge
from regiopanel.llm.token_counts import count_tokens
from regiopanel.session import fresh_path, stored

PACK_TOKENIZER, PACK_END = "word_bpe_49k.json", 2
COUNT_MODEL, COUNT_LIMIT = "piece_bpe_32k.model", 4096


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.encode(documents(spark, folder), public_tokenizers.path(COUNT_MODEL))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(documents(spark, folder))


OP2_SQL = r"""
with texts as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
    from documents
), copies as (
    select text_sha256, min(doc_id) as keep_id, count(*) as group_size from texts group by 1
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from texts join copies using (text_sha256)
"""


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    samples = labelled_sample(docs.filter(~held_out))
    found = identify(docs, samples)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(documents(spark, folder))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_tokens(
        documents(spark, folder), public_tokenizers.path(COUNT_MODEL), fresh_path(spark, "token-counts")
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > COUNT_LIMIT).alias("over_limit"))


def _base_spans(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_private(documents(spark, folder))
    base = F.filter("spans", lambda s: s["base"])
    counts = [_base_spans(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    digest = F.sha2(pii.listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.listed(F.col("spans")).alias("spans"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_classes(documents(spark, folder))


def op8_pack_documents(docs: DataFrame) -> DataFrame:
    return pack(docs, public_tokenizers.path(PACK_TOKENIZER), PACK_END)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return op8_pack_documents(documents(spark, folder))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    base = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(documents(spark, folder)).select("doc_id", "n_words", *base, "base_failed", "kept", "p_bad")


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = stored(secret_scan.candidates(documents(spark, folder)), "candidates")
    scored = secret_scan.scan(found, secret_scan.labels(found))
    digest = F.sha2("value", 256).alias("value_sha256")
    return scored.select("doc_id", "start", "end", digest, "p_secret", "is_secret")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


OP11_SQL = r"""
with words as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), lengths as (
    select doc_id, count(*) as n from words group by doc_id
), totals as (
    select count(*) as documents, cast(sum(n) as bigint) as terms from lengths
), norms as (
    select doc_id, 50 + (50 * n * documents) // terms as m from lengths, totals
), postings as (
    select term, doc_id, count(*) as tf from words where term in (select term from asked) group by term, doc_id
), weights as (
    select term, cast(floor(1000 * ln((2 * max(documents) + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
    from postings, totals group by term
), scores as (
    select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
    from asked join weights using (term) join postings using (term) join norms using (doc_id)
    group by item_id, doc_id
), ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
        doc_id, score
    from scores where score > 0
)
select * from ranked where rank <= 50
"""


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, folder)).drop("matches")


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _clusters_sql(centroids: int, rounds: int) -> str:
    """One step of the SQL for each round; floor division, as ``//`` cuts towards zero."""
    steps = [
        """kept as (
    select vec_id, embedding from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), parts as (
    select vec_id, i, cast(floor(1024 * cast(embedding[i] as double)) as bigint) as x
    from kept, range(1, 65) places(i)
), seeds as (
    select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as c from kept
), c0 as (
    select cast(c as integer) as c, i, x from seeds join parts using (vec_id) where c < %d
)"""
        % centroids
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""d{r} as materialized (
    select vec_id, c, cast(sum((p.x - q.x) * (p.x - q.x)) as bigint) as d
    from parts p join c{r} q using (i) group by vec_id, c
), a{r} as materialized (
    select vec_id, d.c as cluster, d as distance from d{r} d
    qualify row_number() over (partition by vec_id order by d, c) = 1
)"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} as (
    select cluster as c, i, cast(sum(x) as bigint) as s, count(*) as n
    from a{r} join parts using (vec_id) group by cluster, i
), c{r + 1} as materialized (
    select c, i, coalesce((s - ((s % n) + n) % n) // n, x) as x from c{r} left join m{r} using (c, i)
)"""
            )
    return (
        "with "
        + ", ".join(steps)
        + f""", digests as (
    select c as cluster, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256 from c{rounds} group by c
), sums as (
    select cluster, cast(sum(distance) as bigint) as cluster_inertia from a{rounds} group by cluster
)
select vec_id, cluster, distance, cluster_inertia, (select cast(sum(distance) as bigint) from a{rounds}) as inertia,
    centroid_sha256
from a{rounds} join digests using (cluster) join sums using (cluster)
"""
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_sentencepiece,
        op2_exact_dedup,
        op3_language_id,
        op4_jaccard_join,
        op5_token_counts,
        op6_pii,
        op7_line_dedup,
        op8_packing,
        op9_quality_rules,
        op10_secret_scan,
        op11_ranked_search,
        op12_license_scan,
        op13_centroid_clusters,
    )
}
SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op11_ranked_search": OP11_SQL,
    "op13_centroid_clusters": _clusters_sql(centroid_clusters.CENTROIDS, centroid_clusters.ROUNDS),
}

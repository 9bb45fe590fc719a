"""Registered queries: each operator over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, decontaminate, language, licenses, lines, merkle, near_vectors, pieces, private, quality, shingle_join, token_counts, toxicity
from .common import crc_mod, read

Query = Callable[[SparkSession, str], DataFrame]
MODEL = "piece_bpe_32k.model"
BYTE_LEVEL = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096


def tokenizer(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.fit_language_model(docs.filter(crc_mod(F.col("doc_id"), 4) != 2), F.col("text"), F.col("lang"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out")
    return language.identify(docs.select("doc_id", "text", held_out), language_model(docs)).drop("text")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(read(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").filter(crc_mod(F.col("doc_id"), 5) != 0)
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    return scored.withColumn("held_out", crc_mod(F.col("doc_id"), 5) == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain of ``toxic``, as the table marks it, and ``severe``, graded from the toxic training rows.

    Trained on labelled documents whose crc32(doc_id) mod 5 is not 0; ``held_out`` marks the rest.
    """
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").filter(crc_mod(F.col("doc_id"), 5) != 0)
    chain = toxicity.fit_toxicity(docs, labels, ("toxic",), graded="severe")
    return toxicity.score_toxicity(docs, chain).withColumn("held_out", crc_mod(F.col("doc_id"), 5) == 0)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(read(spark, sf_dir, "documents"), tokenizer())


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private.find_private(read(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in private.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read(spark, sf_dir, "documents"), tokenizer(BYTE_LEVEL), tokenizer()).documents


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_embedding_near_dedup": op1_embedding_near_dedup,
        "op2_language_id": op2_language_id,
        "op3_token_counts": op3_token_counts,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_toxicity": op6_toxicity,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_decontamination": op8_decontamination,
        "op9_line_dedup": op9_line_dedup,
        "op10_license_scan": op10_license_scan,
        "op11_personal_data": op11_personal_data,
        "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


LINE_DEDUP_SQL = r"""
with doc_lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
), keyed as (
    select doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from doc_lines
), common as (
    select key, max(doc_id) as keeper from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5
), marked as (
    select k.doc_id, k.pos, k.line, c.key is not null and c.keeper <> k.doc_id as dropped
    from keyed k left join common c on k.key = c.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": EMBEDDING_SQL,
        "op4_ngram_jaccard_join": JACCARD_SQL,
        "op9_line_dedup": LINE_DEDUP_SQL,
        "op13_merkle_manifest": MERKLE_SQL,
    }


EMBEDDING_SQL = """
with recursive vectors as (
    select vec_id, cast(embedding as double[]) as v from embeddings
    where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.95
), reach as (
    select a as node, a as spot from links
    union
    select r.node, l.b from reach r join links l on l.a = r.spot
), found as (select node, min(spot) as component from reach group by node),
degree as (select a, count(distinct b) as n from links group by a)
select e.vec_id, coalesce(d.n, 0) as n_links, coalesce(f.component, e.vec_id) as component_id,
       e.vec_id = coalesce(f.component, e.vec_id) as kept
from embeddings e left join degree d on d.a = e.vec_id left join found f on f.node = e.vec_id
"""

JACCARD_SQL = r"""
with recursive doc_words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents
), sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [list_aggregate(w, 'string_agg', ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i : i + 4], 'string_agg', ' '))) end as s
    from doc_words
), shingle as (select doc_id, len(s) as size, unnest(s) as g from sets),
pairs as (
    select a.doc_id as a, b.doc_id as b, any_value(a.size) as na, any_value(b.size) as nb, count(*) as shared
    from shingle a join shingle b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
), links as (select a, b from pairs where 100 * shared >= 75 * (na + nb - shared)),
reach as (
    select a as node, a as spot from links
    union
    select r.node, l.b from reach r join links l on l.a = r.spot
), found as (select node, min(spot) as component from reach group by node)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(f.component, s.doc_id) as component_id
from sets s left join found f on f.node = s.doc_id
"""

# Levels of the sources' trees are hashed until one node is left, then the sources' subroots alike.
# A path holds the siblings as (left, right) texts; the CRC runs over the bits of the id's digits.
MERKLE_SQL = r"""
with recursive fields as (
    select doc_id, source, text,
           case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end
           || case when source is null then '-' else strlen(source) || ':' || source end
           || case when lang is null then '-' else strlen(lang) || ':' || lang end
           || case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end as head
    from documents
), hashed as (
    select doc_id, source, sha256(head || case when text is null then '-' else strlen(text) || ':' || text end) as leaf,
           sha256(head || case when text is null then '-'
                  else strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '') end) as other,
           list_reduce(flatten(list_transform(range(1, length(doc_id::varchar) + 1),
                lambda i: list_transform(range(0, 8), lambda k: (ascii(substr(doc_id::varchar, i, 1)) >> k) & 1))),
                lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::bigint) as crc
    from fields
), leaves as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
           count(*) over (partition by source) as n from hashed
), nodes as (
    select source, 0 as level, pos, n, leaf as digest from leaves
    union all
    select source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
    from nodes where n > 1 group by source, level, pos // 3, n
), subroots as (
    select source, digest, row_number() over (order by source is not null, encode(source)) - 1 as pos, count(*) over () as n
    from nodes where n = 1
), tops as (
    select 0 as level, pos, n, digest from subroots
    union all
    select level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
    from tops where n > 1 group by level, pos // 3, n
), climbs as (
    select l.doc_id, l.source, l.pos as leaf_pos, l.leaf, 0 as level, l.pos, [] :: struct(a varchar, b varchar)[] as path from leaves l
    union all
    select c.doc_id, c.source, c.leaf_pos, c.leaf, c.level + 1, c.pos // 3, list_append(c.path, {'a': coalesce(
             (select string_agg(x.digest, '' order by x.pos) from nodes x where x.source is not distinct from c.source
              and x.level = c.level and x.pos // 3 = c.pos // 3 and x.pos < c.pos), ''), 'b': coalesce(
             (select string_agg(x.digest, '' order by x.pos) from nodes x where x.source is not distinct from c.source
              and x.level = c.level and x.pos // 3 = c.pos // 3 and x.pos > c.pos), '')})
    from climbs c join nodes m on m.source is not distinct from c.source and m.level = c.level and m.pos = c.pos and m.n > 1
), high as (
    select pos as top_pos, 0 as level, pos, [] :: struct(a varchar, b varchar)[] as path from subroots
    union all
    select h.top_pos, h.level + 1, h.pos // 3, list_append(h.path, {'a': coalesce(
             (select string_agg(x.digest, '' order by x.pos) from tops x
              where x.level = h.level and x.pos // 3 = h.pos // 3 and x.pos < h.pos), ''), 'b': coalesce(
             (select string_agg(x.digest, '' order by x.pos) from tops x
              where x.level = h.level and x.pos // 3 = h.pos // 3 and x.pos > h.pos), '')})
    from high h join tops m on m.level = h.level and m.pos = h.pos and m.n > 1
), whole as (
    select l.doc_id, l.leaf, s.digest as subroot, (select digest from tops where n = 1) as root,
           list_concat(c.path, h.path) as path,
           case when xor(l.crc, 4294967295) % 2 = 0 then l.other else l.leaf end as start
    from leaves l
    join (select * from climbs qualify level = max(level) over (partition by source)) c
      on c.source is not distinct from l.source and c.leaf_pos = l.pos
    join subroots s on s.source is not distinct from l.source
    join (select * from high qualify level = max(level) over ()) h on h.top_pos = s.pos
), folded as (
    select *, list_reduce(list_prepend({'a': start, 'b': ''}, path),
                          lambda x, y: {'a': sha256(y.a || x.a || y.b), 'b': ''}).a as folded_root from whole
)
select doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(path, lambda p: p.a || p.b), '')) as proof_sha256,
       folded_root, folded_root = root as verified
from folded
"""

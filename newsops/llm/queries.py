"""One query for each operator of this subpackage, with production parameters,
and the SQL of those that SQL can express."""
from __future__ import annotations

from pyspark.sql import functions as F

from newsops.llm import alignment as AL, decontaminate as DC, jaccard as JJ, langid as LI, mixture as MX, neighbours as NN, passages as PS, periods as PE, pieces as PI, quality as QL, secrets as SE, suffixes as SF, tokens as TK

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, d, name, *columns):
    return spark.read.parquet(f"{d}/{name}.parquet").select(*columns)


@query
def op1_mix_sources(spark, d):
    return MX.mix(table(spark, d, "documents", "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op2_quality(spark, d):
    return QL.classify(table(spark, d, "documents", "doc_id", "text", "lang"),
                       table(spark, d, "labels", "doc_id", "quality", "toxic"))


@query
def op3_secret_scan(spark, d):
    return SE.digest(SE.scan(table(spark, d, "documents", "doc_id", "text")))


@query
def op4_language_id(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang").withColumn("held_out", LI.held_out("doc_id"))
    model = LI.fit(docs.where("not held_out"))
    return LI.identify(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


@query
def op5_token_counts(spark, d):
    return TK.suffix_sums(TK.lengths(table(spark, d, "documents", "text")))


@query
def op6_substring_dedup(spark, d):
    return PS.deduplicate(table(spark, d, "documents", "doc_id", "text"), with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op7_decontaminate(spark, d):
    return DC.digest(DC.decontaminate(table(spark, d, "documents", "doc_id", "text"),
                                      table(spark, d, "benchmark", "item_id", "text")))


@query
def op8_suffix_dedup(spark, d):
    return SF.deduplicate(table(spark, d, "documents", "doc_id", "text"), with_text=False).select(
        "doc_id", "n_bytes", "n_removed", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256")


@query
def op9_jaccard_join(spark, d):
    return JJ.join(table(spark, d, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@query
def op10_nearest_vectors(spark, d):
    vectors = table(spark, d, "embeddings", "vec_id", "embedding")
    return NN.search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op11_pieces(spark, d):
    return PI.digest(PI.decode(PI.encode(table(spark, d, "documents", "doc_id", "text"))))


@query
def op12_token_alignment(spark, d):
    return AL.digest(AL.align(table(spark, d, "documents", "doc_id", "text"), notation=True))


@query
def op13_periodic_runs(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    return PE.digest(PE.periodic_runs(docs.withColumn("text", PE.planted(F.col("doc_id"), F.col("text")))))


LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL["op7_decontaminate"] = f"""
with d as (select doc_id, {WORDS.format(LOWERED.format('text'))} as w from documents),
b as (select distinct item_id::varchar as item, {WORDS.format(LOWERED.format('text'))} as w from benchmark),
bw as (select distinct item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as g
  from (select *, least(10, len(w)) as n from b where len(w) > 0)),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw))),
hits as (select doc_id, i, n, item from dw join bw using (n, g)),
places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
whose as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join places using (doc_id) left join whose using (doc_id)"""

BLANK_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D\\x20]+')"
SQL["op6_substring_dedup"] = f"""
with d as (select doc_id, {BLANK_WORDS} as w from documents),
s as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as g
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d)),
f as (select g, min(doc_id) as least from s group by 1),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 50)) as p from s join f using (g) where doc_id > least)),
words as (select doc_id, p, w[p] as x from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d)),
kept as (select doc_id, string_agg(x, ' ' order by p) as t from words anti join gone using (doc_id, p) group by 1),
n as (select doc_id, count(*) as n from gone group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)"""

"""Joins, aggregates, deduplication, sampling, set operations."""
from __future__ import annotations

from pyspark.sql import functions as F

from newsops import vocab
from newsops.functions import codes as C, lexicon as X, scores as S, text as T
from newsops.operators import correlate, dedup, dictionary, gate, metrics, ranking, sampling, stats
from newsops.plans import datasets as P
from newsops.session import materialise
from newsops.sources import files
from workload.q_expressions import _PARSED, S_QUALITY, S_THRESHOLD
from workload.registry import query
from workload.views import (
    CFG, CLEAN, COMPANY, COUNTRIES, DATED, FEED, FEEDS, K, LABELLED, LINED, LONG, MACRO, RUN_DATE,
    SCORED, clean, dated_files, feed, labelled, lined, lit, rules_of, s_any, s_case, s_hash, s_importance, s_list,
    s_rule_codes, s_sentiment, s_strip, scored, table)

CODES = vocab.COMMODITY_CODES
ALLOWED = ["CN:MACHINERY", "BR:COFFEE", "FR:AIRCRAFT", "DE:VEHICLES"]


# ------------------------------------------------------------------- D: joins
def seen_hashes(spark, d):
    """Fingerprints of an earlier run: the titles of toxic-labelled articles."""
    toxic = table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("seq"))
    return feed(spark, d).join(toxic, "seq", "left_semi").select(T.article_hash("title").alias("hash"))


SEEN = f"""seen as (select distinct {s_hash('title')} as hash from feed
  where seq in (select doc_id from labels where toxic = 1))"""


@query("d1_drop_seen", f"""with {FEED}, {SEEN} select seq from (select seq, {s_hash('title')} as hash from feed)
  where hash not in (select hash from seen)""")
def d1(spark, d):
    rows = feed(spark, d).select("seq", T.article_hash("title").alias("hash"))
    return dedup.drop_seen(rows, seen_hashes(spark, d), "hash").select("seq")


@query("d2_whitelist", f"""with {LABELLED} select doc_id, array_to_string(list_filter({_PARSED},
  lambda c: list_contains({s_list(ALLOWED)}, c)), ';') as codes from labelled""")
def d2(spark, d):
    return labelled(spark, d).select("doc_id", C.join_codes(
        C.whitelist(C.parse_codes("correlations"), ALLOWED)).alias("codes"))


@query("d3_detect_countries", "select doc_id, array_to_string(list_sort(list_distinct(list_filter(["
       + ", ".join(f"case when contains(lower(text), {lit(n)}) then {lit(c)} end" for n, c in COUNTRIES.items())
       + "], lambda x: x is not null))), ',') as countries from documents")
def d3(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(
        F.array_sort(X.detect_countries("text", COUNTRIES)), ",").alias("countries"))


@query("d4_rule_codes", f"select doc_id, array_to_string({s_rule_codes('lower(text)')}, ';') as codes from documents")
def d4(spark, d):
    return table(spark, d, "documents").select("doc_id", C.join_codes(rules_of()).alias("codes"))


# Dictionaries of the benchmark's words (thousands of terms), exports from the trade tables.
S_TERMS = """terms as (select distinct unnest(string_split(lower(text), ' ')) as term from benchmark),
  names as (select term, 'C' || substr(md5(term), 1, 1) as code from terms where length(term) >= 7),
  keywords as (select term, 'P' || substr(md5(term), 2, 1) as product from terms where length(term) >= 7)"""
S_EXPORTS = """exports as (select distinct 'C' || lower(to_hex(s_nationkey % 16)) as country, 'P' || lower(to_hex(p_size % 16)) as product
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey where (s_nationkey + p_size) % 3 < 2)"""
S_TABLE_CODES = f"""{S_TERMS}, {S_EXPORTS},
  c as (select distinct doc_id, code as country from documents join names on contains(lower(text), term)),
  p as (select distinct doc_id, product from documents join keywords on contains(lower(text), term)),
  eligible as (select doc_id from documents where {s_any('lower(text)', MACRO)} and not {s_any('lower(text)', COMPANY)}),
  found as (select doc_id, country || ':' || product as code from c join exports using (country) join p using (doc_id, product)
    where doc_id in (select doc_id from eligible))"""


def term_tables(spark, d):
    """(names, keywords) of the benchmark's words."""
    words = F.explode(F.split(F.lower("text"), " ")).alias("term")
    terms = materialise(table(spark, d, "benchmark").select(words).distinct().where(F.length("term") >= 7), "terms")
    mark = lambda k, at: F.concat(F.lit(k), F.substring(F.md5("term"), at, 1))
    return terms.select("term", mark("C", 1).alias("code")), terms.select("term", mark("P", 2).alias("product"))


def table_codes(spark, d):
    """(doc_id, codes) by rules whose dictionaries are tables."""
    names, keywords = term_tables(spark, d)
    digit = lambda k, c: F.concat(F.lit(k), F.lower(F.hex(F.col(c) % 16)))
    sold = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    exports = (sold.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
               .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
               .select(digit("C", "s_nationkey").alias("country"), digit("P", "p_size").alias("product"),
                       F.element_at(F.array(*map(F.lit, ("pivot", "major", "minor"))), ((F.col("s_nationkey") + F.col("p_size")) % 3 + 1).cast("int")).alias("impact"))
               .distinct())
    words = lambda ws: spark.createDataFrame([(w,) for w in ws], "term string")
    return dictionary.rule_codes(table(spark, d, "documents"), "doc_id", "text", names, exports, keywords, words(COMPANY), words(MACRO))


@query("d3_country_table", f"""with {S_TERMS}, c as (select distinct doc_id, code from documents join names on contains(lower(text), term))
  select doc_id, count(code) as n, md5(coalesce(string_agg(code, ',' order by code), '')) as countries
  from documents left join c using (doc_id) group by doc_id""")
def d3_table(spark, d):
    """Country names as a table of thousands of terms."""
    found = dictionary.detect_countries(table(spark, d, "documents"), "doc_id", "text", term_tables(spark, d)[0])
    return found.select("doc_id", F.size("countries").cast("long").alias("n"), F.md5(F.array_join("countries", ",")).alias("countries"))


@query("d4_rule_code_tables", f"""with {S_TABLE_CODES} select doc_id, count(code) as n, md5(coalesce(string_agg(code, ';' order by code), '')) as codes
  from documents left join found using (doc_id) group by doc_id""")
def d4_tables(spark, d):
    return table_codes(spark, d).select("doc_id", F.size("codes").cast("long").alias("n"), F.md5(C.join_codes("codes")).alias("codes"))


@query("k2_dictionary_tables", f"with {S_TABLE_CODES} select code, count(*) as n from found group by code")
def k2_tables(spark, d):
    return correlate.code_counts(table_codes(spark, d), "codes")


def _dictionary(spark, d):
    """Exposure dictionary derived from the trade tables: a code per supplier
    nation and part brand that lineitem links, the region as category, the
    supplier's nation as exporter, the direction from the part size."""
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    nations = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sold = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    rows = (sold.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey")))
    return rows.groupBy(F.concat(F.lit("N"), F.col("n_nationkey"), F.lit(":"), F.col("p_brand")).alias("code")).agg(
        F.min("r_name").alias("category"), F.array_sort(F.collect_set("n_name")).alias("exporters"),
        F.when(F.max("p_size") > 48, "price_increase").otherwise("price_decrease").alias("direction"))


TRADE = """dictionary as (select 'N' || n_nationkey || ':' || p_brand as code, min(r_name) as category,
    n_name as exporter, case when max(p_size) > 48 then 'price_increase' else 'price_decrease' end as direction
  from (select distinct l_partkey, l_suppkey from lineitem) join part on l_partkey = p_partkey
  join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey group by n_nationkey, p_brand, n_name),
  coded as (select l_orderkey, l_linenumber, 'N' || s_nationkey || ':' || p_brand as code
    from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey)"""


def _coded(spark, d):
    item = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return (item.join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .join(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"),
                  F.col("l_suppkey") == F.col("s_suppkey"))
            .select("l_orderkey", "l_linenumber", F.concat(
                F.lit("N"), F.col("s_nationkey"), F.lit(":"), F.col("p_brand")).alias("code")))


@query("d5_code_category", f"""with {TRADE} select category, count(*) as n, count(distinct code) as codes
  from coded join dictionary using (code) group by category""")
def d5(spark, d):
    return correlate.with_category(_coded(spark, d), _dictionary(spark, d)).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("codes"))


@query("d6_code_exporters", f"""with {TRADE} select exporter, count(*) as n from coded
  join dictionary using (code) group by exporter""")
def d6(spark, d):
    return correlate.with_exporters(_coded(spark, d), _dictionary(spark, d)).groupBy("exporter").agg(
        F.count(F.lit(1)).alias("n"))


@query("d7_code_direction", f"""with {TRADE} select direction, count(*) as n from coded
  join dictionary using (code) group by direction""")
def d7(spark, d):
    return correlate.with_direction(_coded(spark, d), _dictionary(spark, d)).groupBy("direction").agg(
        F.count(F.lit(1)).alias("n"))


_EXPO = ", ".join(f"({lit(c)}, {lit(cat)}, {lit(dr)}, {len(e)})" for c, cat, e, dr in vocab.EXPOSURES)


@query("d5_shipped_exposures", f"""with {LABELLED}, expo(code, category, direction, exporters) as (values {_EXPO})
  select doc_id, code, category, direction, exporters::bigint as exporters from (
    select doc_id, unnest({_PARSED}) as code from labelled) join expo using (code)""")
def d5_shipped(spark, d):
    rows = C.each_code(labelled(spark, d).withColumn("codes", C.parse_codes("correlations")), "codes", "doc_id")
    return rows.join(correlate.exposure_table(spark), "code").select(
        "doc_id", "code", "category", "direction", F.size("exporters").cast("bigint").alias("exporters"))


@query("d8_choose_codes", f"""with {LABELLED} select doc_id, array_to_string(case when len(model) > 0 then model
    else rules end, ';') as codes from (select doc_id, {_PARSED} as model,
      {s_rule_codes('lower(text)')} as rules from labelled)""")
def d8(spark, d):
    rows = labelled(spark, d).select("doc_id", C.parse_codes("correlations").alias("m"), rules_of().alias("r"))
    return rows.select("doc_id", C.join_codes(correlate.choose_codes("m", "r")).alias("codes"))


# -------------------------------------------------------------- E: aggregates
S_ENRICHED = f"""enriched as (select seq, title, text, source, source_type, label, importance, codes,
    {S_QUALITY} as quality_score from (
  select seq, title, text, source, source_type, {s_sentiment('lower(text)')} as label,
    {s_importance('lower(text)')} as importance, {s_rule_codes('lower(text)')} as codes from (
  select seq, title, {s_strip("title || '. ' || content")} as text, coalesce(nullif(site, ''), publisher, 'FMP')
    as source, source_type from (select * replace (coalesce(nullif(text, ''), content, '') as content) from feed)
  where title <> '' and content <> '')))"""
ENRICHED = f"{FEED}, {S_ENRICHED}"


def enriched(spark, d):
    return P.enrich(feed(spark, d), CFG)


@query("e1_label_distribution", f"""with {ENRICHED} select label, importance, n,
    round(n * 100.0::double / sum(n) over (), 6) as pct
  from (select label, importance, count(*) as n from enriched group by all)""")
def e1(spark, d):
    rows = enriched(spark, d).withColumn("pair", F.struct("label", "importance"))
    return stats.distribution(rows, "pair").select("pair.label", "pair.importance", "n", "pct")


@query("e1_distribution_by_file", f"""with {LABELLED} select file, label, n,
    round(n * 100.0::double / sum(n) over (partition by file), 6) as pct
  from (select file, label, count(*) as n from labelled group by all)""")
def e1_file(spark, d):
    return stats.distribution(labelled(spark, d), "label", "file")


_EXPLODED = f"select unnest({_PARSED}) as code from labelled"


@query("e2_top_codes", f"""with {LABELLED} select code, count(*) as n from ({_EXPLODED}) group by code
  order by n desc, code limit 20""")
def e2(spark, d):
    return stats.code_stats(labelled(spark, d).withColumn("correlations", C.parse_codes("correlations")))


@query("e2_code_totals", f"""with {LABELLED} select count(*) as total_correlations,
  count(distinct code) as unique_correlations from ({_EXPLODED})""")
def e2_totals(spark, d):
    return stats.code_totals(labelled(spark, d).withColumn("correlations", C.parse_codes("correlations")))


@query("e3_code_coverage", f"""with {ENRICHED} select count(*) as articles, count(*) filter (len(codes) > 0)
  as with_codes, round(count(*) filter (len(codes) > 0) * 100.0::double / count(*), 6) as pct from enriched""")
def e3(spark, d):
    return stats.coverage(enriched(spark, d))


@query("e4_review_counts", f"""with {SCORED} select count(*) filter (r) as needs_review_articles,
  count(*) filter (not r) as high_confidence_articles
  from (select probs[1] < 0.75 or probs[2] < 0.75 as r from scored)""")
def e4(spark, d):
    from newsops.functions.labels import needs_review

    return stats.review_counts(scored(spark, d).select(needs_review(
        F.element_at("probs", 1), F.element_at("probs", 2)).alias("needs_review")))


@query("e5_length_stats", f"""with {LABELLED} select file, round(avg(length(text)), 6) as avg_text_length,
  max(length(text)) as max_text_length, min(length(text)) as min_text_length from labelled group by file""")
def e5(spark, d):
    return stats.length_stats(labelled(spark, d), "file")


@query("e6_duplicate_count", f"""with {LABELLED} select file, count(text) - count(distinct text) as duplicates
  from labelled group by file""")
def e6(spark, d):
    return dedup.duplicate_counts(labelled(spark, d), "file")


@query("e6_duplicate_count_all", "select count(text) - count(distinct text) as duplicates from documents")
def e6_all(spark, d):
    return dedup.duplicate_counts(table(spark, d, "documents"))


@query("e7_duplicate_lines", """with lined as (select lang as file, text,
    row_number() over (partition by lang order by doc_id) + 1 as line_number from documents)
  select file, md5(text) as text_key, line_number, group_size, first_line from (
    select *, count(*) over (partition by file, text) as group_size,
      min(line_number) over (partition by file, text) as first_line from lined) where group_size > 1""")
def e7(spark, d):
    rows = files.with_line_number(table(spark, d, "documents").withColumn("file", F.col("lang")), "file", "doc_id")
    return dedup.duplicate_lines(rows, "file")


@query("e8_run_metadata", f"""with {ENRICHED}, tops as (select code, count(*) as n from (
      select unnest(codes) as code from enriched) group by code)
  select 'news_20240115.csv' as filename, count(*) as article_count,
    (select string_agg(label || '=' || n, ';' order by label) from
      (select label, count(*) as n from enriched group by label)) as label_distribution,
    (select string_agg(importance || '=' || n, ';' order by importance) from
      (select importance, count(*) as n from enriched group by importance)) as importance_distribution,
    (select string_agg(code || '=' || n, ';' order by code) from tops) as correlation_distribution,
    (select sum(n)::bigint from tops) as total_correlations, (select count(*) from tops) as unique_correlations,
    0::bigint as needs_review_articles, count(*) as high_confidence_articles from enriched""")
def e8(spark, d):
    row = stats.run_metadata(enriched(spark, d), "news_20240115.csv", RUN_DATE, "feed")

    def flat(name):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias(name)

    return row.select("filename", "article_count", flat("label_distribution"), flat("importance_distribution"),
                      flat("correlation_distribution"), "total_correlations", "unique_correlations",
                      "needs_review_articles", "high_confidence_articles")


_LOW = f"lower({s_strip('label')})"


@query("e11_label_audit", f"""with {LABELLED}
  select 'raw' as kind, label as value, count(*) as n from labelled where label is not null group by label
  union all select 'lowered', lower(label), count(*) from labelled where label is not null group by lower(label)
  union all select 'unexpected', {_LOW}, count(*) from labelled where label is not null
    and {_LOW} not in ('negative', 'neutral', 'positive') group by {_LOW}
  union all select 'absent', value, 0 from (values ('negative'), ('neutral'), ('positive')) t(value)
    where value not in (select {_LOW} from labelled where label is not null)
  union all select 'usable', 'rows', count(*) from labelled where text <> ''
    and {_LOW} in ('negative', 'neutral', 'positive')""")
def e11(spark, d):
    return stats.label_audit(labelled(spark, d), vocab.SENTIMENT_IDS)


@query("e12_class_weights", f"""with {CLEAN}, c as (select {s_case('label', vocab.SENTIMENT_IDS, 'null')} as class,
    count(*) as n from clean group by 1)
  select class, round(coalesce((select sum(n) from c)::double / ((select count(*) from c) * n), 1.0), 6) as weight
  from range(3) r(class) left join c using (class)""")
def e12(spark, d):
    rows = P.standardise(clean(spark, d))
    return metrics.class_weights(rows, "label").select(
        F.col("class").cast("bigint").alias("class"), F.round("weight", 6).alias("weight"))


@query("e13_positive_weights", f"""with {LONG} select (i - 1)::bigint as code, sum(y) as positives,
    round(least(50.0, greatest(1.0, (count(*) - sum(y)) / greatest(sum(y), 1.0))), 6) as weight
  from long group by i""")
def e13(spark, d):
    return metrics.positive_weights(scored(spark, d), "truth").select(
        F.col("code").cast("bigint").alias("code"), "positives", F.round("weight", 6).alias("weight"))


@query("e14_label_density", f"""with {LONG} select max(n) as rows, sum(s) as positives,
    count(*) filter (s > 0) as active_codes, count(*) filter (s = 0) as empty_codes
  from (select i, count(*) as n, sum(y) as s from long group by i)""")
def e14(spark, d):
    return metrics.label_density(scored(spark, d), "truth")


def predictions(spark, d):
    e = table(spark, d, "embeddings")
    first = F.slice("embedding", 1, 10)
    return e.select("vec_id", "label", (F.array_position(first, F.array_max(first)) - 1).cast("int").alias("pred"),
                    F.array_max(first).cast("double").alias("confidence"), "embedding")


PRED = """pred as (select vec_id, label, list_position(embedding[1:10], list_max(embedding[1:10])) - 1 as pred,
    list_max(embedding[1:10])::double as confidence, embedding from embeddings)"""
PER_CLASS = f"""{PRED}, per as (select c, coalesce(tp, 0) as tp, coalesce(ps, 0) as ps, coalesce(sup, 0) as sup,
    case when coalesce(ps, 0) = 0 then 0.0::double else coalesce(tp, 0)::double / ps end as p,
    case when coalesce(sup, 0) = 0 then 0.0::double else coalesce(tp, 0)::double / sup end as r,
    case when coalesce(ps, 0) + coalesce(sup, 0) = 0 then 0.0::double
      else 2.0::double * coalesce(tp, 0) / (coalesce(ps, 0) + coalesce(sup, 0)) end as f
  from (select label as c from pred union select pred from pred)
  left join (select label as c, count(*) as sup, count(*) filter (label = pred) as tp from pred group by 1) using (c)
  left join (select pred as c, count(*) as ps from pred group by 1) using (c)),
  m as (select sum(sup)::bigint as rows, sum(tp)::double / sum(sup) as accuracy, sum(p * sup) / sum(sup) as precision,
    sum(r * sup) / sum(sup) as recall, sum(f * sup) / sum(sup) as f1, avg(p) as precision_macro,
    avg(r) as recall_macro, avg(f) as f1_macro from per)"""
MULTI = ["accuracy", "precision", "recall", "f1", "precision_macro", "recall_macro", "f1_macro"]


def _rounded(names):
    return [F.round(c, 6).alias(c) for c in names]


def _s_rounded(names):
    return ", ".join(f"round({c}, 6) as {c}" for c in names)


@query("e16_multiclass_metrics", f"with {PER_CLASS} select rows, {_s_rounded(MULTI)} from m")
def e16(spark, d):
    return metrics.multiclass_metrics(predictions(spark, d), "label", "pred").select("rows", *_rounded(MULTI))


PER_CODE = f"""{LONG}, decided as (select vec_id, i, y,
    (p > 0.82 or (best <= 0.82 and rn = 1))::int::double as h from (select *, max(p) over (partition by vec_id) as best,
      row_number() over (partition by vec_id order by p desc, i desc) as rn from long)),
  per as (select i, sum(y * h) as tp, sum(h) as ps, sum(y) as sup, count(*) as n from decided group by i),
  mm as (select max(n) as rows,
    case when sum(ps) + sum(sup) = 0 then 0 else 2 * sum(tp) / (sum(ps) + sum(sup)) end as f1_micro,
    case when sum(ps) = 0 then 0 else sum(tp) / sum(ps) end as precision_micro,
    case when sum(sup) = 0 then 0 else sum(tp) / sum(sup) end as recall_micro,
    avg(case when ps + sup = 0 then 0 else 2 * tp / (ps + sup) end) as f1_macro,
    avg(case when ps = 0 then 0 else tp / ps end) as precision_macro,
    avg(case when sup = 0 then 0 else tp / sup end) as recall_macro,
    1 - sum(ps + sup - 2 * tp) / (max(n) * {K}) as hamming_score,
    sum(ps + sup - 2 * tp) / (max(n) * {K}) as hamming_loss,
    (select avg(ok::int) from (select vec_id, bool_and(y = h) as ok from decided group by vec_id))
      as subset_accuracy from per)"""
MULTILABEL = ["f1_micro", "precision_micro", "recall_micro", "f1_macro", "precision_macro", "recall_macro",
              "hamming_score", "hamming_loss", "subset_accuracy"]


def decided(spark, d):
    return scored(spark, d).withColumn("hot", S.predict_multilabel("probs", 0.82))


@query("e17_multilabel_metrics", f"with {PER_CODE} select rows, {_s_rounded(MULTILABEL)} from mm")
def e17(spark, d):
    return metrics.multilabel_metrics(decided(spark, d), "truth", "hot", K).select("rows", *_rounded(MULTILABEL))


WEIGHTS = [1.0, 0.5, 2.0, 1.5, 1.0, 0.8, 1.2, 1.0, 3.0, 0.7]
_CE = f"""ce as (select label, {WEIGHTS}[label + 1]::double as w,
    ln(list_sum(list_transform(x, lambda v: exp(v - list_max(x))))) + list_max(x) - x[label + 1] as ce
  from (select label, list_transform(embedding[1:10], lambda v: v::double) as x from embeddings))"""


@query("e18_loss_weighted", f"with {_CE} select round(sum(w * ce) / sum(w), 6) as loss from ce")
def e18_ce(spark, d):
    rows = table(spark, d, "embeddings").select("label", F.slice("embedding", 1, 10).alias("x"))
    return metrics.loss(rows, "ce", "x", "label", WEIGHTS).select(F.round("loss", 6).alias("loss"))


@query("e18_loss_focal", f"with {_CE} select round(avg(w * pow(1 - exp(-ce), 2.0) * ce), 6) as loss from ce")
def e18_focal(spark, d):
    rows = table(spark, d, "embeddings").select("label", F.slice("embedding", 1, 10).alias("x"))
    return metrics.loss(rows, "focal", "x", "label", WEIGHTS).select(F.round("loss", 6).alias("loss"))


@query("e18_loss_multilabel", f"""with {LONG} select round(avg(l), 6) as loss from (select vec_id, avg(
    (1 + i % 3) * y * ln(1 + exp(-x)) + (1 - y) * (x + ln(1 + exp(-x)))) as l
  from (select l.*, s.embedding[l.i]::double as x from long l join scored s using (vec_id)) group by vec_id)""")
def e18_bce(spark, d):
    weights = [1.0 + (i + 1) % 3 for i in range(K)]
    rows = scored(spark, d).select("truth", F.slice("embedding", 1, K).alias("x"))
    return metrics.loss(rows, "bce", "x", "truth", weights).select(F.round("loss", 6).alias("loss"))


@query("e19_group_summary", """with per as (select user_id, event_type, count(*) as n, min(event_id) as f,
    sum(value::decimal(18, 2)) as v from events group by all)
  select user_id, arg_max(event_type, n * 1e12 - f) as overall_sentiment, sum(v)::double / sum(n) as avg_confidence,
    string_agg(event_type || '=' || n, ';' order by event_type || '=' || n) as distribution,
    sum(n)::bigint as total_analyzed from per group by user_id""")
def e19(spark, d):
    rows = table(spark, d, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    return stats.group_summary(rows, "user_id", "event_type", "value", "event_id")


_BAD_LABEL = "coalesce(label, '') not in ('negative', 'neutral', 'positive')"
_BAD_IMP = "coalesce(importance, '') not in ('générale', 'importante', 'critique')"


@query("e21_repair_report", f"""with {LABELLED} select *, long_texts = 0 and invalid_labels = 0
    and invalid_importances = 0 and duplicates = 0 as is_valid from (
  select file, count(*) filter (length(text) > 512) as long_texts, count(*) filter ({_BAD_LABEL}) as invalid_labels,
    count(*) filter ({_BAD_IMP}) as invalid_importances, round(avg(length(text)), 6) as text_length_avg,
    max(length(text)) as text_length_max, min(length(text)) as text_length_min,
    count(*) - count(distinct text) as duplicates from labelled group by file)""")
def e21(spark, d):
    return stats.repair_report(labelled(spark, d), "file")


@query("e21_two_columns", f"""with {LABELLED} select *, long_texts = 0 and invalid_labels = 0 and duplicates = 0 as is_valid from (
  select file, count(*) filter (length(text) > 512) as long_texts, count(*) filter ({_BAD_LABEL}) as invalid_labels,
    0 as invalid_importances, round(avg(length(text)), 6) as text_length_avg, max(length(text)) as text_length_max,
    min(length(text)) as text_length_min, count(*) - count(distinct text) as duplicates from labelled group by file)""")
def e21_two(spark, d):
    """The oldest datasets have texts and labels only."""
    return stats.repair_report(labelled(spark, d).select("file", "text", "label"), "file")


@query("e21_invalid_labels", f"""with {LABELLED} select label, count(*) as n from labelled where {_BAD_LABEL}
  group by label""")
def e21_labels(spark, d):
    return stats.invalid_values(labelled(spark, d), "label", vocab.SENTIMENTS)


@query("e22_meets_thresholds", f"""with {PER_CLASS} select round(accuracy, 6) as accuracy, round(f1, 6) as f1,
    round(c, 6) as avg_confidence, accuracy >= 0.85 and f1 >= 0.82 and c >= 0.75 as meets
  from m, (select avg(confidence) as c from pred)""")
def e22(spark, d):
    rows = predictions(spark, d)
    row = metrics.multiclass_metrics(rows, "label", "pred").crossJoin(
        rows.agg(F.avg("confidence").alias("avg_confidence")))
    return gate.meets_thresholds(row).select(*_rounded(["accuracy", "f1", "avg_confidence"]), "meets")


# ------------------------------------------------ F: ranking, dedup, sampling
@query("f1_dedup_first", """select min(doc_id) as doc_id, text from documents group by text""")
def f1(spark, d):
    return dedup.dedup_first(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id")


COUNT = 200
QUOTAS = dedup.quotas(FEEDS, COUNT)


def _s_accept() -> str:
    """Acceptance source by source, in the order of the quotas."""
    parts = [f"""cand as (select f.seq, f.source_type, {s_hash('f.title')} as hash from feed f
      where length(title) >= 20 and length(content) >= 100),
    open as (select * from cand where hash not in (select hash from seen))"""]
    before = ""
    for i, (name, n) in enumerate(QUOTAS.items()):
        block = f" and hash not in (select hash from ({before}))" if before else ""
        parts.append(f"""a{i} as (select min(seq) as seq, hash from open where source_type = {lit(name)}{block}
          group by hash order by 1 limit {n})""")
        before = " union all ".join(f"select * from a{j}" for j in range(i + 1))
    parts.append(f"accepted as ({before})")
    return ", ".join(parts)


ACCEPTED = f"{FEED}, {SEEN}, {_s_accept()}"


@query("f2_accept", f"with {ACCEPTED} select seq, hash from accepted")
def f2(spark, d):
    rows, _ = dedup.accept(feed(spark, d), seen_hashes(spark, d), QUOTAS, "seq", content="content")
    return rows.select("seq", "hash")


@query("f3_quota_scaling", f"""select source_type, quota::bigint as quota, articles from (values
    {', '.join(f"({lit(k)}, {int(v * COUNT / 100)})" for k, v in FEEDS.items() if v * COUNT >= 100)}) t(source_type, quota)
  join (select lang as source_type, count(*) as articles from documents group by lang) using (source_type)""")
def f3(spark, d):
    quota = F.create_map(*[F.lit(x) for p in QUOTAS.items() for x in p])
    return feed(spark, d).groupBy("source_type").agg(F.count(F.lit(1)).alias("articles")).select(
        "source_type", F.try_element_at(quota, F.col("source_type")).cast("bigint").alias("quota"), "articles"
    ).filter("quota is not null")


@query("f4_seen_update", f"""with {ACCEPTED} select hash from seen union select hash from accepted""")
def f4(spark, d):
    """Seen table after the run: written, appended and read back."""
    from newsops.session import work_dir
    from newsops.sources import sinks

    path = work_dir(spark, "seen")
    sinks.append_seen(seen_hashes(spark, d), path)
    _, new = dedup.accept(feed(spark, d), sinks.load_seen(spark, path), QUOTAS, "seq", content="content")
    sinks.append_seen(new, path)
    return sinks.load_seen(spark, path)


@query("f5_top_by_quality", f"""with {ENRICHED} select seq, round(quality_score, 6) as quality_score from enriched
  order by enriched.quality_score desc, seq limit 100""")
def f5(spark, d):
    return ranking.top_n(enriched(spark, d).select("seq", "quality_score"), "quality_score", 100, "seq").select(
        "seq", F.round("quality_score", 6).alias("quality_score"))


def _h(key: str, seed: int) -> str:
    return f"md5('{seed}|' || {key})"


@query("f6_balance", f"""with {CLEAN} select doc_id, label from (select *, row_number() over (
    partition by label order by {_h('doc_id', 42)}, doc_id::varchar) as rn from clean)
  where rn <= (select min(n) from (select count(*) as n from clean group by label))""")
def f6(spark, d):
    return sampling.balance(clean(spark, d), "label", "doc_id").select("doc_id", "label")


@query("f7_replay_cap", f"select doc_id from documents order by {_h('doc_id', 42)}, doc_id::varchar limit 800")
def f7(spark, d):
    return sampling.cap(table(spark, d, "documents").select("doc_id"), 800, "doc_id")


@query("f8_balanced_fixture", f"""with {CLEAN} select doc_id, label from (select *, row_number() over (
    partition by label order by {_h('doc_id', 42)}, doc_id::varchar) as rn from clean)
  where rn <= case when label = 'neutral' then 14 else 13 end""")
def f8(spark, d):
    return sampling.balanced_fixture(clean(spark, d), "label", "doc_id", 40).select("doc_id", "label")


def _s_split(source: str, label: str, key: str, fraction: float, seed: int, prefix: str) -> str:
    """Rows flagged ``taken``: ceil(fraction n), by largest remainder."""
    return f"""{prefix}_n as (select {label} as l, count(*) as n, sum(count(*)) over () as total,
      ceil({fraction}::double * sum(count(*)) over ())::bigint as want from {source} group by {label}),
    {prefix}_b as (select *, (n * want) // total as base, (n * want) % total as rest from {prefix}_n),
    {prefix}_t as (select l, base + (row_number() over (order by rest desc, l)
      <= want - sum(base) over ())::int as take from {prefix}_b),
    {prefix} as (select s.*, row_number() over (partition by {label}
      order by {_h(key, seed)}, {key}::varchar) <= t.take as taken
      from {source} s join {prefix}_t t on t.l = s.{label})"""


@query("f9_split_classic", f"""with {CLEAN}, {_s_split('clean', 'label', 'doc_id', 0.2, 42, 's')}
  select doc_id, case when taken then 'validation' else 'train' end as split from s""")
def f9(spark, d):
    return sampling.auto_split(clean(spark, d), "label", "doc_id", "doc_id").select("doc_id", "split")


@query("f10_split_incremental", f"""with {CLEAN}, {_s_split('clean', 'label', 'doc_id', 0.1, 42, 's')},
    rest as (select * exclude (taken) from s where not taken),
    {_s_split('rest', 'label', 'doc_id', 0.25, 43, 'r')}
  select doc_id, 'test' as split from s where taken union all
  select doc_id, case when taken then 'validation' else 'train' end from r""")
def f10(spark, d):
    return sampling.auto_split(clean(spark, d), "label", "doc_id", "doc_id", "incremental").select("doc_id", "split")


@query("f11_split_random", f"""select doc_id, case when row_number() over (order by {_h('doc_id', 42)}, doc_id::varchar)
    <= ceil(0.2::double * count(*) over ()) then 'test' else 'train' end as split from documents""")
def f11(spark, d):
    return sampling.split(table(spark, d, "documents").select("doc_id"), None, "doc_id", "random")


RAREST = f"""{LONG}, rarest as (select vec_id, coalesce(min_by(i, f * 1000 + i) filter (y > 0), 0) - 1 as stratum
  from (select *, sum(y) over (partition by i) as f from long) group by vec_id)"""


@query("f12_split_multilabel", f"""with {RAREST}, {_s_split('rarest', 'stratum', 'vec_id', 0.2, 42, 's')}
  select vec_id, stratum::int as stratum, case when taken then 'validation' else 'train' end as split from s""")
def f12(spark, d):
    return sampling.split_multilabel(scored(spark, d), "truth", "vec_id").select("vec_id", "stratum", "split")


@query("f12_split_multilabel_incremental", f"""with {RAREST}, {_s_split('rarest', 'stratum', 'vec_id', 0.1, 42, 's')},
    rest as (select * exclude (taken) from s where not taken),
    {_s_split('rest', 'stratum', 'vec_id', 0.22, 43, 'r')}
  select vec_id, 'test' as split from s where taken union all
  select vec_id, case when taken then 'validation' else 'train' end from r""")
def f12_incremental(spark, d):
    return sampling.split_multilabel(scored(spark, d), "truth", "vec_id", "incremental").select("vec_id", "split")


@query("f13_split_ordered", """select item_id, case when row_number() over (order by item_id)
    <= greatest(1, floor(0.8::double * count(*) over ())) then 'train' else 'validation' end as split from benchmark""")
def f13(spark, d):
    return sampling.split_small(table(spark, d, "benchmark").select("item_id"), "item_id")


@query("f13_split_ordered_incremental", """select item_id, case when n >= 5 and rn = 1 then 'test'
    when n >= 5 and rn = n then 'validation' else 'train' end as split from (
  select item_id, row_number() over (order by item_id) as rn, count(*) over () as n from benchmark)""")
def f13_incremental(spark, d):
    return sampling.split_small(table(spark, d, "benchmark").select("item_id"), "item_id", "incremental")


@query("f14_line_numbers", f"with {LINED} select doc_id, file, line_number from lined")
def f14(spark, d):
    return lined(spark, d).select("doc_id", "file", "line_number")


def _s_pick(shift: str, allowed: str) -> str:
    return f"""picked as (select vec_id, i, code, p, row_number() over (partition by vec_id order by p desc, i) as rn
      from (select l.*, t.t, {shift} as sh, bool_or(l.p >= t.t + {shift}) over (partition by l.vec_id) as any_hit,
          row_number() over (partition by l.vec_id order by l.p desc, l.i) as best
        from long l join threshold t using (vec_id) {allowed})
      where p >= t + sh or (not any_hit and best = 1 and p >= 0.4))"""


@query("f15_pick_labels", f"""with {LONG}, {S_THRESHOLD}, {_s_pick('0', '')}
  select vec_id, coalesce(string_agg(code, ';' order by rn) filter (rn <= 3), '') as codes
  from scored left join picked using (vec_id) group by vec_id""")
def f15(spark, d):
    rows = correlate.pick_labels(scored(spark, d), CODES, rarity="off", low=0.5, high=0.75)
    return rows.select("vec_id", C.join_codes("correlations").alias("codes"))


# Counts of the batch before: how often each code is true.
PREV = "prev as (select code, sum(y)::bigint as n from long group by code)"


def previous_counts(spark, d):
    pairs = F.arrays_zip(F.array(*[F.lit(c) for c in CODES]).alias("code"), F.col("truth").alias("y"))
    rows = scored(spark, d).select(F.explode(pairs).alias("e"))
    return rows.groupBy("e.code").agg(F.sum("e.y").cast("bigint").alias("n"))


@query("f16_pick_labels_frozen", f"""with {LONG}, {S_THRESHOLD}, {PREV},
    {_s_pick("(case when coalesce(n, 0) >= 10 then 0.02 when coalesce(n, 0) <= 1 then -0.02 else 0.0 end)",
             "left join prev using (code)")}
  select vec_id, coalesce(string_agg(code, ';' order by rn) filter (rn <= 3), '') as codes
  from scored left join picked using (vec_id) group by vec_id""")
def f16(spark, d):
    rows = correlate.pick_labels(scored(spark, d), CODES, counts=previous_counts(spark, d), low=0.5, high=0.75)
    return rows.select("vec_id", C.join_codes("correlations").alias("codes"))


# Candidates best first, each with the count below which it passes; then session by
# session, row by row, the counts so far.
SESSION = "case when vec_id % 3 = 0 then -1 else vec_id // 750 end"
S_EXACT = f"""with recursive {LONG}, {S_THRESHOLD},
  cand as (select vec_id, list({{'k': i, 'code': code, 'under':
      case when p >= t + 0.02 then 2147483647 when p >= t then 10 when p >= t - 0.02 then 2 else 0 end}} order by p desc, i) as c,
    arg_max({{'k': i, 'p': p}}, (p, -i)) as best from long join threshold using (vec_id) group by vec_id),
  rows_ as (select {SESSION} as session, row_number() over (partition by {SESSION} order by vec_id) as n, vec_id,
    list_filter(c, lambda e: e.under > 0) as c, case when best.p >= 0.4 then [best.k] else [] end as spare from cand),
  walk as (
    select session, 0::bigint as n, null::bigint as vec_id, list_transform(range({K}), lambda x: 0) as counts, []::bigint[] as picks
    from (select distinct session from rows_)
    union all
    select session, n, vec_id, list_transform(counts, lambda x, k: x + list_contains(picks, k)::int) as counts, picks
    from (select r.session, r.n, r.vec_id, w.counts,
        (case when len(list_filter(r.c, lambda e: w.counts[e.k] < e.under)) > 0
          then list_transform(list_filter(r.c, lambda e: w.counts[e.k] < e.under), lambda e: e.k) else r.spare end)[1:3] as picks
      from walk w join rows_ r on r.session = w.session and r.n = w.n + 1))
  select vec_id, array_to_string(list_transform(picks, lambda k: {s_list(CODES)}[k]), ';') as codes from walk where n > 0"""


@query("f16_pick_labels_exact", S_EXACT)
def f16_exact(spark, d):
    """Counts grow within a session: runs of 750 consecutive vectors, the largest
    collection run there is, and one session of a third of all rows."""
    rows = scored(spark, d).select(
        "vec_id", F.expr("case when vec_id % 3 = 0 then -1 else vec_id div 750 end").alias("session"), F.col("vec_id").alias("seq"), "scores")
    return correlate.pick_labels(rows, CODES, rarity="exact", low=0.5, high=0.75).select(
        "vec_id", C.join_codes("correlations").alias("codes"))


# ---------------------------------------------------------- G: set operations
DAILY = f"""{LABELLED}, daily as (select doc_id, {s_strip('text')} as text, lower(label) as label_sentiment,
    strptime(substr(file, 6, 8), '%Y%m%d')::date as date, file from labelled where {s_strip('text')} <> ''
    and lower(label) in ('negative', 'neutral', 'positive'))"""
HISTORY = f"""{DAILY}, today as (select * from daily where date = date '{RUN_DATE}'),
  hist as (select * from daily where date >= date '{RUN_DATE}' - 12 and date < date '{RUN_DATE}'),
  newest as (select distinct file, date from hist order by date desc, file desc limit 10),
  history as (select * from hist where file in (select file from newest))"""


def daily_rows(spark, d):
    rows = labelled(spark, d).withColumn("seq", F.col("doc_id"))
    return P.to_daily(rows.withColumn("source", F.col("file")), RUN_DATE).withColumnRenamed("source", "file")


@query("a11_history_window", f"""with {HISTORY} select doc_id as seq, file from history""")
def a11(spark, d):
    return files.history_window(daily_rows(spark, d), RUN_DATE, 12).select("seq", "file")


@query("g1_union_prioritised", f"""with {HISTORY} select doc_id as seq, 0 as priority from today
  union all select doc_id, 1 from history""")
def g1(spark, d):
    rows = daily_rows(spark, d)
    both = dedup.union_prioritised(rows.filter(F.col("date") == F.lit(RUN_DATE).cast("date")),
                                   files.history_window(rows, RUN_DATE, 12))
    return both.select("seq", "priority")


@query("g2_union_endpoints", f"""with {FEED} select source_type, count(*) as n from (
    select source_type from feed where source_type = 'en' union all
    select source_type from feed where source_type <> 'en') group by source_type""")
def g2(spark, d):
    rows = feed(spark, d)
    parts = rows.filter("source_type = 'en'").unionByName(rows.filter("source_type <> 'en'"))
    return parts.groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))


@query("g3_label_set_difference", """select 'events only' as side, k as value from (
    select distinct event_type as k from events except select distinct role from conversations)
  union all select 'roles only', k from (select distinct role as k from conversations
    except select distinct event_type from events)""")
def g3(spark, d):
    a = table(spark, d, "events").select(F.col("event_type").alias("value"))
    b = table(spark, d, "conversations").select(F.col("role").alias("value"))
    return dedup.set_diff(a, b, "value").select(F.lit("events only").alias("side"), "value").union(
        dedup.set_diff(b, a, "value").select(F.lit("roles only"), "value"))


@query("g4_distinct_files", f"with {DATED} select distinct name from dated")
def g4(spark, d):
    return dated_files(spark, d).select("name").distinct()


@query("a7_latest_dataset", f"""with {DATED} select max(name) as name from dated
  where regexp_matches(name, '^news_[0-9]{{8}}\\.csv$')""")
def a7(spark, d):
    return files.latest_dataset(dated_files(spark, d))


@query("a7_latest_dataset_any", f"""with {DATED} select max(name) as name from dated
  where name like 'news\\_%' escape '\\' and name like '%.csv'""")
def a7_any(spark, d):
    return files.latest_dataset(dated_files(spark, d), strict=False)


@query("a20_preview", """select doc_id, lang, (select count(*) from documents) as row_count from documents
  order by doc_id limit 5""")
def a20(spark, d):
    return stats.preview(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")



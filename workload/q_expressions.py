"""Filters, projections and scalar functions."""
from __future__ import annotations

from pyspark.sql import functions as F

from newsops import vocab
from newsops.functions import codes as C, labels as L, lexicon as X, scores as S, text as T
from newsops.operators import stats
from newsops.plans import datasets as P
from newsops.sources import files, sinks
from workload.registry import query
from workload.views import (
    CFG, CLEAN, CODES_SQL, DAILY_HIGH, DAILY_MEDIUM, DATED, FEED, HIGH, K, LABELLED, LONG, MEDIUM,
    NEG, POS, PREMIUM, RUN_DATE, SCORED, clean, dated_files, feed, labelled, lit, s_any, s_case,
    s_daily_importance, s_hash, s_hits, s_importance, s_list, s_sentiment, s_strip, scored, table)

TODAY = "2024-01-10"


# ------------------------------------------------------------------ B: filters
@query("b1_content_fallback", f"""with {FEED} select seq, coalesce(nullif(text, ''), content, '') as content
  from feed""")
def b1(spark, d):
    return feed(spark, d).select("seq", T.first_non_empty("text", "content", default="").alias("content"))


@query("b2_publisher_fallback", f"""with {FEED} select seq,
  coalesce(nullif(site, ''), publisher, 'FMP') as source from feed""")
def b2(spark, d):
    return feed(spark, d).select(
        "seq", T.first_non_empty("site", "publisher", default="FMP").alias("source"))


@query("b3_min_content", f"""with {FEED} select seq, title from feed
  where length(title) >= 20 and length(content) >= 100""")
def b3(spark, d):
    return feed(spark, d).filter(T.min_content("title", "content")).select("seq", "title")


@query("b4_title_and_content_present", f"""with {FEED} select seq, length(title) as title_chars,
  length(content) as content_chars from feed where title <> '' and content <> ''""")
def b4(spark, d):
    return feed(spark, d).filter(
        T.non_empty("title").isNotNull() & T.non_empty("content").isNotNull()).select(
        "seq", F.length("title").cast("bigint").alias("title_chars"),
        F.length("content").cast("bigint").alias("content_chars"))


@query("b5_feed_minimum", f"""with {FEED} select seq from feed
  where length({s_strip("title || '. ' || content")}) > 50""")
def b5(spark, d):
    return feed(spark, d).filter(T.longer_than(T.compose("title", "content"))).select("seq")


@query("b6_published_today", f"""select event_id, event_type from (
    select *, case when event_type = 'error' then null else ts end as published from events)
  where published is null or published::date = date '{TODAY}'""")
def b6(spark, d):
    published = F.when(F.col("event_type") != "error", F.col("ts"))
    return table(spark, d, "events").filter(P.published_on(published, TODAY)).select(
        "event_id", "event_type")


@query("b7_period_slices", """select event_id, (datediff('day', date '2024-01-03', ts::date) // 7)::bigint as slice
  from events where ts::date between date '2024-01-03' and date '2024-01-24'""")
def b7(spark, d):
    return P.in_period(table(spark, d, "events"), "ts", "2024-01-24", 21).select("event_id", "slice")


@query("b8_compose", f"""with {FEED} select seq, {s_strip("title || '. ' || content")} as text from feed""")
def b8(spark, d):
    return feed(spark, d).select("seq", T.compose("title", "content").alias("text"))


@query("b9_compose_optional", f"""with {FEED} select seq, case when text <> ''
  then {s_strip("title || '. ' || text")} else title end as text from feed""")
def b9(spark, d):
    return feed(spark, d).select("seq", T.compose("title", "text", "optional").alias("text"))


@query("b10_compose_plain", f"""with {FEED} select seq, coalesce(nullif(text, ''),
  {s_strip("title || ' ' || content")}) as text from feed""")
def b10(spark, d):
    return feed(spark, d).select("seq", F.coalesce(
        T.non_empty("text"), T.compose("title", "content", "plain")).alias("text"))


@query("b11_summary", f"""with {FEED} select seq, case when length(content) > 200
  then left(content, 200) || '...' else content end as summary from feed""")
def b11(spark, d):
    return feed(spark, d).select("seq", T.summary("content").alias("summary"))


@query("b12_model_input", "select doc_id, left(text, 512) as model_input from documents")
def b12(spark, d):
    return table(spark, d, "documents").select("doc_id", T.model_input("text").alias("model_input"))


@query("b13_label_fallback", """select event_id, coalesce(
    nullif(case when event_type = 'view' then event_type end, ''),
    nullif(case when event_type = 'error' then '' when event_type = 'click' then 'neutral' end, ''),
    case when event_type = 'purchase' then 'positive' end, '') as label from events""")
def b13(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select("event_id", L.label_fallback(
        F.when(kind == "view", kind),
        F.when(kind == "error", "").when(kind == "click", "neutral"),
        F.when(kind == "purchase", "positive")).alias("label"))


@query("b14_standardise", f"""with {LABELLED} select doc_id, text, label_id as label from (
    select doc_id, text, case lower({s_strip("coalesce(label, '')")}) when 'negative' then 0
      when 'neutral' then 1 when 'positive' then 2 end as label_id from labelled)
  where label_id is not null and text <> ''""")
def b14(spark, d):
    return P.standardise(labelled(spark, d), "label").select("doc_id", "text", "label")


@query("b14_rejected_labels", f"""with {LABELLED} select lower({s_strip("label")}) as label, count(*) as n
  from labelled where {s_strip("label")} <> ''
  and lower({s_strip("label")}) not in ('negative', 'neutral', 'positive') group by 1""")
def b14_rejected(spark, d):
    return P.standardise(labelled(spark, d), "label", rejected=True)


_HOT = f"""array_to_string(list_transform({CODES_SQL}, lambda c: list_contains(codes, c)::int), '')"""
_PARSED = f"""case when lower({s_strip("coalesce(correlations, '')")}) in ('', 'nan') then []::varchar[]
  else list_filter(list_transform(case when contains(correlations, ';')
    then string_split(correlations, ';') else string_split(correlations, ',') end,
    lambda x: {s_strip("x")}), lambda x: x <> '') end"""


def _bits(column):
    return F.array_join(F.transform(column, lambda x: x.cast("int").cast("string")), "")


@query("b15_standardise_codes", f"""with {LABELLED} select doc_id, {_HOT} as labels from (
    select *, {_PARSED} as codes from labelled) where correlations <> '' and text <> ''""")
def b15(spark, d):
    return P.standardise(labelled(spark, d), "correlations").select("doc_id", _bits("labels").alias("labels"))


@query("b15_standardise_codes_keep_unlabelled", f"""with {LABELLED} select doc_id, {_HOT} as labels from (
    select *, {_PARSED} as codes from labelled)
  where (correlations is null or correlations <> '') and text <> ''""")
def b15_keep(spark, d):
    return P.standardise(labelled(spark, d), "correlations", keep_unlabelled=True).select(
        "doc_id", _bits("labels").alias("labels"))


@query("b16_daily_validity", f"""with {LABELLED} select doc_id, lower(label) as label from labelled
  where {s_strip("text")} <> '' and lower(label) in ('negative', 'neutral', 'positive')""")
def b16(spark, d):
    return labelled(spark, d).filter(L.valid_daily("text", "label")).select(
        "doc_id", F.lower("label").alias("label"))


_CLEANED = rf"""cleaned as (select *, {s_strip("cut")} as cleaned from (
  select *, case when length(t) <= 512 then t when dot > 409.6 then left(p, dot + 1)
    when spc > 409.6 then left(p, spc) else p end as cut from (
  select *, left(t, 512) as p,
    case when contains(left(t, 512), '.') then 512 - instr(reverse(left(t, 512)), '.') else -1 end as dot,
    case when contains(left(t, 512), ' ') then 512 - instr(reverse(left(t, 512)), ' ') else -1 end as spc
  from (select *, case when regexp_matches(f, '\p{{Lu}}') and not regexp_matches(f, '[\p{{Ll}}\p{{Lt}}]')
      and length(f) > 50 then array_to_string(list_transform(
        regexp_extract_all(f, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+'),
        lambda r: upper(r[1]) || lower(r[2:])), '') else f end as t
  from (select *, replace(regexp_replace(coalesce(text, ''), '[{T.WS_CLASS}]+', ' ', 'g'), '""', '"') as f
    from labelled)))))"""


@query("b17_drop_blank", f"""with {LABELLED}, {_CLEANED} select doc_id, length(cleaned)::bigint as chars
  from cleaned where cleaned <> ''""")
def b17(spark, d):
    rows = labelled(spark, d).select("doc_id", T.clean_text("text").alias("text"))
    return rows.filter(T.not_blank("text")).select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("b18_needs_review", f"""with {SCORED} select vec_id, (probs[1] < 0.75 or probs[2] < 0.75) as needs_review
  from scored""")
def b18(spark, d):
    return scored(spark, d).select("vec_id", L.needs_review(
        F.element_at("probs", 1), F.element_at("probs", 2)).alias("needs_review"))


@query("b19_provenance", f"""with {FEED} select seq, 'rule_based' as sentiment_model,
  'rule_based' as importance_model, 'commodity_correlator' as correlation_model,
  'rule_based_triple' as labeling_method, false as needs_review from feed""")
def b19(spark, d):
    return P.provenance(feed(spark, d), CFG, False).select(
        "seq", "sentiment_model", "importance_model", "correlation_model", "labeling_method",
        "needs_review")


@query("b20_training_targets", f"""with {LABELLED} select 'label' as target union all select 'importance'
  union all select 'correlations' from (select bool_or(correlations is not null) as b from labelled)
  where b""")
def b20(spark, d):
    return stats.training_targets(labelled(spark, d))


@query("b21_lexicon_filter", f"""select doc_id from documents where {s_any('lower(text)', POS + NEG)}""")
def b21(spark, d):
    return table(spark, d, "documents").filter(X.has_hit("text", POS + NEG)).select("doc_id")


# ------------------------------------------------------------------- C: scalars
@query("c1_strip", f"""select conv_id, turn, {s_strip("chr(8195) || text || chr(10)")} as text
  from conversations""")
def c1(spark, d):
    padded = F.concat(F.lit(" "), F.col("text"), F.lit("\n"))
    return table(spark, d, "conversations").select("conv_id", "turn", T.strip(padded).alias("text"))


@query("c2_article_hash", f"select doc_id, {s_hash('text')} as hash from documents")
def c2(spark, d):
    return table(spark, d, "documents").select("doc_id", T.article_hash("text").alias("hash"))


@query("c3_clean_text", f"""with labelled as (select page_id as id, html as text from pages
    union all select -1 - doc_id, text from documents), {_CLEANED}
  select id, cleaned as text from cleaned""")
def c3(spark, d):
    rows = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text")).union(
        table(spark, d, "documents").select(-1 - F.col("doc_id"), "text"))
    return rows.select("id", T.clean_text("text").alias("text"))


@query("c4_smart_truncate", """select doc_id, case when length(text) <= 512 then text
    when dot > 409.6 then left(p, dot + 1) when spc > 409.6 then left(p, spc) else p end as text
  from (select *, left(text, 512) as p,
    case when contains(left(text, 512), '.') then 512 - instr(reverse(left(text, 512)), '.') else -1 end as dot,
    case when contains(left(text, 512), ' ') then 512 - instr(reverse(left(text, 512)), ' ') else -1 end as spc
  from documents)""")
def c4(spark, d):
    return table(spark, d, "documents").select("doc_id", T.smart_truncate("text").alias("text"))


@query("c5_title_case", r"""select doc_id, array_to_string(list_transform(
    regexp_extract_all(upper(replace(text, 'ß', 'ss')), '[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+'),
    lambda r: upper(r[1]) || lower(r[2:])), '') as text from documents""")
def c5(spark, d):
    return table(spark, d, "documents").select("doc_id", T.py_title(F.upper("text")).alias("text"))


@query("c6_is_upper", r"""select doc_id, regexp_matches(text, '\p{Lu}')
  and not regexp_matches(text, '[\p{Ll}\p{Lt}]') as is_upper from documents""")
def c6(spark, d):
    return table(spark, d, "documents").select("doc_id", T.is_upper("text").alias("is_upper"))


S_SUSPICIOUS = rf"""regexp_matches(text, '[^\p{{L}}\p{{N}}_{T.WS_CLASS}.,!?"''\-():;%$+=&@#]')"""


@query("c7_suspicious", f"select doc_id, {S_SUSPICIOUS} as suspicious from documents")
def c7(spark, d):
    return table(spark, d, "documents").select("doc_id", T.has_suspicious("text").alias("suspicious"))


@query("c8_normalise_sentiment", f"""with {LABELLED} select doc_id,
  {s_case(s_strip('lower(label)'), vocab.SENTIMENT_NORMAL, "'neutral'")} as label from labelled""")
def c8(spark, d):
    return labelled(spark, d).select("doc_id", L.normalise_sentiment("label").alias("label"))


@query("c8_normalise_importance", f"""with {LABELLED} select doc_id,
  {s_case(s_strip('lower(importance)'), vocab.IMPORTANCE_NORMAL, "'générale'")} as importance from labelled""")
def c8b(spark, d):
    return labelled(spark, d).select("doc_id", L.normalise_importance("importance").alias("importance"))


@query("c8_normalise_accents", f"""with {LABELLED} select doc_id,
  {s_case(s_strip('lower(importance)'), vocab.IMPORTANCE_ACCENTS, s_strip('lower(importance)'))} as importance
  from labelled""")
def c8c(spark, d):
    return labelled(spark, d).select("doc_id", L.normalise(
        "importance", vocab.IMPORTANCE_ACCENTS, unknown="keep").alias("importance"))


_PRIORITIES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}


@query("c9_encode_decode", f"""with {CLEAN} select doc_id, case label when 'negative' then 0
  when 'neutral' then 1 when 'positive' then 2 end as label_id, label as decoded from clean""")
def c9(spark, d):
    rows = clean(spark, d).select("doc_id", L.encode("label", vocab.SENTIMENT_IDS).alias("label_id"))
    return rows.withColumn("decoded", L.decode("label_id", vocab.SENTIMENT_IDS))


@query("c9_encode_unknown_zero", f"""select o_orderkey,
  {s_case('o_orderpriority', _PRIORITIES, '0')} as label_id from orders""")
def c9b(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", L.encode("o_orderpriority", _PRIORITIES, 0).alias("label_id"))


@query("c10_model_label", f"""select vec_id, {s_case("'LABEL_' || label", vocab.MODEL_SENTIMENT, "'neutral'")}
    as sentiment, {s_case("'LABEL_' || label", vocab.MODEL_IMPORTANCE, "'générale'")} as importance
  from embeddings""")
def c10(spark, d):
    name = F.concat(F.lit("LABEL_"), F.col("label"))
    return table(spark, d, "embeddings").select(
        "vec_id", L.model_label(name, vocab.MODEL_SENTIMENT, "neutral").alias("sentiment"),
        L.model_label(name, vocab.MODEL_IMPORTANCE, "générale").alias("importance"))


@query("c11_lexicon_hits", f"""select doc_id, {s_hits('lower(text)', POS + NEG + HIGH)} as hits from documents""")
def c11(spark, d):
    return table(spark, d, "documents").select("doc_id", X.hits("text", POS + NEG + HIGH).alias("hits"))


# A lexicon beyond the inline size: every two-letter ending of a few stems.
WIDE = [stem + last for stem in ("th", "er", "an", "eu", "on", "sc", "ci") for last in "abcdefghijklmnopqrstuvwxyz"]


@query("c11_lexicon_hits_wide", f"""select doc_id,
  len(list_filter({s_list(WIDE)}, lambda w: contains(lower(text), w)))::int as hits from documents""")
def c11_wide(spark, d):
    return table(spark, d, "documents").select("doc_id", X.hits("text", WIDE).alias("hits"))


@query("c12_sentiment", f"select doc_id, {s_sentiment('lower(text)')} as label from documents")
def c12(spark, d):
    return table(spark, d, "documents").select("doc_id", X.sentiment("text", POS, NEG).alias("label"))


_WIDE_POS = POS + ["tion", "eau", "ung"]
_WIDE_NEG = NEG + ["hely", "onst", "los "]


@query("c13_sentiment_wide", f"""select doc_id, {s_sentiment('lower(text)', _WIDE_POS, _WIDE_NEG)} as label
  from documents""")
def c13(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", X.sentiment("text", _WIDE_POS, _WIDE_NEG).alias("label"))


@query("c12_sentiment_shipped_lexicons", f"""select doc_id,
    {s_sentiment('lower(text)', vocab.POSITIVE_WORDS, vocab.NEGATIVE_WORDS)} as narrow,
    {s_sentiment('lower(text)', vocab.POSITIVE_WIDE, vocab.NEGATIVE_WIDE)} as wide,
    {s_importance('lower(text)', vocab.HIGH_TERMS, vocab.MEDIUM_TERMS)} as importance from documents""")
def c12_shipped(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", X.sentiment("text").alias("narrow"),
        X.sentiment("text", vocab.POSITIVE_WIDE, vocab.NEGATIVE_WIDE).alias("wide"),
        X.importance("text").alias("importance"))


@query("c14_importance_tiers", f"select doc_id, {s_importance('lower(text)')} as importance from documents")
def c14(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", X.importance("text", HIGH, MEDIUM).alias("importance"))


@query("c15_importance_daily", f"select doc_id, {s_daily_importance('lower(text)')} as importance from documents")
def c15(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", X.importance("text", DAILY_HIGH, DAILY_MEDIUM, "daily").alias("importance"))


_WEIGHTS = [3.0, 3.0, 2.0, 2.0, 1.0, 1.0]


@query("c16_weighted_score", "select doc_id, " + " + ".join(
    f"contains(lower(text), {lit(w)})::int * {x}::double" for w, x in zip(POS, _WEIGHTS))
    + " as score from documents")
def c16(spark, d):
    return table(spark, d, "documents").select("doc_id", X.hits("text", POS, _WEIGHTS).alias("score"))


S_QUALITY = f"""least(100.0::double, least(20.0::double, length(title) / 5.0::double)
  + least(30.0::double, length(text) / 100.0::double)
  + case when {s_any("lower(source)", PREMIUM)} then 25 else 0 end
  + {s_hits("lower(text)", HIGH)} * 5 + len(codes) * 3)"""


@query("c17_quality_score", f"""with {LABELLED} select doc_id, round({S_QUALITY}, 6) as quality_score
  from (select doc_id, split_part(text, '.', 1) as title, text, source, {_PARSED} as codes from labelled)""")
def c17(spark, d):
    rows = labelled(spark, d).select(
        "doc_id", F.substring_index("text", ".", 1).alias("title"), "text", "source",
        C.parse_codes("correlations").alias("codes"))
    return rows.select("doc_id", F.round(X.quality_score(
        "title", "text", "source", "codes", premium=PREMIUM, high=HIGH), 6).alias("quality_score"))


@query("c18_split_code", """select p_partkey, case when contains(code, ':') then split_part(code, ':', 1)
    else '' end as country, case when contains(code, ':') then split_part(code, ':', 2) else code end as commodity
  from (select p_partkey, case when p_size > 10 then 'N' || p_size || ':' || p_brand else p_brand end as code
    from part)""")
def c18(spark, d):
    code = F.when(F.col("p_size") > 10, F.concat(F.lit("N"), F.col("p_size"), F.lit(":"), F.col("p_brand"))
                  ).otherwise(F.col("p_brand"))
    rows = table(spark, d, "part").select("p_partkey", code.alias("code"))
    return rows.select("p_partkey", C.country_of("code").alias("country"), C.commodity_of("code").alias("commodity"))


@query("c19_parse_codes", f"""with {LABELLED} select doc_id, array_to_string({_PARSED}, '|') as codes
  from labelled""")
def c19(spark, d):
    return labelled(spark, d).select("doc_id", F.array_join(C.parse_codes("correlations"), "|").alias("codes"))


@query("c20_multi_hot", f"""with {LABELLED} select doc_id, {_HOT} as hot from (
  select doc_id, {_PARSED} as codes from labelled)""")
def c20(spark, d):
    return labelled(spark, d).select("doc_id", _bits(C.multi_hot(
        C.parse_codes("correlations"), vocab.COMMODITY_CODES)).alias("hot"))


@query("c21_codes_from_scores", f"""with {LONG} select vec_id, coalesce(string_agg(
  case when p > 0.5 then code end, ',' order by i), '') as codes from long group by vec_id""")
def c21(spark, d):
    return scored(spark, d).select("vec_id", C.codes_from_scores("probs", vocab.COMMODITY_CODES).alias("codes"))


S_THRESHOLD = f"""threshold as (select vec_id, least(0.75::double, greatest(0.5::double,
    s[floor(k)::int + 1] + (k - floor(k)) * (s[ceil(k)::int + 1] - s[floor(k)::int + 1]))) as t
  from (select vec_id, list_sort(probs) as s, 0.97::double * ({K} - 1) as k from scored))"""


@query("c22_adaptive_threshold", f"""with {SCORED}, {S_THRESHOLD} select vec_id, round(t, 6) as t
  from threshold""")
def c22(spark, d):
    return scored(spark, d).select("vec_id", F.round(
        S.adaptive_threshold("probs", low=0.5, high=0.75), 6).alias("t"))


@query("c23_argmax_label", f"""with {LONG} select vec_id, code as best, p as confidence from (
  select *, row_number() over (partition by vec_id order by p desc, i) as rn from long) where rn = 1""")
def c23(spark, d):
    return scored(spark, d).select("vec_id", S.argmax_label("scores").alias("b")).select(
        "vec_id", F.col("b.label").alias("best"), F.col("b.score").alias("confidence"))


@query("c24_predict_multilabel", f"""with {LONG} select vec_id, string_agg(
    case when p > 0.82 or (best <= 0.82 and rn = 1) then '1' else '0' end, '' order by i) as hot
  from (select *, max(p) over (partition by vec_id) as best,
    row_number() over (partition by vec_id order by p desc, i desc) as rn from long) group by vec_id""")
def c24(spark, d):
    return scored(spark, d).select("vec_id", _bits(S.predict_multilabel("probs", 0.82)).alias("hot"))


# ---------------------------------------------------------- A: file-name rules
@query("a2_empty_cells", f"""with {LABELLED} select doc_id, coalesce(label, '') as label,
  coalesce(importance, '') as importance, coalesce(correlations, '') as correlations from labelled""")
def a2(spark, d):
    """Round trip through CSV: a null and an empty cell both read as ''."""
    from newsops.session import work_dir

    path = work_dir(spark, "cells")
    sinks.write_labelled_csv(labelled(spark, d).select(
        F.col("doc_id").cast("string").alias("text"), "label", "importance", "correlations"), path)
    rows = files.read_labelled_csv(spark, path, empty="string")
    return rows.select(F.col("text").cast("bigint").alias("doc_id"), "label", "importance", "correlations")


@query("a8_date_from_filename", f"""with {DATED} select name, nullif(regexp_extract(name,
  'news_([0-9]{{8}})\\.csv$', 1), '') as day, count(*) as n from dated group by all""")
def a8(spark, d):
    return dated_files(spark, d).select("name", files.date_from_filename("name").alias("day")).groupBy(
        "name", "day").agg(F.count(F.lit(1)).alias("n"))


@query("a9_valid_filename", f"""with {DATED} select distinct name,
  regexp_matches(name, '^news_[0-9]{{8}}\\.csv$') as valid from dated""")
def a9(spark, d):
    return dated_files(spark, d).select("name", files.valid_filename("name").alias("valid")).distinct()


@query("a10_daily_date", f"""with {DATED} select name, event_id, strftime(coalesce(
    case when name like 'news\\_%' escape '\\' then try_strptime(substr(name, 6, 8), '%Y%m%d')::date end,
    date '{RUN_DATE}'), '%Y-%m-%d') as day from dated""")
def a10(spark, d):
    return dated_files(spark, d).select("name", "event_id", F.date_format(
        files.daily_date("name", RUN_DATE), "yyyy-MM-dd").alias("day"))


@query("a5_project_task", f"""with {LABELLED} select {s_strip('text')} as text, label from (
    select text, coalesce(case when lang = 'en' then nullif(label, '') end, nullif(label, '')) as label
    from labelled) where {s_strip('text')} <> '' and label is not null""")
def a5(spark, d):
    rows = labelled(spark, d).select("text", "label", F.when(
        F.col("lang") == "en", F.col("label")).alias("label_sentiment"))
    return files.project_task(rows, "sentiment")


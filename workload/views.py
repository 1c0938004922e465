"""The driver's tables seen as articles, datasets, daily rows and score vectors,
once as Spark frames and once as SQL table expressions.

The shipped lexicons never occur in the invented prose of ``documents``, so the
queries pass test lexicons made of its own substrings."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsops.functions import codes as C, lexicon as X, text as T
from newsops.plans.datasets import Labelling
from newsops.sources.files import spread
from newsops.vocab import COMMODITY_CODES

POS = ["thble", "thed", "anea", "erin", " that ", " with "]
NEG = ["thnt", "thha", "thes", "ther", " from ", " this "]
HIGH = ["thonthe", "theand", "erthe", "anthe", "rethe"]
MEDIUM = ["thble", "thed", "anea", "erin", "thnt"]
DAILY_HIGH = ["thonthe", "theand", "erthe", "anthe"]
DAILY_MEDIUM = ["thble", "thed", "anea", "eaux", "schen", "ción"]
PREMIUM = ["src1", "src7"]
COUNTRIES = {"thst": "CN", "thly": "CN", "thtion": "US", "thin": "BR", "thnd": "AU", "eaux": "FR",
             "ouon": "FR", "ungen": "DE", "aciones": "ES"}
EXPORTS = [("CN", "MACHINERY", "major"), ("US", "CORN", "major"), ("BR", "COFFEE", "pivot"),
           ("AU", "IRON_ORE", "major"), ("FR", "AIRCRAFT", "pivot"), ("DE", "VEHICLES", "major"),
           ("ES", "OLIVES", "minor"), ("US", "WHEAT", "major")]
PRODUCTS = {"MACHINERY": ["thre", "unge"], "CORN": ["thon"], "COFFEE": ["ther", "thha"],
            "IRON_ORE": ["thes", "ore"], "AIRCRAFT": ["eau", "ela"], "VEHICLES": ["sch"],
            "WHEAT": ["that"]}
COMPANY = ["thonthe", "rethe", "xque "]
MACRO = ["the ", "que ", "der ", "los ", "ent "]
CFG = Labelling(positive=POS, negative=NEG, high=HIGH, medium=MEDIUM, premium=PREMIUM,
                countries=COUNTRIES, exports=EXPORTS, products=PRODUCTS, company=COMPANY, macro=MACRO)
K = len(COMMODITY_CODES)
RUN_DATE = "2024-01-15"
FEEDS = {"en": 50, "fr": 20, "de": 15, "es": 10, "xx": 0}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(rows) if name in ("documents", "pages") else rows


# ------------------------------------------------------------------ SQL helpers
def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_SQL = lit(T.WS_CHARS)


def s_strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def s_hits(x: str, words) -> str:
    return "(" + " + ".join(f"contains({x}, {lit(w)})::int" for w in words) + ")"


def s_any(x: str, words) -> str:
    return "(" + " or ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def s_list(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def s_case(x: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"when {lit(k)} then {lit(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"case {x} {whens} else {default} end"


def s_sentiment(low: str, pos=POS, neg=NEG) -> str:
    p, n = s_hits(low, pos), s_hits(low, neg)
    return f"case when {p} > {n} then 'positive' when {n} > {p} then 'negative' else 'neutral' end"


def s_importance(low: str, high=HIGH, medium=MEDIUM) -> str:
    h, m = s_hits(low, high), s_hits(low, medium)
    return (f"case when {h} >= 2 then 'critique' when {h} >= 1 or {m} >= 3 then 'importante' "
            f"else 'générale' end")


def s_daily_importance(low: str, high=DAILY_HIGH, medium=DAILY_MEDIUM) -> str:
    return (f"case when {s_any(low, high)} then 'critical' when {s_any(low, medium)} then 'important' "
            f"else 'general' end")


def s_rule_codes(low: str) -> str:
    parts = []
    for country, product, impact in EXPORTS:
        if impact not in ("pivot", "major"):
            continue
        names = [n for n, c in COUNTRIES.items() if c == country]
        parts.append(f"case when {s_any(low, names)} and {s_any(low, PRODUCTS.get(product, [product.lower()]))} "
                     f"then {lit(country + ':' + product)} end")
    found = f"list_filter([{', '.join(parts)}], lambda x: x is not null)"
    return f"case when not {s_any(low, COMPANY)} and {s_any(low, MACRO)} then {found} else []::varchar[] end"


def s_hash(x: str) -> str:
    # The replacement pattern is the fingerprint's definition.
    return (f"md5(regexp_replace({s_strip(f'lower({x})')}, "
            f"'[^\\p{{L}}\\p{{N}}{T.WS_CLASS}]', '', 'g'))")


# ------------------------------------------------------------------- raw feed
def feed(spark, d) -> DataFrame:
    """documents as a raw feed: ``text`` filled for English only, ``content``
    always; ``site`` and ``publisher`` partly missing."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    dot = F.instr("text", ".")
    body = F.when(dot > 0, T.strip(F.substring(F.col("text"), dot + 1, F.length("text")))).otherwise("")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("seq"), F.substring_index("text", ".", 1).alias("title"),
        F.when(F.col("lang") == "en", body).otherwise("").alias("text"), body.alias("content"),
        F.when(F.col("quality") == 1, F.col("source")).otherwise("").alias("site"),
        F.when(F.col("quality") == 0, F.concat(F.lit("pub-"), F.col("source"))).alias("publisher"),
        F.concat(F.lit("http://news.example/"), F.col("doc_id")).alias("url"),
        F.col("lang").alias("source_type"))


FEED = f"""feed as (
  select d.doc_id as seq, split_part(d.text, '.', 1) as title,
    case when lang = 'en' then body else '' end as text, body as content,
    case when quality = 1 then source else '' end as site,
    case when quality = 0 then 'pub-' || source end as publisher,
    'http://news.example/' || d.doc_id as url, lang as source_type
  from (select *, case when contains(text, '.')
          then {s_strip("substr(text, instr(text, '.') + 1)")} else '' end as body from documents) d
  left join labels l on d.doc_id = l.doc_id)"""


# ------------------------------------------------------------ labelled dataset
def labelled(spark, d) -> DataFrame:
    """documents as dataset files (one per source, named by date) with the
    labels of ``labels`` spelled differently per language."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    name = (F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
            .when(F.col("quality") == 0, "neutral"))
    spelled = (F.when(F.col("lang") == "fr", F.upper(name))
               .when(F.col("lang") == "de", F.concat(F.lit(" "), name, F.lit(" ")))
               .when(F.col("lang") == "es", F.left(name, F.lit(3))).otherwise(name))
    importance = (F.when(F.col("toxic") == 1, " Critique ").when(F.col("quality") == 1, "MEDIUM")
                  .when(F.col("quality") == 0, "generale"))
    rules = CFG.rules("text")
    joined = F.when(F.col("lang") == "en", F.array_join(rules, ";")).otherwise(F.array_join(rules, " , "))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.substring("source", 4, 9).cast("int"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("news_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv")).alias("file"),
        "text", spelled.alias("label"), importance.alias("importance"),
        F.when(name.isNotNull(), joined).alias("correlations"), "lang", "source")


LABELLED = f"""labelled as (
  select doc_id, 'news_' || strftime(date '2024-01-01' + substr(source, 4)::int, '%Y%m%d') || '.csv' as file,
    text, case lang when 'fr' then upper(name) when 'de' then ' ' || name || ' '
      when 'es' then substr(name, 1, 3) else name end as label,
    case when name = 'negative' then ' Critique ' when name = 'positive' then 'MEDIUM'
      when name = 'neutral' then 'generale' end as importance,
    case when name is null then null when lang = 'en' then array_to_string(codes, ';')
      else array_to_string(codes, ' , ') end as correlations,
    lang, source
  from (select d.doc_id, {s_rule_codes('lower(d.text)')} as codes, d.text, d.lang, d.source, case when toxic = 1 then 'negative'
          when quality = 1 then 'positive' when quality = 0 then 'neutral' end as name
        from documents d left join labels l on d.doc_id = l.doc_id))"""

LINED = f"""{LABELLED}, lined as (
  select *, row_number() over (partition by file order by doc_id) + 1 as line_number from labelled)"""


def lined(spark, d) -> DataFrame:
    from newsops.sources.files import with_line_number

    return with_line_number(labelled(spark, d), "file", "doc_id")


# ------------------------------------------------------------- clean labels
def clean(spark, d) -> DataFrame:
    """Rows with a usable sentiment: (doc_id, text, label, id, source)."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    name = (F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
            .otherwise("neutral"))
    return docs.join(labels, "doc_id").select("doc_id", "text", name.alias("label"), "source", "lang")


CLEAN = """clean as (
  select d.doc_id, d.text, case when toxic = 1 then 'negative' when quality = 1 then 'positive'
    else 'neutral' end as label, d.source, d.lang
  from documents d join labels l on d.doc_id = l.doc_id)"""


# ---------------------------------------------------------------- score vectors
def scored(spark, d) -> DataFrame:
    """embeddings as score vectors over the code list, with truths."""
    e = table(spark, d, "embeddings")
    score = F.transform(F.slice("embedding", 1, K), lambda v: F.round(
        1 / (1 + F.exp(-6 * v.cast("double"))), 6))
    table_of_codes = F.array(*[F.lit(c) for c in COMMODITY_CODES])
    truth = F.transform(F.sequence(F.lit(1), F.lit(K)), lambda i: (
        (F.element_at("embedding", i).cast("double") > 0.2)
        | (F.element_at("embedding", (i + 3).cast("int")).cast("double") > 0.3)).cast("double"))
    return e.select(
        "vec_id", "label", score.alias("probs"), truth.alias("truth"), "embedding",
        F.zip_with(table_of_codes, score, lambda c, s: F.struct(
            c.alias("label"), s.alias("score"))).alias("scores"))


CODES_SQL = s_list(COMMODITY_CODES)
SCORED = f"""scored as (
  select vec_id, label, embedding,
    list_transform(embedding[1:{K}], lambda v: round(1 / (1 + exp(-6 * v::double)), 6)) as probs,
    list_transform(range(1, {K + 1}), lambda i:
      (embedding[i]::double > 0.2 or embedding[i + 3]::double > 0.3)::int::double) as truth
  from embeddings)"""
# Long form: one row per vector and code.
LONG = f"""{SCORED}, long as (
  select vec_id, label, i, probs[i] as p, truth[i] as y, {CODES_SQL}[i] as code
  from scored, range(1, {K + 1}) as r(i))"""


# ------------------------------------------------------------------ dated files
def dated_files(spark, d) -> DataFrame:
    """Files named from the event stream, in the shapes a folder may hold."""
    day = F.date_format("ts", "yyyyMMdd")
    name = (F.when(F.col("event_type") == "view", F.concat(F.lit("financial_news_"), day, F.lit(".csv")))
            .when(F.col("event_type") == "error", F.concat(F.lit("news_fixed_"), day, F.lit("_120000.csv")))
            .when(F.col("event_type") == "signup", F.concat(F.lit("labeled_"), day, F.lit(".jsonl")))
            .otherwise(F.concat(F.lit("news_"), day, F.lit(".csv"))))
    return table(spark, d, "events").select(
        "event_id", "ts", "value", "event_type", name.alias("name"))


DATED = """dated as (
  select event_id, ts, value, event_type, case event_type
    when 'view' then 'financial_news_' || strftime(ts, '%Y%m%d') || '.csv'
    when 'error' then 'news_fixed_' || strftime(ts, '%Y%m%d') || '_120000.csv'
    when 'signup' then 'labeled_' || strftime(ts, '%Y%m%d') || '.jsonl'
    else 'news_' || strftime(ts, '%Y%m%d') || '.csv' end as name
  from events)"""


def codes_of(df, column="correlations"):
    return C.parse_codes(column)


def rules_of(column="text"):
    return X.rule_codes(column, COUNTRIES, EXPORTS, PRODUCTS, COMPANY, MACRO)

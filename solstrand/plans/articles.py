"""Queries on the article messages, their enrichment, surveys and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators import articles as ops
from solstrand.operators import enrich, quality, surveys
from solstrand.operators.geo import join_on_cell
from solstrand.functions.grid import FINEST, cell
from solstrand.plans.messages import (
    PLACES,
    START,
    article_messages,
    article_scorer,
    python_article_scorer,
    survey_scorer,
)
from solstrand.plans.shown import as_text, as_text_sql
from solstrand.sources.schemas import ANALYSIS_FIELDS
from solstrand.sources.tables import table


def messages(spark: SparkSession, sf_dir: str, topics: str = "objects") -> DataFrame:
    return article_messages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), topics
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.parse_messages(messages(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat articles, one per id; text that was no article is dropped first.

    Copies go before flattening, since the flat columns hold the article a second time.
    """
    articles = quality.expect(bronze(spark, sf_dir), [ops.identified()])
    unique = ops.first_per_id(articles.withColumn("id", F.col("parsed_records.id")))
    return ops.flatten_articles(unique)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.analysed(silver(spark, sf_dir), article_scorer())


def text_of(stamp: str) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with what parsing made of it."""
    article = F.col("parsed_records")
    rows = bronze(spark, sf_dir).select(
        "topic",
        "partition",
        "offset",
        text_of("eh_enqueued_timestamp").alias("enqueued_at"),
        F.col("eh_enqueued_date").cast("string").alias("enqueued_on"),
        article.isNotNull().alias("parsed"),
        article["id"].alias("id"),
        article["language"].alias("language"),
        article["title"].alias("title"),
        F.size(article["topics"]).alias("n_topics"),
    )
    return as_text(rows, "id", "n_topics")


def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that keep and break each rule, the added one on the id included."""
    return quality.expectation_counts(
        bronze(spark, sf_dir), [*ops.bronze_rules(), ops.identified()]
    )


FLAT_TEXT = ["is_duplicate", "is_breaking", "read_time", "sentences_count"]


def silver_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flat articles before deduplication: scalar columns, and values inside the nested ones."""
    flat = ops.flatten_articles(bronze(spark, sf_dir))
    rows = flat.filter(F.col("id").isNotNull()).select(
        "topic",
        "partition",
        "offset",
        text_of("timestamp").alias("sent_at"),
        "timestampType",
        "id",
        "href",
        "published_at",
        "title",
        "description",
        "body",
        "language",
        "author_id",
        "name",
        "image",
        F.col("categories")[0]["links"]["self"].alias("category_link"),
        F.col("topics")[1]["name"].alias("second_topic"),
        F.col("industries").isNull().alias("no_industries"),
        F.col("entities").isNull().alias("no_entities"),
        F.col("source.domain").alias("domain"),
        F.col("source.location.country_code").alias("country_code"),
        F.col("sentiment.overall.score").alias("score"),
        F.size("summary").alias("n_sentences"),
        F.element_at("summary", -1)["sentence"].alias("last_sentence"),
        F.array_join("keywords", "+").alias("keywords"),
        "is_duplicate",
        "is_paywall",
        "is_breaking",
        "read_time",
        "sentences_count",
        "paragraphs_count",
        "words_count",
        "characters_count",
        text_of("getdata_timestamp").alias("got_at"),
        F.col("eh_enqueued_date").cast("string").alias("enqueued_on"),
    )
    return as_text(rows, *FLAT_TEXT)


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select(
        "id", "offset", text_of("timestamp").alias("sent_at"), "title", "language"
    )


def topics_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of both forms of the topics under both schemas, per form and language."""
    parts = []
    for sent in ("objects", "names"):
        rows = messages(spark, sf_dir, sent)
        old = ops.parse_messages(rows, "objects").select(
            F.col("parsed_records.language").alias("language"),
            F.col("parsed_records.id").alias("id"),
            F.col("parsed_records.topics.name").alias("topics"),
            F.lit("objects").alias("parsed_as"),
        )
        new = ops.parse_messages(rows, "names").select(
            F.col("parsed_records.language").alias("language"),
            F.col("parsed_records.id").alias("id"),
            ops.topic_names(F.col("parsed_records.topics")).alias("topics"),
            F.lit("names").alias("parsed_as"),
        )
        parts.append(old.unionByName(new).withColumn("sent_as", F.lit(sent)))
    return (
        parts[0]
        .unionByName(parts[1])
        .filter(F.col("id").isNotNull())
        .groupBy("sent_as", "parsed_as", "language", F.col("topics")[0].alias("first_topic"))
        .agg(F.count("*").alias("n"), F.count("topics").alias("n_with_topics"))
    )


def enrich_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with the answer's fields, for articles without an answer yet (the unlabelled)."""
    done = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    # After deduplication the rows are unique and already split by id: the join adds no exchange
    # of the articles, and no id is hot any more.
    todo = enrich.pending(silver(spark, sf_dir), done, "id")
    # The one query whose answers come from Python, as those of a model's client do.
    rows = enrich.analysed(todo, python_article_scorer())
    shown = rows.select("id", *enrich.ANALYSIS_COLUMNS, "ai_cell_res_15")
    return as_text(shown, "ai_cell_res_15")


def article_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles per place in whose finest cell their inferred city lies."""
    places = spark.createDataFrame(
        [(p[4], p[6], p[7]) for p in PLACES], "place STRING, latitude DOUBLE, longitude DOUBLE"
    ).select("place", cell(F.col("longitude"), F.col("latitude")).alias("place_cell"))
    per_cell = (
        enriched(spark, sf_dir).groupBy("ai_cell_res_15", "language").agg(F.count("*").alias("n"))
    )
    return join_on_cell(per_cell, places, "ai_cell_res_15", "place_cell").select(
        "place", F.col("place_cell").alias("cell"), "language", "n"
    )


def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that keep and break each part of the contract.

    Answers for articles with labels are disturbed: poor ones are bare text, toxic ones carry one
    field more.
    """
    prompt = enrich.article_prompt(F.col("title"), F.col("description"))
    articles = silver(spark, sf_dir).select("id", "title", "description", "language")
    rows = articles.withColumn("raw", article_scorer()(prompt)).join(
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), "id", "left"
    )
    disturbed = (
        F.when(F.col("quality") == 0, F.col("title"))
        .when(F.col("toxic") == 1, F.regexp_replace("raw", r"\}$", ',"note":"x"}'))
        .otherwise(F.col("raw"))
    )
    schema = ", ".join(f"{k} {v}" for k, v in ANALYSIS_FIELDS.items())
    checked = rows.select(disturbed.alias("raw")).withColumn("parsed", F.from_json("raw", schema))
    rules = enrich.contract_rules(F.col("raw"), F.col("parsed"), ANALYSIS_FIELDS)
    return quality.expectation_counts(checked, rules)


def _surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surveys.survey_rows(enriched(spark, sf_dir), survey_scorer)


SURVEY_SHOWN = [
    c
    for c in surveys.SURVEY_COLUMNS
    if c
    not in (
        "created_at", "generated_at", "options", "metadata", "reasoning", "survey_generation_json",
        "news_input_json",
    )
]


SURVEY_TEXT = ["min_value", "max_value", "show_results_on_close"]


def survey_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey per article."""
    rows = _surveys(spark, sf_dir).select(
        *SURVEY_SHOWN,
        F.size("options").alias("n_options"),
        F.col("metadata.geographic_context.city").alias("city"),
        F.col("reasoning.options_rationale").alias("rationale"),
        F.get_json_object("news_input_json", "$.country").alias("input_country"),
    )
    return as_text(rows, *SURVEY_TEXT)


def survey_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per option of every survey, with the composite key."""
    return surveys.survey_options(_surveys(spark, sf_dir)).drop("created_at")


def survey_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectation_counts(_surveys(spark, sf_dir), surveys.survey_rules())


def email_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, by language and whether they are valid addresses."""
    words = table(spark, sf_dir, "documents").select(
        "lang", F.explode(F.split("text", r"[ \n]+")).alias("word")
    )
    return quality.email_report(words, "word", "lang")


QUERIES = {
    "bronze_parse": bronze_parse,
    "expectation_counts": expectations,
    "silver_flatten": silver_flatten,
    "silver_dedup": silver_dedup,
    "topics_drift": topics_drift,
    "enrich_articles": enrich_articles,
    "article_places": article_places,
    "enrich_contract_report": contract_report,
    "survey_rows": survey_rows,
    "survey_options": survey_options,
    "survey_contract_report": survey_contract,
    "email_validity_report": email_validity,
}


# --- SQL twins ----------------------------------------------------------------------------------

SENT = f"""(SELECT d.*, c.copy, l.toxic, l.quality,
      split_part(d.text, chr(10), 1) AS title,
      CASE WHEN copy = 1 AND toxic = 1 THEN NULL ELSE 'articles' END AS topic,
      CAST(d.doc_id % 4 AS INTEGER) AS partition, d.doc_id * 2 + copy AS "offset",
      TIMESTAMP '{START}' + to_minutes(CAST(d.doc_id AS INTEGER)) + to_days(copy) AS sent,
      CASE WHEN copy = 1 AND quality = 0 AND toxic = 1 THEN 'empty'
        WHEN copy = 1 AND quality = 0 THEN 'text' ELSE 'article' END AS kind
    FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id
    JOIN (SELECT 0 AS copy UNION ALL SELECT 1) AS c ON c.copy = 0 OR l.doc_id IS NOT NULL)"""


def _hits(word: str) -> str:
    return f"(length(prompt) - length(replace(prompt, '{word}', ''))) // {len(word)}"


_PLACES = ", ".join(
    f"('{p[0]}', '{p[3]}', '{p[4]}', '{p[5]}', {p[6]}::DOUBLE, {p[7]}::DOUBLE, '{p[8]}')"
    for p in PLACES
)
_COUNTS = ", ".join(f"{_hits(p[1])} + {_hits(p[2])} AS {p[0]}" for p in PLACES)
_PROMPTS = f"""(SELECT doc_id, lang, source, title, {_COUNTS} FROM (
    SELECT *, title || chr(10) || 'Description: ' || text AS prompt FROM {SENT} AS s
    WHERE copy = 0) AS p)"""
ANALYSED = f"""(SELECT doc_id, lang, source, title, p.* FROM (SELECT *, CASE
      WHEN greatest(en, de, fr, es) = 0 THEN NULL WHEN en = greatest(en, de, fr, es) THEN 'en'
      WHEN de = greatest(en, de, fr, es) THEN 'de' WHEN fr = greatest(en, de, fr, es) THEN 'fr'
      ELSE 'es' END AS guess FROM {_PROMPTS} AS q) AS a
    LEFT JOIN (VALUES {_PLACES}) AS p(ai_language, ai_country, ai_city, ai_state, ai_latitude,
      ai_longitude, ai_wikidataID) ON p.ai_language = a.guess)"""
_SIDE = float(1 << FINEST)
AI_CELL = (
    f"CAST(floor((ai_latitude + 90.0) / 180.0 * {_SIDE}) * {_SIDE} "
    f"+ floor((ai_longitude + 180.0) / 360.0 * {_SIDE}) AS BIGINT)"
)
_SURVEYS = f"""(SELECT *, 'Che cosa pensi di questa notizia da ' || coalesce(ai_city, 'questa città')
      || '?' AS survey_title,
      CASE ai_language WHEN 'en' THEN ['D’accordo', 'In disaccordo', 'Non so']
        WHEN 'de' THEN ['Qualità', 'Costi', 'Tempi', 'Accesso']
        WHEN 'fr' THEN ['Utilità', 'Chiarezza', 'Urgenza']
        ELSE ['Vantaggi', 'Problemi'] END AS options
    FROM {ANALYSED} AS a)"""


def _report(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {holds}) AS passed,"
        f" count(*) - count(*) FILTER (WHERE {holds}) AS failed FROM {source} AS s"
        for name, holds in rules.items()
    )


_DISTURBED = f"""(SELECT a.ai_language IS NOT NULL AS full_answer, coalesce(l.quality = 0, false)
      AS is_text, coalesce(l.toxic = 1, false) AS has_note
    FROM {ANALYSED} AS a LEFT JOIN labels AS l ON l.doc_id = a.doc_id)"""

ORACLES = {
    "bronze_parse": as_text_sql(
        f"""SELECT topic, partition, "offset",
        strftime(sent, '%Y-%m-%d %H:%M:%S') AS enqueued_at, strftime(sent, '%Y-%m-%d') AS enqueued_on,
        kind <> 'empty' AS parsed, CASE WHEN kind = 'article' THEN doc_id END AS id,
        CASE WHEN kind = 'article' THEN lang END AS language,
        CASE WHEN kind = 'article' THEN title END AS title,
        CASE WHEN kind = 'article' THEN 2 END AS n_topics FROM {SENT} AS s""",
        "id", "n_topics",
    ),
    "expectation_counts": _report(
        SENT,
        {
            "valid_topic": "topic IS NOT NULL",
            "valid records": "kind <> 'empty'",
            "identified article": "kind = 'article'",
        },
    ),
    "silver_flatten": as_text_sql(
        f"""SELECT topic, partition, "offset",
        strftime(sent, '%Y-%m-%d %H:%M:%S') AS sent_at, 0 AS timestampType, doc_id AS id,
        'https://' || source || '.example.org/' || CAST(doc_id AS VARCHAR) AS href,
        strftime(sent - to_days(copy), '%Y-%m-%dT%H:%M:%SZ') AS published_at, title,
        text AS description, text AS body, lang AS language, doc_id % 50 AS author_id,
        source AS name, CAST(NULL AS VARCHAR) AS image, '/tags/' || lang AS category_link,
        upper(source) AS second_topic, true AS no_industries, true AS no_entities,
        source || '.example.org' AS domain, upper(lang) AS country_code, 0.25::DOUBLE AS score,
        CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_sentences,
        string_split(text, chr(10))[-1] AS last_sentence, lang || '+' || source AS keywords,
        CAST(NULL AS BOOLEAN) AS is_duplicate, n_chars > 2000 AS is_paywall,
        CAST(NULL AS BOOLEAN) AS is_breaking, CAST(NULL AS BIGINT) AS read_time,
        CAST(NULL AS BIGINT) AS sentences_count, len(string_split(text, chr(10)))
        AS paragraphs_count, len(string_split(text, ' ')) AS words_count,
        n_chars AS characters_count, strftime(sent - to_days(copy), '%Y-%m-%d %H:%M:%S') AS got_at,
        strftime(sent, '%Y-%m-%d') AS enqueued_on FROM {SENT} AS s WHERE kind = 'article'""",
        *FLAT_TEXT,
    ),
    "silver_dedup": f"""SELECT doc_id AS id, "offset",
        strftime(sent, '%Y-%m-%d %H:%M:%S') AS sent_at, title, lang AS language
        FROM {SENT} AS s WHERE copy = 0""",
    "topics_drift": f"""SELECT sent_as, parsed_as, lang AS language,
        CASE WHEN sent_as = 'objects' THEN upper(lang) WHEN parsed_as = 'names' THEN lang END
          AS first_topic, count(*) AS n,
        CASE WHEN sent_as = 'names' AND parsed_as = 'objects' THEN 0 ELSE count(*) END
          AS n_with_topics
        FROM {SENT} AS s, (VALUES ('objects'), ('names')) AS a(sent_as),
          (VALUES ('objects'), ('names')) AS b(parsed_as) WHERE kind = 'article'
        GROUP BY 1, 2, 3, 4""",
    "enrich_articles": as_text_sql(
        f"""SELECT a.doc_id AS id, ai_language, a.title AS ai_summary, ai_country,
        ai_city, ai_state, ai_latitude, ai_longitude, ai_wikidataID, {AI_CELL} AS ai_cell_res_15
        FROM {ANALYSED} AS a WHERE a.doc_id NOT IN (SELECT doc_id FROM labels)""",
        "ai_cell_res_15",
    ),
    "article_places": f"""SELECT ai_city AS place, {AI_CELL} AS cell, lang AS language,
        count(*) AS n FROM {ANALYSED} AS a WHERE ai_city IS NOT NULL GROUP BY 1, 2, 3""",
    "enrich_contract_report": _report(
        _DISTURBED,
        {
            "answer is a JSON object": "NOT is_text",
            "no field is missing": "NOT is_text AND full_answer",
            "no other field": "NOT is_text AND NOT has_note",
            "every field has its type": "NOT is_text AND full_answer",
        },
    ),
    "survey_rows": as_text_sql(
        f"""SELECT doc_id AS id, survey_title AS title, title AS description,
        CASE ai_language WHEN 'en' THEN 'single_choice' WHEN 'de' THEN 'rating'
          WHEN 'fr' THEN 'scale' ELSE 'open_text' END AS question_type,
        CAST(CASE WHEN ai_language = 'fr' THEN 1 END AS INTEGER) AS min_value,
        CAST(CASE WHEN ai_language = 'fr' THEN 10 END AS INTEGER) AS max_value,
        CASE WHEN ai_language = 'fr' THEN 'poco' END AS scale_min_label,
        CASE WHEN ai_language = 'fr' THEN 'molto' END AS scale_max_label,
        CASE ai_language WHEN 'de' THEN 'scheduled' WHEN 'fr' THEN 'manual' ELSE 'permanent' END
          AS closure_type, CAST(NULL AS VARCHAR) AS expires_at, true AS is_active,
        ai_language = 'de' AS show_results_on_close, false AS allow_multiple_responses,
        false AS allow_custom_options, false AS require_comment,
        CASE WHEN ai_language = 'de' THEN 'star' END AS rating_icon, false AS is_anonymous,
        'news' AS resource_type,
        'https://' || source || '.example.org/' || CAST(doc_id AS VARCHAR) AS resource_url,
        doc_id AS resource_news_id, 1 AS user_id, CAST(len(options) AS INTEGER) AS n_options,
        ai_city AS city, 'template' AS rationale, ai_country AS input_country
        FROM {_SURVEYS} AS s""",
        *SURVEY_TEXT,
    ),
    "survey_options": f"""SELECT CAST(CAST(survey_id AS VARCHAR) || CAST(option_order AS VARCHAR)
          AS BIGINT) AS id, survey_id, option_text, option_order, 1 AS user_id
        FROM (SELECT doc_id AS survey_id, unnest(options) AS option_text,
          CAST(generate_subscripts(options, 1) AS INTEGER) AS option_order FROM {_SURVEYS} AS s)
          AS o""",
    "survey_contract_report": _report(
        _SURVEYS,
        {
            # Without a language the template cannot say whether results are shown: NULL.
            "required fields are present": "ai_language IS NOT NULL",
            "title is short": "length(survey_title) <= 60",
            "question type is known": "true",
            "closure type is known": "true",
            "rating icon is known or missing": "true",
            "resource type is known": "true",
            "number of options is right": "len(options) BETWEEN 3 AND 5",
            "options are complete": "true",
            "options are short": "true",
        },
    ),
    "email_validity_report": """SELECT lang, regexp_matches(word,
          '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$') AS is_valid, count(*) AS n
        FROM (SELECT lang, unnest(regexp_split_to_array(text, '[ \\n]+')) AS word FROM documents)
          AS w GROUP BY 1, 2""",
}

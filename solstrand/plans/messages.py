"""Article messages made from the stored documents, and rule scorers in place of models.

Every document is sent once; documents that have a label are sent again a day later.  What is sent
again depends on the label: good ones as the same article, poor ones as bare text that is no JSON,
poor and toxic ones as empty text; toxic ones without a topic.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.operators.enrich import Scorer, python_scorer

START = "2024-01-01 00:00:00"

# Language, two words that mark it, and the place an article in it is about.
PLACES = [
    ("en", " the ", " and ", "United Kingdom", "London", "GB-LND", 51.5, -0.125, "Q84"),
    ("de", " der ", " und ", "Germany", "Berlin", "DE-BE", 52.5, 13.375, "Q64"),
    ("fr", " le ", " et ", "France", "Paris", "FR-75", 48.875, 2.375, "Q90"),
    ("es", " el ", " y ", "Spain", "Madrid", "ES-MD", 40.375, -3.75, "Q2807"),
]


def _tag(name: Column) -> Column:
    return F.struct(
        name.alias("id"),
        F.upper(name).alias("name"),
        F.lit(0.5).alias("score"),
        F.lit("list").alias("taxonomy"),
        F.struct(F.concat(F.lit("/tags/"), name).alias("self")).alias("links"),
    )


def article_json(topics: str) -> Column:
    """A document as the JSON of an article, topics as "objects" or "names"."""
    doc_id, text, lines = F.col("doc_id"), F.col("text"), F.split("text", "\n")
    stamp = F.timestamp_add("MINUTE", doc_id.cast("int"), F.lit(START).cast("timestamp"))
    polarity = F.struct(F.lit(0.25).alias("score"), F.lit("neutral").alias("polarity"))
    names = F.array("lang", "source")
    return F.to_json(
        F.struct(
            doc_id.alias("id"),
            F.concat(F.lit("https://"), "source", F.lit(".example.org/"), doc_id).alias("href"),
            F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
            F.substring_index("text", "\n", 1).alias("title"),
            text.alias("description"),
            text.alias("body"),
            F.col("lang").alias("language"),
            F.struct((doc_id % 50).alias("id"), F.col("source").alias("name")).alias("author"),
            F.array(_tag(F.col("lang"))).alias("categories"),
            (F.transform(names, _tag) if topics == "objects" else names).alias("topics"),
            F.struct(
                F.concat("source", F.lit(".example.org")).alias("domain"),
                F.struct(F.upper("lang").alias("country_code")).alias("location"),
            ).alias("source"),
            F.struct(polarity.alias("overall")).alias("sentiment"),
            F.transform(lines, lambda s: F.struct(s.alias("sentence"))).alias("summary"),
            names.alias("keywords"),
            (F.col("n_chars") > 2000).alias("is_paywall"),
            F.size(lines).alias("paragraphs_count"),
            F.size(F.split("text", " ")).alias("words_count"),
            F.col("n_chars").alias("characters_count"),
            F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("getdata_timestamp"),
        )
    )


def article_messages(documents: DataFrame, labels: DataFrame, topics: str = "objects") -> DataFrame:
    """The documents as rows of a Kafka source; `documents` may be a stream."""
    article, toxic, poor = article_json(topics), F.col("toxic") == 1, F.col("quality") == 0
    again = (
        F.when(poor & toxic, F.lit(""))
        .when(poor, F.col("text"))
        .otherwise(F.col("article"))
    )

    def message(copy: int, value: Column, topic: Column) -> Column:
        minutes = F.col("doc_id").cast("int") + 1440 * copy
        return F.struct(
            F.lit(copy).alias("copy"),
            value.alias("value"),
            topic.alias("topic"),
            F.timestamp_add("MINUTE", minutes, F.lit(START).cast("timestamp")).alias("timestamp"),
        )

    first = message(0, F.col("article"), F.lit("articles"))
    second = message(1, again, F.when(toxic, F.lit(None)).otherwise(F.lit("articles")))
    sent = F.when(F.col("toxic").isNull(), F.array(first)).otherwise(F.array(first, second))
    return (
        # Made behind the join: if that exchanges its sides, the text travels once, not in five places.
        documents.join(labels, "doc_id", "left")
        .withColumn("article", article)
        .select("doc_id", F.explode(sent).alias("m"))
        .select(
            F.col("doc_id").cast("string").cast("binary").alias("key"),
            F.col("m.value").cast("binary").alias("value"),
            F.col("m.topic").alias("topic"),
            (F.col("doc_id") % 4).cast("int").alias("partition"),
            (F.col("doc_id") * 2 + F.col("m.copy")).alias("offset"),
            F.col("m.timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
    )


def _times(text: Column, word: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / len(word)


def article_scorer() -> Scorer:
    """A rule in place of a model: the place whose two marker words occur most often."""

    def answer(prompt: Column) -> Column:
        start = F.instr(prompt, "\nTitle: ") + len("\nTitle: ")
        article = F.when(F.instr(prompt, "\nTitle: ") > 0, F.substring(prompt, start, F.length(prompt)))
        hits = F.array(*[_times(article, p[1]) + _times(article, p[2]) for p in PLACES])
        counted = F.struct(hits.alias("hits"), F.substring_index(article, "\n", 1).alias("title"))

        def chosen(facts: Column) -> Column:
            most = F.array_max(facts["hits"])
            first = F.array_position(facts["hits"], most).cast("int")
            # Without any marker word only the summary can be told.
            name = F.when(most > 0, F.get(F.array(*[F.lit(p[0]) for p in PLACES]), first - 1))
            return F.struct(name.alias("k"), facts["title"].alias("title"))

        # The lambdas' variables stand for the text's counts and facts, worked out once.
        return F.get(F.transform(F.transform(F.array(counted), chosen), _place_json), F.lit(0))

    return lambda prompt: F.when(prompt.isNotNull(), answer(prompt))


def _place_json(known: Column) -> Column:
    def fact(i: int) -> Column:
        out = F.lit(None)
        for place in PLACES:
            out = F.when(known["k"] == place[0], F.lit(place[i])).otherwise(out)
        return out

    names = ["country", "city", "state_iso3166_2", "latitude", "longitude", "wikidataID"]
    return F.to_json(
        F.struct(
            known["k"].alias("language"),
            known["title"].alias("summary"),
            *[fact(i + 3).alias(n) for i, n in enumerate(names)],
        )
    )


def python_article_scorer() -> Scorer:
    """The same rule as a batch function in Python, as a model's client would be.

    The rule is a function inside this one, so that it travels to the executors as a whole and
    they need no copy of this package.
    """

    def answers(prompts: pd.Series) -> pd.Series:
        article = prompts.str.partition("\nTitle: ")[2]
        hits = pd.DataFrame(
            {p[0]: article.str.count(p[1]) + article.str.count(p[2]) for p in PLACES}
        )
        best = hits.idxmax(axis=1).where(hits.max(axis=1) > 0)
        title = article.str.partition("\n")[0]
        names = ["country", "city", "state_iso3166_2", "latitude", "longitude", "wikidataID"]
        known = {p[0]: dict(zip(names, p[3:])) for p in PLACES}
        return pd.Series(
            [
                # Without any marker word only the summary can be told.
                json.dumps({"language": k if k in known else None, "summary": t, **known.get(k, {})})
                for k, t in zip(best, title)
            ]
        )

    return python_scorer(answers)


def survey_scorer(news_json: Column) -> Column:
    """A template per language in place of a model; its input is parsed once for each row."""
    news = F.from_json(
        news_json,
        "language STRING, summary STRING, country STRING, city STRING, ai_state STRING, "
        "latitude DOUBLE, longitude DOUBLE, wikidataID STRING",
    )
    made = F.get(F.transform(F.array(news), _survey_json), F.lit(0))
    return F.when(news_json.isNotNull(), made)


def _survey_json(news: Column) -> Column:
    language, city = news["language"], F.coalesce(news["city"], F.lit("questa città"))

    def by_language(en, de, fr, other) -> Column:
        chosen = F.when(language == "en", en).when(language == "de", de).when(language == "fr", fr)
        return chosen.otherwise(other)

    def options(*texts: str) -> Column:
        return F.array(
            *[
                F.struct(F.lit(t).alias("option_text"), F.lit(i + 1).alias("option_order"))
                for i, t in enumerate(texts)
            ]
        )

    none = F.lit(None)
    survey = F.struct(
        F.concat(F.lit("Che cosa pensi di questa notizia da "), city, F.lit("?")).alias("title"),
        F.coalesce(news["summary"], F.lit("")).alias("description"),
        by_language(
            F.lit("single_choice"), F.lit("rating"), F.lit("scale"), F.lit("open_text")
        ).alias("question_type"),
        by_language(
            F.lit("permanent"), F.lit("scheduled"), F.lit("manual"), F.lit("permanent")
        ).alias("closure_type"),
        F.lit(True).alias("is_active"),
        (language == "de").alias("show_results_on_close"),
        F.lit(True).alias("allow_multiple_responses"),
        F.lit(False).alias("allow_custom_options"),
        F.lit(True).alias("require_comment"),
        by_language(none, F.lit("star"), none, none).alias("rating_icon"),
        F.lit(False).alias("is_anonymous"),
        F.lit("news").alias("resource_type"),
        F.lit("").alias("resource_url"),
        by_language(none, none, F.lit(1), none).alias("min_value"),
        by_language(none, none, F.lit(10), none).alias("max_value"),
        by_language(none, none, F.lit("poco"), none).alias("scale_min_label"),
        by_language(none, none, F.lit("molto"), none).alias("scale_max_label"),
    )
    answer = F.struct(
        survey.alias("survey"),
        by_language(
            options("D’accordo", "In disaccordo", "Non so"),
            options("Qualità", "Costi", "Tempi", "Accesso"),
            options("Utilità", "Chiarezza", "Urgenza"),
            # One too few: the contract asks for three.
            options("Vantaggi", "Problemi"),
        ).alias("options"),
        F.struct(
            F.struct(
                news["country"].alias("country"),
                news["city"].alias("city"),
                news["latitude"].alias("latitude"),
                news["longitude"].alias("longitude"),
            ).alias("geographic_context"),
            language.alias("language"),
        ).alias("metadata"),
        F.struct(F.lit("template").alias("options_rationale")).alias("reasoning"),
    )
    return F.to_json(answer)

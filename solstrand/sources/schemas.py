"""Schemas of the outside data.  All names and types here are fixed values: they are what the
senders send."""

from __future__ import annotations

LINK = "STRUCT<self: STRING>"
TAG = f"STRUCT<id: STRING, name: STRING, score: DOUBLE, taxonomy: STRING, links: {LINK}>"
SPOTS = "STRUCT<pos: ARRAY<STRUCT<start: BIGINT, end: BIGINT>>>"
POLARITY = "STRUCT<score: DOUBLE, polarity: STRING>"

# Article fields in order.  `topics` exists in two forms: objects (the form parsed so far) and
# plain names (the newer one).
ARTICLE_FIELDS = {
    "id": "BIGINT",
    "href": "STRING",
    "published_at": "STRING",
    "title": "STRING",
    "description": "STRING",
    "body": "STRING",
    "language": "STRING",
    "author": "STRUCT<id: BIGINT, name: STRING>",
    "image": "STRING",
    "categories": f"ARRAY<{TAG}>",
    "topics": f"ARRAY<{TAG}>",
    "industries": f"ARRAY<STRUCT<id: BIGINT, name: STRING, links: {LINK}>>",
    "entities": (
        "ARRAY<STRUCT<id: BIGINT, name: STRING, "
        "links: STRUCT<self: STRING, wikipedia: STRING, wikidata: STRING>, "
        "types: ARRAY<STRING>, language: STRING, frequency: BIGINT, "
        f"title: {SPOTS}, body: {SPOTS}>>"
    ),
    "source": (
        "STRUCT<id: BIGINT, domain: STRING, home_page_url: STRING, type: STRING, bias: STRING, "
        "rankings: STRUCT<opr: DOUBLE>, "
        "location: STRUCT<country_name: STRING, country_code: STRING>, favicon: STRING>"
    ),
    "sentiment": f"STRUCT<overall: {POLARITY}, title: {POLARITY}, body: {POLARITY}>",
    "summary": f"ARRAY<STRUCT<sentence: STRING, sentiment: {POLARITY}>>",
    "keywords": "ARRAY<STRING>",
    "links": "ARRAY<STRING>",
    "media": "ARRAY<STRUCT<url: STRING, type: STRING, format: STRING>>",
    "story": "STRUCT<id: BIGINT, uri: STRING>",
    "is_duplicate": "BOOLEAN",
    "is_paywall": "BOOLEAN",
    "is_breaking": "BOOLEAN",
    "read_time": "BIGINT",
    "sentences_count": "BIGINT",
    "paragraphs_count": "BIGINT",
    "words_count": "BIGINT",
    "characters_count": "BIGINT",
    "getdata_timestamp": "TIMESTAMP",
    "enrich_timestamp": "TIMESTAMP",
    "loaddata_timestamp": "TIMESTAMP",
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


def article_schema(topics: str = "objects") -> str:
    """DDL of an article; `topics` is "objects" or "names"."""
    if topics not in ("objects", "names"):
        raise ValueError("topics must be 'objects' or 'names'")
    fields = dict(ARTICLE_FIELDS)
    if topics == "names":
        fields["topics"] = "ARRAY<STRING>"
    return ddl(fields)


# The columns of a Kafka source.
MESSAGE = ddl(
    {
        "key": "BINARY",
        "value": "BINARY",
        "topic": "STRING",
        "partition": "INT",
        "offset": "BIGINT",
        "timestamp": "TIMESTAMP",
        "timestampType": "INT",
    }
)

# What the article model answers, all fields required, no others allowed.
ANALYSIS_FIELDS = {
    "language": "STRING",
    "summary": "STRING",
    "country": "STRING",
    "city": "STRING",
    "state_iso3166_2": "STRING",
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "wikidataID": "STRING",
}

# What the survey model answers.
SURVEY_FIELDS = {
    "title": "STRING",
    "description": "STRING",
    "question_type": "STRING",
    "closure_type": "STRING",
    "expires_at": "STRING",
    "is_active": "BOOLEAN",
    "show_results_on_close": "BOOLEAN",
    "allow_multiple_responses": "BOOLEAN",
    "allow_custom_options": "BOOLEAN",
    "require_comment": "BOOLEAN",
    "rating_icon": "STRING",
    "is_anonymous": "BOOLEAN",
    "resource_type": "STRING",
    "resource_url": "STRING",
    "min_value": "INT",
    "max_value": "INT",
    "scale_min_label": "STRING",
    "scale_max_label": "STRING",
}
SURVEY_REQUIRED = [
    "title", "description", "question_type", "closure_type", "is_active", "show_results_on_close",
    "allow_custom_options", "is_anonymous", "resource_type",
]
PLACE_FIELDS = {
    "country": "STRING",
    "city": "STRING",
    "state": "STRING",
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "wikidataID": "STRING",
}
REASONING_FIELDS = {
    "question_type_rationale": "STRING",
    "closure_type_rationale": "STRING",
    "anonymity_rationale": "STRING",
    "options_rationale": "STRING",
    "geographic_relevance": "STRING",
}
SURVEY_ANSWER = ddl(
    {
        "survey": f"STRUCT<{ddl(SURVEY_FIELDS)}>",
        "options": "ARRAY<STRUCT<option_text STRING, option_order INT>>",
        "metadata": (
            f"STRUCT<geographic_context STRUCT<{ddl(PLACE_FIELDS)}>, language STRING>"
        ),
        "reasoning": f"STRUCT<{ddl(REASONING_FIELDS)}>",
    }
)
QUESTION_TYPES = ["single_choice", "multiple_choice", "open_text", "scale", "rating", "date"]
CLOSURE_TYPES = ["permanent", "scheduled", "manual"]
RATING_ICONS = ["star", "heart", "number"]
RESOURCE_TYPES = ["news"]
LONGEST_TEXT = 60
OPTIONS_MIN, OPTIONS_MAX = 3, 5

# An article on a page of the news interface.  Fields whose inner form is not stated stay JSON text.
API_ARTICLE_FIELDS = {
    "id": "BIGINT",
    "href": "STRING",
    "published_at": "STRING",
    "title": "STRING",
    "description": "STRING",
    "body": "STRING",
    "excerpt": "STRING",
    "language": "STRING",
    "sentiment": ARTICLE_FIELDS["sentiment"],
    "categories": ARTICLE_FIELDS["categories"],
    "topics": ARTICLE_FIELDS["topics"],
    "industries": ARTICLE_FIELDS["industries"],
    "entities": ARTICLE_FIELDS["entities"],
    "persons": "ARRAY<STRING>",
    "locations": "ARRAY<STRING>",
    "organizations": "ARRAY<STRING>",
    "brands": "ARRAY<STRING>",
    "author": "STRUCT<id: BIGINT, name: STRING, href: STRING>",
    "image": "STRING",
    "images": "ARRAY<STRING>",
    "media": ARTICLE_FIELDS["media"],
    "is_duplicate": "BOOLEAN",
    "is_paywall": "BOOLEAN",
    "is_breaking": "BOOLEAN",
    "source": (
        "STRUCT<id: BIGINT, name: STRING, href: STRING, rank: STRING, categories: STRING, "
        "location: STRING>"
    ),
    "keywords": "ARRAY<STRING>",
    "paywall_url": "STRING",
    "canonical_url": "STRING",
}
API_PAGE = f"`results` ARRAY<STRUCT<{ddl(API_ARTICLE_FIELDS)}>>"

# A listing of the data marketplace.
PERIOD = "STRUCT<interval: BIGINT, unit: STRING>"
LISTING_DETAIL_FIELDS = {
    "assets": "ARRAY<STRING>",
    "collection_date_end": "BIGINT",
    "collection_date_start": "BIGINT",
    "collection_granularity": PERIOD,
    "cost": "STRING",
    "data_source": "STRING",
    "description": "STRING",
    "documentation_link": "STRING",
    "embedded_notebook_file_infos": (
        "ARRAY<STRUCT<created_at: BIGINT, display_name: STRING, download_link: STRING, "
        "file_parent: STRUCT<file_parent_type: STRING, parent_id: STRING>, id: STRING, "
        "marketplace_file_type: STRING, mime_type: STRING, status: STRING, "
        "status_message: STRING, updated_at: BIGINT>>"
    ),
    "file_ids": "ARRAY<STRING>",
    "geographical_coverage": "STRING",
    "license": "STRING",
    "pricing_model": "STRING",
    "privacy_policy_link": "STRING",
    "size": "DOUBLE",
    "support_link": "STRING",
    "tags": "ARRAY<STRUCT<tag_name: STRING, tag_values: ARRAY<STRING>>>",
    "terms_of_service": "STRING",
    "update_frequency": PERIOD,
}
LISTING_SUMMARY_FIELDS = {
    "categories": "ARRAY<STRING>",
    "created_at": "BIGINT",
    "created_by": "STRING",
    "created_by_id": "BIGINT",
    "exchange_ids": "ARRAY<STRING>",
    "git_repo": "STRUCT<git_repo_url: STRING>",
    "listingType": "STRING",
    "name": "STRING",
    "provider_id": "STRING",
    "provider_region": "STRUCT<cloud: STRING, region: STRING>",
    "published_at": "BIGINT",
    "published_by": "STRING",
    "setting": "STRUCT<visibility: STRING>",
    "share": "STRUCT<name: STRING, type: STRING>",
    "status": "STRING",
    "subtitle": "STRING",
    "updated_at": "BIGINT",
    "updated_by": "STRING",
    "updated_by_id": "BIGINT",
}
LISTING = ddl(
    {
        "id": "STRING",
        "detail": f"STRUCT<{ddl(LISTING_DETAIL_FIELDS)}>",
        "summary": f"STRUCT<{ddl(LISTING_SUMMARY_FIELDS)}>",
    }
)

"""Fields of the page metadata JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_whitespace

BAD = "_bad"
OUTER_SCHEMA = f"http_result STRING, content STRING, {BAD} STRING"
CONTENT_SCHEMA = "title STRING, type STRING, meta_tags STRING"
TAG_SCHEMA = "name STRING, content STRING"
# Fixed values.
HTML_TYPE = "html-doc"
KEYWORDS_TAG = "keywords"


def parse_metadata(json: Column) -> Column:
    """Status, content and _bad, which is set only for text that is no JSON object.

    Values are taken leniently: a status is a number however written (200, 200.0, "200"), fields of
    another type are their text, and what is no list of tag objects has no tags.
    """
    outer = F.from_json(json, OUTER_SCHEMA, {"columnNameOfCorruptRecord": BAD})

    def tags(text: Column) -> Column:
        listed = F.from_json(text, "array<string>")
        return F.transform(listed, lambda tag: F.from_json(tag, TAG_SCHEMA))

    def content(text: Column) -> Column:
        return F.transform(
            F.array(F.from_json(text, CONTENT_SCHEMA)),
            lambda c: F.struct(c["title"], c["type"], tags(c["meta_tags"]).alias("meta_tags")),
        )

    def fields(o: Column) -> Column:
        status = o["http_result"].try_cast("double").try_cast("int")
        parsed = F.get(content(o["content"]), F.lit(0))
        return F.struct(status.alias("http_result"), parsed.alias("content"), o[BAD].alias(BAD))

    # Each step once, through a list of one.
    return F.get(F.transform(F.array(outer), fields), F.lit(0))


def page_title(meta: Column) -> Column:
    return F.coalesce(collapse_whitespace(meta["content"]["title"]), F.lit(""))


def page_keywords(meta: Column) -> Column:
    """Content of the last keywords tag that has any, or the empty string."""
    tags = F.filter(
        meta["content"]["meta_tags"],
        lambda t: t.isNotNull() & (t["name"] == KEYWORDS_TAG) & t["content"].isNotNull(),
    )
    return F.coalesce(
        collapse_whitespace(F.try_element_at(tags, F.lit(-1))["content"]), F.lit("")
    )


def status_class(status: Column) -> Column:
    return (
        F.when(status.isNull(), "UNDEFINED")
        .when(status < 200, "INFO_1XX")
        .when(status < 300, "SUCCESS_2XX")
        .when(status < 400, "REDIRECTION_3XX")
        .when(status < 500, "ERROR_4XX")
        .otherwise("ERROR_5XX")
    )

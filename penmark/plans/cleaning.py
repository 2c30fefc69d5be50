"""Text cleaning rules, character sets and the whole cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import text as t
from penmark.operators import clean as cl
from penmark.plans import sql, views as v
from penmark.plans.landing import CLEAN_BODY, cleaned_tweety
from penmark.plans.registry import query
from penmark.plans.sql import with_views


def _rule(name, rule, sql_text):
    @query(name, with_views(f"SELECT doc_id, {sql_text} AS text FROM tweety", "tweety"))
    def run(spark, sf_dir):
        return v.tweety(spark, sf_dir).select("doc_id", rule(F.col("text")).alias("text"))


_rule("clean_urls", t.remove_urls, sql.urls("text"))
_rule("clean_mentions", t.remove_mentions, sql.mentions("text"))
_rule("clean_hashtags", t.remove_hashtags, sql.hashtags("text"))
_rule("clean_emoji", t.remove_emojis, sql.emojis("text"))
_rule("clean_spaces", t.strip_spaces, sql.spaces("text"))
_rule("clean_lower", t.to_lower, "lower(text)")
_rule("clean_text", t.clean_text, sql.cleaned("text"))
_rule(
    "clean_text_flags",
    lambda x: t.clean_text(x, lower=False, remove_hashtag=False, remove_emoji=False),
    f"coalesce({sql.spaces(sql.mentions(sql.urls('text')))}, '')",
)


@query("class_charset", with_views(
    "SELECT DISTINCT label, unnest(string_split(text, '')) AS ch FROM polar", "polar"))
def class_charset(spark, sf_dir):
    return cl.class_charset(v.polar(spark, sf_dir))


_CHARS = "chars AS (SELECT DISTINCT label, unnest(string_split(text, '')) AS ch FROM polar)"


@query("ai_only_chars", with_views("", "polar").rstrip() + f""", {_CHARS}
    SELECT ch FROM chars WHERE label = 1 AND ch NOT IN (SELECT ch FROM chars WHERE label = 0)""")
def ai_only_chars(spark, sf_dir):
    return cl.generated_only_chars(v.polar(spark, sf_dir))


@query("strip_ai_only_chars", with_views("", "polar").rstrip() + f""", {_CHARS},
    unwanted AS (SELECT coalesce(string_agg(ch, ''), '') AS s FROM chars
                 WHERE label = 1 AND ch NOT IN (SELECT ch FROM chars WHERE label = 0))
    SELECT doc_id, label, CASE WHEN label = 1 THEN translate(text, (SELECT s FROM unwanted), '') ELSE text END AS text
    FROM polar""")
def strip_ai_only_chars(spark, sf_dir):
    return cl.strip_generated_only(v.polar(spark, sf_dir).select("doc_id", "label", "text"))


@query("clean_full", with_views("", "tweety").rstrip() + CLEAN_BODY)
def clean_full(spark, sf_dir):
    return cleaned_tweety(spark, sf_dir).select("text_id", "label", "text")

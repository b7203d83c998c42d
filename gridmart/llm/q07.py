"""Query and SQL of the URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.url_filter import UrlRule, judge_urls

NAME = "op7_url_filter"

#: The rules that the query judges by.
RULES = [
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


_RULE = """CASE
  WHEN (h = 'www.example.com' OR h LIKE '%.www.example.com') AND starts_with(p, '/en/') THEN 'www.example.com/en/'
  WHEN (h = 'example.com' OR h LIKE '%.example.com') AND starts_with(p, '/en/') THEN 'example.com/en/'
  WHEN (h = 'net' OR h LIKE '%.net') AND starts_with(p, '/es/') THEN 'net/es/'
  WHEN (h = 'net' OR h LIKE '%.net') AND starts_with(p, '/fr/') THEN 'net/fr/'
  WHEN (h = 'com' OR h LIKE '%.com') AND starts_with(p, '/') THEN 'com/' END"""
_ACTION = "CASE WHEN r IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN r IS NOT NULL THEN 'block' END"

#: Absolute targets only, attributes in double quotes; the operator's tests hold the other forms.
SQL = rf"""
WITH RECURSIVE u AS (
  SELECT page_id, html,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS p,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*(\?[^#]*)', 1) AS q
  FROM pages
), judged AS (
  SELECT *, {_RULE} AS r, h || CASE WHEN p = '' THEN '/' ELSE p END || q AS node FROM u
), tags AS (
  SELECT node, unnest(regexp_extract_all(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g'),
                                         '(?is)<(?:link|meta)\s[^>]*>')) AS tag
  FROM judged WHERE h <> ''
), raw AS (
  SELECT node, CASE WHEN regexp_matches(tag, '(?i)\srel="canonical"') THEN regexp_extract(tag, '(?i)\shref="([^"]*)"', 1)
    WHEN regexp_matches(tag, '(?i)\shttp-equiv="refresh"') THEN regexp_extract(tag, '(?i)url=([^"]*)', 1) ELSE '' END AS target
  FROM tags
), edges AS (
  SELECT DISTINCT node AS a, lower(regexp_extract(target, '://([^/?#]*)', 1))
    || CASE WHEN regexp_extract(target, '://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(target, '://[^/?#]*([^?#]*)', 1) END
    || regexp_extract(target, '(\?[^#]*)', 1) AS b
  FROM raw WHERE contains(target, '://')
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (
  SELECT a, a FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), nodes AS (
  SELECT b, {_ACTION} AS action FROM (
    SELECT b, {_RULE} AS r FROM (
      SELECT DISTINCT b, regexp_extract(b, '^([^/?#]*)', 1) AS h, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS p FROM reach))
), classes AS (SELECT a, min(action) AS passed_on FROM reach JOIN nodes USING (b) GROUP BY a)
SELECT page_id, h AS host, p AS path, r AS rule,
       coalesce({_ACTION}, passed_on, 'allow') AS verdict
FROM judged LEFT JOIN classes ON classes.a = judged.node AND judged.r IS NULL
"""

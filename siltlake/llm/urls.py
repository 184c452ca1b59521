"""URL filter: host/path rules first, then a weighted vocabulary.

The vocabulary has strict and soft terms. One Aho-Corasick pass over the
lower-cased url finds every term; a hit counts only where neither neighbour is
an ASCII letter or digit. One strict term, or ``soft_limit`` different soft
terms, block the page. A rule that fits the host and the path decides before
the vocabulary; of several the longest.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged by its text alone (null: no text); pages that
share an id or a url are judged one by one; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, start of the path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
STRICT = ("cheap-pills", "casino", "porn", "xxx", "viagra", "warez", "escort", "sex")
SOFT = ("cheap", "pills", "free", "adult", "bet", "poker", "dating", "loan", "torrent", "crack", "hot", "win", "bonus", "click")
SOFT_LIMIT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.translate(_after(url, r"[/?#]"), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    rest = _after(url, r"[?#]")
    return F.when(F.instr(rest, "/") > 0, rest.substr(F.instr(rest, "/"), F.length(rest))).otherwise("")


def _after(url: Column, stops: str) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.element_at(F.split(rest, stops, 2), 1)).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (``host/path`` text, verdict), or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest last, so it wins
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def vocabulary_hits(url: Column, strict=STRICT, soft=SOFT) -> Column:
    """``struct(strict: int, soft: int)``: how many different terms of either
    kind the lower-cased text holds between boundaries."""

    @F.pandas_udf("strict int, soft int")
    def hits(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick
        lowered = str.maketrans(_UPPER, _LOWER)
        words = frozenset("0123456789" + _LOWER)
        terms = ahocorasick.Automaton()
        for kind, all_terms in ((0, strict), (1, soft)):
            for term in all_terms:
                terms.add_word(term, (kind, term))
        if len(terms):
            terms.make_automaton()

        def count(text: str | None) -> tuple[int, int]:
            found: tuple[set, set] = (set(), set())
            if text and len(terms):
                text = text.translate(lowered)
                for end, (kind, term) in terms.iter(text):
                    begin = end - len(term) + 1
                    if not (begin and text[begin - 1] in words) and not (end + 1 < len(text) and text[end + 1] in words):
                        found[kind].add(term)
            return len(found[0]), len(found[1])

        for part in parts:
            yield pd.DataFrame([count(x) for x in part], columns=["strict", "soft"])

    return hits(url)


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (``allow``/``block``), strict_hits,
    soft_hits. One pass over the two columns, no shuffle."""
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parts = narrow.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    parts = parts.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                         vocabulary_hits(F.col("url"), strict, soft).alias("hits"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rejected = (F.col("hits.strict") >= 1) | (F.col("hits.soft") >= soft_limit)
    return parts.select("page_id", "host", "path", rule.alias("rule"),
                        F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
                        F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"))


def judge_sql(rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> str:
    """The same in DuckDB SQL over ``pages``."""
    def hits(terms):
        return " + ".join(f"CAST(regexp_matches(t, '(^|[^0-9a-z]){x}($|[^0-9a-z])') AS INT)" for x in terms)

    def case(result):
        return "CASE " + " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{result(v, h, p)}'"
            for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))) + " END"
    return f"""
WITH u AS (SELECT page_id, COALESCE(url, '') AS url FROM pages),
a AS (SELECT page_id, translate(url, '{_UPPER}', '{_LOWER}') AS t,
        CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM u),
b AS (SELECT page_id, t, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, {case(lambda v, h, p: h + p)} AS rule, {case(lambda v, h, p: v)} AS ruled,
        {hits(strict)} AS strict_hits, {hits(soft)} AS soft_hits FROM b)
SELECT page_id, host, path, rule,
  COALESCE(ruled, CASE WHEN strict_hits >= 1 OR soft_hits >= {soft_limit} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(strict_hits AS INT) AS strict_hits, CAST(soft_hits AS INT) AS soft_hits FROM c
"""

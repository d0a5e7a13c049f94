"""URL rules indexed by their rarest literal token, in DataFrame operations only."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many rules the index is a constant of the plan; beyond, it is joined.
INLINE_RULES = 500

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENTRY = "array<struct<weight:int,rule:string,verdict:string,pattern:string>>"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(host: Column, path: Column) -> Column:
    """Literal tokens of a URL: labels of its host and segments of its path."""
    return F.array_distinct(F.concat(F.split(host, r"\."), F.split(path, "/")))


def rule_row(verdict: str, host: str, path: str) -> dict:
    """A rule as a pattern over host and path; its tokens are those that a matching URL must hold whole."""
    text = host.lower() + path
    segments = path.split("/")[:-1]
    return {
        "rule": text,
        "verdict": verdict,
        "weight": len(text),
        "pattern": r"(?s)^(?:[^/]*\.)?" + re.sub(r"([^\w/-])", r"\\\1", text, flags=re.ASCII),
        "tokens": [t for t in host.lower().split(".") + segments if t],
    }


def _indexed(urls: DataFrame, rules: list[dict]) -> list[dict]:
    """Each rule under its token that the fewest URLs hold; all URLs are counted, and one
    row for each token of the rules reaches the driver."""
    wanted = sorted({t for r in rules for t in r["tokens"]})
    counts = {}
    if wanted:
        seen = urls.select(F.explode(tokens_of(F.col("host"), F.col("path"))).alias("token"))
        counts = {r.token: r.n for r in seen.filter(F.col("token").isin(wanted)).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [r | {"token": min(r["tokens"], key=lambda t: (counts.get(t, 0), t))} for r in rules]


def _best(candidates: Column, subject: Column) -> Column:
    """The heaviest candidate whose pattern fits; patterns run on candidates only."""
    return F.array_max(F.filter(candidates, lambda c: F.regexp(subject, c["pattern"])))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``): page_id, host, path, rule, verdict.

    ``rules`` are (verdict, host, path): a rule fits its host and all subdomains if the
    path starts with the rule's; the longest wins, ties go to the greater text, then to the
    greater verdict. Where none fits, rule is null and the verdict is ``default``. Every rule is kept under its rarest
    token, a URL's tokens fetch candidates, and only those run their regular expressions.
    Up to 500 rules the index is a constant of the plan and pages are not shuffled; beyond,
    distinct URLs are judged by a join on tokens.

    A null url or one without ``://`` has an empty host and path, so no rule fits. Repeated
    rows give repeated rows; other columns are ignored; an empty table gives no rows.
    """
    rules = [r if isinstance(r, dict) else rule_row(*r) for r in rules]
    if any(not r["tokens"] for r in rules):
        raise ValueError("a rule needs a host")
    urls = pages.select("page_id", F.col("url").alias("url_"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    entries = _indexed(urls, rules)
    subject = F.concat("host", "path")
    if len(entries) <= INLINE_RULES:
        index: dict[str, list] = {}
        for e in entries:
            index.setdefault(e["token"], []).append({k: e[k] for k in ("weight", "rule", "verdict", "pattern")})
        by_token = F.from_json(F.lit(json.dumps(index)), f"map<string,{_ENTRY}>")
        fetched = F.transform(tokens_of(F.col("host"), F.col("path")), lambda t: F.coalesce(F.try_element_at(by_token, t), F.from_json(F.lit("[]"), _ENTRY)))
        judged = urls.withColumn("best", _best(F.flatten(fetched), subject))
    else:
        spark = pages.sparkSession
        listed = spark.createDataFrame([(e["token"], e["weight"], e["rule"], e["verdict"], e["pattern"]) for e in entries], "token string, weight int, rule string, verdict string, pattern string")
        tokens = urls.select("url_", "host", "path").distinct().withColumn("token", F.explode(tokens_of(F.col("host"), F.col("path"))))
        hits = tokens.join(listed, "token").filter(F.regexp(subject, F.col("pattern")))
        best = hits.groupBy("url_").agg(F.max(F.struct("weight", "rule", "verdict", "pattern")).alias("best"))
        judged = urls.join(best, "url_", "left")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))

"""URL filter: host rules first, then a weighted vocabulary counted by Aho-Corasick.

A term counts where the characters beside it are neither ASCII letters nor
digits.  Each term has a weight; a strict term's weight is the limit itself.  A
url is blocked if the weights of the distinct terms found add up to the limit:
one strict term, or several distinct soft ones.  Longest-match host rules (allow
or block) decide before the vocabulary does.

Null and empty urls, and urls without ``://``, have empty host and path and match
no rule; the vocabulary still judges the text there is.  Rows are judged one by
one: ties, repeated rows and further columns don't matter.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = ("adult", "casino", "porn", "xxx", "viagra", "escort", "jackpot", "malware", "phishing", "warez", "spam")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "cialis", "dating", "discount", "farm", "free", "hot", "loan",
        "lottery", "pills", "poker", "prize", "slots", "track", "win", "winner")
#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
ALNUM = set(string.ascii_lowercase + string.digits)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    A plain expression over the rules: meant for up to some hundreds of them.
    """
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    if not fits:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.filter(F.array(*fits), lambda x: x.isNotNull()))


def vocabulary_hits(url: Column, strict=STRICT, soft=SOFT) -> Column:
    """Struct of the distinct strict and soft terms found in the url, sorted."""

    @F.pandas_udf("strict array<string>, soft array<string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for t in terms:
                machine.add_word(t.lower(), (kind, t.lower()))
        if len(machine):
            machine.make_automaton()
        lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

        def found(u: str | None) -> tuple[list[str], list[str]]:
            hits: dict[str, set[str]] = {"strict": set(), "soft": set()}
            if u and len(machine):
                u = u.translate(lower)
                for end, (kind, t) in machine.iter(u):
                    start = end - len(t)
                    if (start < 0 or u[start] not in ALNUM) and (end + 1 == len(u) or u[end + 1] not in ALNUM):
                        hits[kind].add(t)
            return sorted(hits["strict"]), sorted(hits["soft"])

        for batch in batches:
            yield pd.DataFrame([found(u) for u in batch], columns=["strict", "soft"])

    return scan(url)


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT,
                soft=SOFT, soft_weights: dict[str, float] | None = None, limit: float = 2.0) -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the strict and soft terms found."""
    weights = {t: 1.0 for t in soft} | (soft_weights or {})
    weight = F.lit(0.0)
    for t in soft:
        weight = weight + F.when(F.array_contains("v.soft", t.lower()), weights[t]).otherwise(0.0)
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                        vocabulary_hits(F.col(url_col), strict, soft).alias("v"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    bad = (F.size("v.strict") > 0) | (weight >= limit)
    return rows.select(id_col, "host", "path", F.col("r.rule").alias("rule"),
                       F.coalesce("r.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                       F.size("v.strict").cast("long").alias("n_strict"), F.size("v.soft").cast("long").alias("n_soft"),
                       F.array_join("v.strict", " ").alias("strict_terms"), F.array_join("v.soft", " ").alias("soft_terms"))

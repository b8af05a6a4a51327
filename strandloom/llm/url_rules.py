"""URL filters: host/path rules, then wildcard rules indexed by their rarest literal token.

All of it is row-wise DataFrame work: one pass over the URLs, no shuffle of the table. The rule
index is a constant of the plan, so a rule list is bounded (``MAX_RULES``); it does not grow with
the data.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, let, table

MAX_RULES = 100_000

#: (verdict, host, path): a rule fits its host and all subdomains below the path; the longest wins.
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: Wildcard rules: ``*`` any text, ``^`` a separator or an end, ``||`` a host or subdomain start,
#: ``@@`` in front an exception, which beats blocking rules.
PATTERN_RULES = [
    "^casino^",
    "^bets^",
    "^pills^",
    "^viagra^",
    "^xxx^",
    "^porn^",
    "^jackpot^",
    "^poker^*^bonus^",
    "||ads.*^banner^",
    "^doubleclick^",
    "@@||responsible.gambling.*",
]

_ALNUM = "a-z0-9"


def rule_regex(rule: str) -> str:
    """Regular expression of a wildcard rule, in syntax that Java and RE2 share; for lower-case URLs."""
    body, out = rule, ""
    if body.startswith("||"):
        out, body = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*[.])?", body[2:]
    for ch in body:
        if ch == "*":
            out += ".*"
        elif ch == "^":
            out += f"(?:[^{_ALNUM}]|^|$)"
        else:
            out += ch if re.fullmatch(f"[{_ALNUM}]", ch) else "[" + ("\\" if ch in "\\]^" else "") + ch + "]"
    return out


def rule_tokens(rule: str) -> list[str]:
    """Literal tokens that every URL matching the rule has as whole tokens."""
    body = rule.removeprefix("||")
    found = []
    for m in re.finditer(f"[{_ALNUM}]+", body):
        before = body[m.start() - 1] if m.start() else ("" if not rule.startswith("||") else "|")
        after = body[m.end()] if m.end() < len(body) else ""
        if before not in ("", "*") and after not in ("", "*"):
            found.append(m.group())
    return found


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(ascii_lower(F.coalesce(url, F.lit(""))), f"[^{_ALNUM}]+"), ""))


def token_counts(df: DataFrame, url: str, tokens: set[str]) -> dict[str, int]:
    """How many URLs have each rule token: at most one row per token of the rules reaches the driver."""
    if not tokens:
        return {}
    spark = df.sparkSession
    known = spark.createDataFrame([(t,) for t in sorted(tokens)], "token string")
    each = df.select(F.explode(url_tokens(F.col(url))).alias("token"))
    if len(tokens) <= 1000:
        each = each.filter(F.col("token").isin(sorted(tokens)))
    else:
        each = each.join(F.broadcast(known), "token", "left_semi")
    return {r["token"]: r["n"] for r in each.groupBy("token").agg(F.count("*").alias("n")).collect()}


def _shelves(entries: dict[str, list]) -> list[dict]:
    """Hash buckets of ``key -> entries``."""
    width = 1 << max(4, (max(len(entries), 1) - 1).bit_length())
    buckets: list[dict] = [{} for _ in range(width)]
    for key, rules in entries.items():
        buckets[zlib.crc32(key.encode()) % width][key] = rules
    return buckets


def _fetcher(buckets: list[dict], entry: str):
    """Column function: the entries of a key, from a constant of the plan."""
    shelf = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,array<{entry}>>>")

    def fetch(key):
        slot = (F.crc32(F.encode(key, "UTF-8")) % len(buckets) + 1).cast("int")
        return F.coalesce(F.try_element_at(F.element_at(shelf, slot), key), F.array().cast(f"array<{entry}>"))

    return fetch


def build_index(rules: list[str], counts: dict[str, int]) -> tuple[list[dict], list[dict]]:
    """Hash buckets of ``token -> rules``, each rule under its rarest token; rules without any token apart."""
    by_token: dict[str, list] = {}
    loose = []
    for text in rules:
        body = text.removeprefix("@@")
        entry = {"allow": text.startswith("@@"), "pattern": rule_regex(body)}
        tokens = rule_tokens(body)
        if tokens:
            by_token.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(entry)
        else:
            loose.append(entry)
    return _shelves(by_token), loose


def pattern_verdict(url: Column, index: tuple[list[dict], list[dict]]) -> Column:
    """'allow' or 'block' by wildcard rules; only rules fetched by a token of the URL run their expression."""
    buckets, loose = index
    entry = "struct<allow:boolean,pattern:string>"
    always = F.from_json(F.lit(json.dumps(loose)), f"array<{entry}>")
    low = ascii_lower(F.coalesce(url, F.lit("")))
    found = F.concat(F.flatten(F.transform(url_tokens(url), _fetcher(buckets, entry))), always)
    hits = let(
        F.struct(low.alias("u"), found.alias("c")),
        lambda v: F.filter(v["c"], lambda r: F.rlike(v["u"], r["pattern"])),
    )
    return let(
        hits,
        lambda h: F.when(F.exists(h, lambda r: r["allow"]), "allow").when(F.size(h) > 0, "block").otherwise("allow"),
    )


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_rule(host: Column, path: Column, rules=HOST_RULES) -> Column:
    """The longest fitting host/path rule: struct of name and verdict; null if none fits.

    The host's own suffixes fetch the rules, so a long list costs no more than a short one. Of rules of
    the same length the one with the longer host wins, of equal rules the allowing one.
    """
    by_host: dict[str, list] = {}
    for action, at, below in rules:
        by_host.setdefault(at, []).append({"size": len(at + below), "host": len(at), "allow": action == "allow", "name": at + below, "path": below, "verdict": action})
    fetch = _fetcher(_shelves(by_host), "struct<size:int,host:int,allow:boolean,name:string,path:string,verdict:string>")
    suffixes = let(F.split(host, "[.]"), lambda p: F.transform(p, lambda _, i: F.array_join(F.slice(p, i + 1, F.size(p)), ".")))
    fits = F.filter(F.flatten(F.transform(suffixes, fetch)), lambda r: path.startswith(r["path"]))
    return let(F.array_max(fits), lambda r: F.when(r.isNotNull(), F.struct(r["name"].alias("name"), r["verdict"].alias("verdict"))))


def judge_urls(df: DataFrame, url: str = "url", host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict`` of each row's URL.

    Host/path rules come first; where none fits, the wildcard rules decide, and 'allow' is the default.
    Every row is kept, repeated rows too. Null, empty and malformed URLs have empty host and path, no
    rule, and what the wildcard rules say of their text (null: of the empty text). Columns of ``df``
    that have the name of a result column are kept under the name with an underscore in front.
    """
    if len(host_rules) + len(pattern_rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    tokens = {t for r in pattern_rules for t in rule_tokens(r.removeprefix("@@"))}
    index = build_index(pattern_rules, token_counts(df, url, tokens))
    kept = df
    for name in ("host", "path", "rule", "verdict"):
        if clash := [c for c in df.columns if c.lower() == name and c != url]:
            kept = kept.withColumnRenamed(clash[0], free_name(kept, name))
    host, path = host_and_path(F.col(url))
    kept = kept.withColumns({"host": host, "path": path})
    best = free_name(kept, "_best")
    kept = kept.withColumn(best, host_rule(F.col("host"), F.col("path"), host_rules))
    return kept.withColumns({"rule": F.col(best)["name"], "verdict": F.coalesce(F.col(best)["verdict"], pattern_verdict(F.col(url), index))}).drop(best)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


#: Written by hand from the rules' meaning, not by ``rule_regex``.
ORACLE_SQL = r"""
WITH r AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
h AS (SELECT *, '.' || host AS dotted FROM p),
n AS (SELECT *, CASE
    WHEN ends_with(dotted, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with(dotted, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with(dotted, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with(dotted, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
    regexp_split_to_array(low, '[^a-z0-9]+') AS tokens FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(low, '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?responsible\.gambling\.') THEN 'allow'
    WHEN list_has_any(tokens, ['casino', 'bets', 'pills', 'viagra', 'xxx', 'porn', 'jackpot', 'doubleclick']) THEN 'block'
    WHEN regexp_matches(low, '(^|[^a-z0-9])poker[^a-z0-9](.*[^a-z0-9])?bonus([^a-z0-9]|$)') THEN 'block'
    WHEN regexp_matches(low, '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?ads\.(.*[^a-z0-9])?banner([^a-z0-9]|$)') THEN 'block'
    ELSE 'allow' END AS verdict FROM n"""

"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a wildcard pattern over the lower-cased url: `*` stands for any characters, `^` for a separator (anything but letters,
digits, `_ - . %`) or the url's end, `||` at the start for the beginning of the host or of one of its parent domains, `|` at
either end for the url's start or end.  A literal token is a maximal run of a-z and 0-9 in the pattern that every url the
rule matches holds as a whole token: neither a wildcard nor an open end touches it.  Of these the rule is filed under the one
that occurs in the fewest urls.  A url fetches the rules filed under its tokens, and only those run their regular expressions.
Rules without such a token are tried on every url.

Host rules (host, path) come first: a rule fits its host and all subdomains where the url's path starts with its path; the longest
one decides.  Where none fits, an allowing pattern rule that matches lets the url pass, else a blocking one stops it, else it passes.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Verdict, host, path.
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str


#: Rules used where none are given: hosts and paths of spam, gambling, adult and tracking pages.
PATTERNS = [
    Rule("block", "||spam-farm.*^"),
    Rule("block", "||*cheap-pills."),
    Rule("block", ".casino."), Rule("block", "-casino-"), Rule("block", "||casino."), Rule("block", "/casino/"),
    Rule("block", "/poker/"), Rule("block", "-porn-"), Rule("block", ".porn."), Rule("block", "/porn/"), Rule("block", "||porn."), Rule("block", "||*.xxx^"),
    Rule("block", "/viagra^"), Rule("block", "-viagra-"), Rule("block", "/replica-watches^"), Rule("block", "/payday-loans^"),
    Rule("block", "/wp-login.php"), Rule("block", "/phpmyadmin/"), Rule("block", "&sessionid="), Rule("block", "?sessionid="),
    Rule("block", "/cgi-bin/*&print=1|"), Rule("block", ".exe|"), Rule("block", ".apk|"), Rule("block", "/ads/*/click^"), Rule("block", "/trackback/"),
    Rule("allow", "||archive.example.org^"), Rule("allow", "/license.html|"),
]

SEPARATOR = "[^a-z0-9_.%-]"
FOLD = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def to_regex(pattern: str) -> str:
    """The pattern as a regular expression to be found anywhere in a lower-cased url (valid in Java and RE2)."""
    body = pattern.lower()
    start = end = ""
    if body.startswith("||"):
        start, body = "^[a-z0-9+.-]*://([^/?#]*[.])?", body[2:]
    elif body.startswith("|"):
        start, body = "^", body[1:]
    if body.endswith("|"):
        end, body = "\\z", body[:-1]
    parts = {"*": ".*", "^": f"({SEPARATOR}|\\z)"}
    return "(?s)" + start + "".join(parts.get(c) or ("\\" + c if c in string.punctuation else c) for c in body) + end


def whole_tokens(pattern: str) -> list[str]:
    """Literal tokens that every url matching the pattern holds as whole tokens."""
    body = pattern.lower()
    anchored_start, anchored_end = body.startswith("|"), body.endswith("|") and not body.startswith("||") or len(body) > 2 and body.endswith("|")
    inner = body[2:] if body.startswith("||") else body[1:] if body.startswith("|") else body
    inner = inner[:-1] if anchored_end and inner.endswith("|") else inner
    found = []
    for m in re.finditer("[a-z0-9]+", inner):
        before = inner[m.start() - 1] if m.start() else "/" if anchored_start else "*"
        after = inner[m.end()] if m.end() < len(inner) else "/" if anchored_end else "*"
        if "*" not in (before, after):
            found.append(m[0])
    return sorted(set(found))


def lowered(url: Column) -> Column:
    return F.translate(url, *FOLD)


def host_of(url: Column) -> Column:
    """From behind the first :// up to / ? # or the end, A-Z lower-cased; empty for null and for urls without ://."""
    return F.coalesce(lowered(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_host_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one; equally long ones by the order of the list."""
    rule = verdict = None
    for kind, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start) if rule is None else rule.when(fits, name + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url: maximal runs of a-z, 0-9 after lower-casing A-Z."""
    return F.array_distinct(F.filter(F.split(lowered(url), "[^a-z0-9]+"), lambda t: t != ""))


def matches(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(url, pattern, kind) of all rules that match, for a table of distinct non-null urls with the column `url`.

    The counts of tokens are taken over all urls, but only of tokens that rules hold, so that the shuffle holds a row for each of
    those and map task.  The rules are a parameter and travel as a literal table; Spark joins by measured size.
    """
    spark = urls.sparkSession
    listed = [(k, r.pattern, r.verdict, to_regex(r.pattern), whole_tokens(r.pattern)) for k, r in enumerate(rules)]
    table = spark.createDataFrame(listed, "rule_id int, pattern string, kind string, regex string, literals array<string>")
    literals = table.select("rule_id", F.explode("literals").alias("token"))
    own = urls.select("url", F.explode(tokens_of(F.col("url"))).alias("token")).join(literals.select("token").distinct(), "token")
    seen = own.groupBy("token").agg(F.count("*").alias("n_urls"))
    # The rarest literal of each rule: the least (count, token).
    rarest = literals.join(seen, "token", "left").groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n_urls", F.lit(0)).alias("n_urls"), "token")).alias("rarest"))
    filed = table.join(rarest.select("rule_id", F.col("rarest.token").alias("token")), "rule_id")
    fetched = own.join(filed.select("token", "pattern", "kind", "regex"), "token")
    hits = fetched.where(F.expr("regexp_like(translate(url, '%s', '%s'), regex)" % FOLD)).select("url", "pattern", "kind")
    for _, pattern, kind, regex, tokens in listed:
        if not tokens:
            hits = hits.unionByName(urls.where(lowered(F.col("url")).rlike(regex)).select("url", F.lit(pattern).alias("pattern"), F.lit(kind).alias("kind")))
    return hits


def judge(pages: DataFrame, rules: Sequence[Rule] = tuple(PATTERNS), host_rules: Sequence[tuple[str, str, str]] = tuple(HOST_RULES), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, patterns of every row.

    rule is the host rule that decides, null where none fits; patterns are the sorted pattern rules that match, looked for only
    where no host rule decides (else empty).  Null urls have empty host, path and patterns and pass.  Repeated and null ids are rows of
    their own; equal urls are judged once, so a very common one costs one row.  Very long urls are judged whole.  Ties
    among host rules cannot change a verdict here: equally long ones that fit the same url are equal, or the first listed wins.
    Other columns are ignored; an empty table or an empty list of rules is fine.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_of(url), path_of(url)
    rule, verdict = longest_host_rule(F.col("host"), F.col("path"), host_rules)
    rows = rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "decided": verdict})
    empty = F.array().cast("array<string>")
    if not rules:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("decided", F.lit("allow")).alias("verdict"), empty.alias("patterns"))
    open_urls = rows.where(F.col("decided").isNull() & F.col("url").isNotNull()).select("url").distinct()
    found = matches(open_urls, rules).groupBy("url").agg(
        F.array_sort(F.collect_set("pattern")).alias("patterns"),
        F.min(F.when(F.col("kind") == "allow", 0).otherwise(1)).alias("stops"),
    )
    judged = rows.join(found.withColumnRenamed("url", "matched"), F.col("url") == F.col("matched"), "left")
    by_pattern = F.when(F.col("stops") == 1, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("decided", by_pattern).alias("verdict"),
        F.when(F.col("decided").isNull(), F.coalesce("patterns", empty)).otherwise(empty).alias("patterns"),
    )


def oracle_sql(rules: Sequence[Rule] = tuple(PATTERNS), host_rules: Sequence[tuple[str, str, str]] = tuple(HOST_RULES)) -> str:
    """The same judgement as SQL that tries every rule on every page, without tokens."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    longest = sorted(host_rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda name, start: f"(host = {text(name)} or ends_with(host, {text('.' + name)})) and starts_with(path, {text(start)})"
    rule = "case " + " ".join(f"when {fits(n, p)} then {text(n + p)}" for _, n, p in longest) + " end"
    decided = "case " + " ".join(f"when {fits(n, p)} then {text(k)}" for k, n, p in longest) + " end"
    tried = ", ".join(f"case when regexp_matches(low, {text(to_regex(r.pattern))}) then {text(r.pattern)} end" for r in sorted(rules, key=lambda r: r.pattern))
    allowed = ", ".join(text(r.pattern) for r in rules if r.verdict == "allow")
    fold = f"translate({{}}, '{FOLD[0]}', '{FOLD[1]}')"
    return f"""
with cut as (
  select page_id, coalesce({fold.format("url")}, '') as low,
         coalesce({fold.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
ruled as (select page_id, low, host, path, {rule} as rule, {decided} as decided from cut),
matched as (
  select *, case when decided is null then [x for x in [{tried}] if x is not null] else []::varchar[] end as patterns from ruled)
select page_id, host, path, rule,
       coalesce(decided, case when len(patterns) > 0 and not list_has_any(patterns, [{allowed}]) then 'block' else 'allow' end) as verdict,
       array_to_string(patterns, ' ') as patterns
from matched"""

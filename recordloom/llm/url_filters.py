"""URL filters: pattern rules found by their rarest literal token; a URL meets only the rules that its tokens fetch.

A rule is a row (``kind``, ``pattern``, ``verdict``). A ``place`` rule is a host with a beginning of a path, such as
``example.net/en/``; it fits the host and all its subdomains. A ``glob`` rule is looked for anywhere in the lower-cased
URL: ``*`` is any text, ``^`` a separator or the end, ``|`` at an end of the rule is that end of the URL, ``||`` at its
beginning is the beginning of the host or of one of its domains.

Tokens are runs of ``a-z0-9``. A token of a rule that separators enclose is a whole token of every URL that the rule
fits, so any one of them can be the rule's key; the rarest one in the URLs at hand is chosen, and a rule without one has the
empty key that every URL fetches. Everything is DataFrame functions: where the index is proven small it is a literal of
buckets by hash of token and a URL looks its tokens up in place, without a shuffle; a larger index is joined by token.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.tables import written
from recordloom.operators.codelists import BROADCAST_CHARACTERS, BROADCAST_ROWS, fits_broadcast

RULE_SCHEMA = "kind: string, pattern: string, verdict: string"
_RULE = "array<array<struct<key: string, place: boolean, pattern: string, verdict: string, regex: string>>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; empty where there is none."""
    return lowered(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL, the empty one among them."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(lowered(F.coalesce(url, F.lit(""))), "[^a-z0-9]+")))


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def compiled(rules: DataFrame) -> DataFrame:
    """Distinct rules (``place``, ``pattern``, ``verdict``) with their ``regex`` and the ``tokens`` that can be their key.

    Rules with a null in any column, with an empty pattern, or of another kind or verdict are passed over. Of rules that
    differ in their verdict only, ``block`` counts.
    """
    known = rules.select(*[F.col(c).cast("string") for c in ("kind", "pattern", "verdict")]).where("kind IN ('place', 'glob') AND verdict IN ('allow', 'block') AND pattern <> ''")
    known = known.groupBy((F.col("kind") == "place").alias("place"), "pattern").agg(F.max("verdict").alias("verdict"))
    slash = F.instr("pattern", "/")
    host = lowered(F.when(slash > 0, F.expr("left(pattern, instr(pattern, '/') - 1)")).otherwise(F.col("pattern")))
    path = F.when(slash > 0, F.expr("substr(pattern, instr(pattern, '/'))")).otherwise("")
    place_regex = F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), _escaped(host), F.when(path == "", r"(?:/|\z)").otherwise(_escaped(path)))
    glob = lowered(F.col("pattern"))
    body = F.regexp_replace(glob, r"^\|{1,2}|\|$", "")
    body = F.regexp_replace(F.regexp_replace(_escaped(body), r"\\\*", ".*"), r"\\\^", r"(?:[^a-z0-9%]|\\z)")
    start = F.when(glob.startswith("||"), r"^[^/?#]*?://(?:[^/?#]*\.)?").when(glob.startswith("|"), "^").otherwise("")
    glob_regex = F.concat(F.lit("(?s)"), start, body, F.when(glob.rlike(r"[^|]\|$"), r"\z").otherwise(""))
    # enclosed by what is neither of a token nor a wildcard, so the token is whole wherever the rule fits
    enclosed = F.when(F.col("place"), F.concat(F.lit("."), lowered(F.concat(host, path)), F.when(path == "", "/").otherwise(""))).otherwise(glob)
    tokens = F.array_distinct(F.regexp_extract_all(enclosed, F.lit(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0)))
    return known.select("place", "pattern", "verdict", F.when(F.col("place"), place_regex).otherwise(glob_regex).alias("regex"), tokens.alias("tokens"))


def rule_index(rules: DataFrame, urls: DataFrame, url_column: str = "url") -> DataFrame:
    """The compiled rules with ``key``, of a rule's tokens the one in the fewest rows of ``urls`` (ties: the least); empty if it has none."""
    ready = written(compiled(rules), "url-rules")
    candidates = ready.select("place", "pattern", F.explode_outer("tokens").alias("token"))
    wanted = candidates.select("token").where("token IS NOT NULL").distinct()
    met = urls.select(F.explode(tokens_of(F.col(f"`{url_column}`").cast("string"))).alias("token"))
    counts = met.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rated = candidates.join(counts, "token", "left")
    keys = rated.groupBy("place", "pattern").agg(F.min(F.when(F.col("token").isNotNull(), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("least"))
    found = ready.join(keys, ["place", "pattern"]).select(F.coalesce("least.token", F.lit("")).alias("key"), "place", "pattern", "verdict", "regex")
    return written(found, "url-rules")  # it is read more than once, and counting tokens reads all URLs


def _fits(rule: Column, url: Column, target: Column) -> Column:
    return F.regexp_like(F.when(rule["place"], target).otherwise(url), rule["regex"])


def _rank(rule: Column) -> Column:
    """Greatest for the rule that decides: the longest place, then of globs an exception, then a block; of several the last in order of text."""
    return F.struct(
        rule["place"].alias("place"), F.when(rule["place"], F.length(rule["pattern"])).otherwise(F.when(rule["verdict"] == "allow", 1).otherwise(0)).alias("weight"),
        rule["pattern"].alias("pattern"), rule["verdict"].alias("verdict"),
    )


def _buckets(index: DataFrame) -> tuple[Column, int]:
    """The index as a literal: an array of buckets by hash of key. Only for one of proven size."""
    n = max(1, index.count())
    rows = index.select(F.pmod(F.xxhash64("key"), F.lit(n)).alias("at"), F.to_json(F.struct("key", "place", "pattern", "verdict", "regex")).alias("rule")).collect()
    held: list[list] = [[] for _ in range(n)]
    for row in sorted(rows):
        held[row["at"]].append(json.loads(row["rule"]))
    return F.from_json(F.lit(json.dumps(held)), F.lit(_RULE)), n


def judged(urls: DataFrame, index: DataFrame, url_column: str = "url", *, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``urls`` with ``best``, the rule that decides (place, weight, pattern, verdict), null where none fits.

    ``urls`` must not have columns named ``best``, ``__url`` or ``__target``.
    """
    text = F.coalesce(F.col(f"`{url_column}`").cast("string"), F.lit(""))
    if fits_broadcast(index, max_rows, BROADCAST_CHARACTERS):
        buckets, n = _buckets(index)
        fetched = F.flatten(F.transform(tokens_of(text), lambda t: F.filter(F.element_at(buckets, (F.pmod(F.xxhash64(t), F.lit(n)) + 1).cast("int")), lambda rule: rule["key"] == t)))
        url, target = lowered(text), F.concat(host_of(text), path_of(text))
        fitting = F.filter(fetched, lambda rule: _fits(rule, url, target))
        return urls.withColumn("best", F.array_max(F.transform(fitting, _rank)))
    once = urls.select(text.alias("__url")).distinct()
    met = once.select("__url", F.concat(host_of(F.col("__url")), path_of(F.col("__url"))).alias("__target"), F.explode(tokens_of(F.col("__url"))).alias("key")).join(index, "key")
    rule = F.struct("place", "pattern", "verdict", "regex")
    fitting = met.where(_fits(rule, lowered(F.col("__url")), F.col("__target"))).groupBy("__url").agg(F.max(_rank(rule)).alias("best"))
    return urls.withColumn("__url", text).join(fitting, "__url", "left").drop("__url")


def judge(pages: DataFrame, rules: DataFrame, *, id_column: str = "page_id", url_column: str = "url", default: str = "allow", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """For each row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``pattern``, ``verdict``.

    The longest place rule that fits decides and is named in ``rule``. Where none fits, an ``allow`` glob beats a
    ``block`` glob and the one that decides is named in ``pattern``; of several the last in order of text. Where nothing
    fits the verdict is ``default``. Host and path are empty where the URL is null or has no ``://``; globs still look
    at such a URL. Every row is judged for itself, so null and repeated ids and URLs, very long URLs and other columns
    of any name are no matter; an empty table gives an empty result, an empty rule table the default for all. Ports and
    user names are part of the host.
    """
    slim = pages.select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"))
    out = judged(slim, rule_index(rules, slim), max_rows=max_rows)
    return out.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.when(F.col("best.place"), F.col("best.pattern")).alias("rule"),
        F.when(~F.col("best.place"), F.col("best.pattern")).alias("pattern"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table of rules given as (kind, pattern, verdict)."""
    held = json.dumps([dict(zip(("kind", "pattern", "verdict"), rule)) for rule in rules])
    return spark.sql("SELECT inline(from_json(:rules, :type))", args={"rules": held, "type": f"array<struct<{RULE_SCHEMA}>>"})

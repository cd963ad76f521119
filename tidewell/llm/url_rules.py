"""URL filter by association rules, in DataFrame functions only.

Stated rules decide first (longest host and path wins). For the other urls Spark's FP-growth mines
combinations of url tokens that go with the verdict "block". A rule's confidence is the share of all
urls with its tokens that the stated rules block: urls without a verdict count against it, as the
stated rules can only ever label some urls (of a net host, say, only those they block), and among
labelled urls alone such a host's own name would look like a sure sign. Rules under the support,
confidence or lift asked for, and rules that a shorter rule with as much confidence covers, are pruned; no other rule is left out, however many or long they are. A rule is filed under its rarest
token, so a url meets only the rules filed under its own tokens and then checks the rest of each. The
index is a literal, or, if there are many rules, a table that is joined.

Edge cases. Null url, or one without "://": host and path are empty, no rule fits. Repeated rows
are judged each. Urls of any length are taken whole. If no labelled url is blocked nothing is mined, and urls without a rule are
allowed. Other columns are ignored. Numbers in paths are no tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, session

BLOCK = "=block"
#: Verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: So many rules are a literal; more are joined.
LITERAL = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"(?s)^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def decide(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as a string, and its verdict; null where none fits."""
    listed = F.array(*(F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules))
    fits = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    best = F.array_max(fits)
    return best["rule"], best["verdict"]


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: labels of the host by what they are, path words, extension, names of the query."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    own = F.transform(labels, lambda x: F.concat(F.lit("h:"), x))
    words = F.transform(F.filter(F.split(F.lower(path), r"[^\p{L}]+"), lambda x: F.length(x) > 1), lambda x: F.concat(F.lit("p:"), x))
    depth = F.array(F.concat(F.lit("d:"), F.size(F.split(path, "/")).cast("string")))
    names = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), F.lit(1)), lambda x: F.concat(F.lit("q:"), F.lower(x)))
    return F.array_distinct(F.concat(own, words, depth, names))


def mine(urls: DataFrame, support: float = 0.002, confidence: float = 0.8, lift: float = 1.0) -> DataFrame:
    """All rules (a: sorted tokens, c: confidence) for blocking, from rows (tokens, blocked: null without a verdict), but those that a rule with one token less and as much confidence covers."""
    from pyspark.ml.fpm import FPGrowth

    baskets = urls.select(F.concat("tokens", F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = model.associationRules.where(F.array_contains("consequent", BLOCK) & (F.col("lift") >= lift))
    rules = materialize(found.select(F.array_sort("antecedent").alias("a"), F.round("confidence", 12).alias("c")), "url_rules")
    less = rules.where(F.size("a") > 1).select("a", "c", F.explode(F.transform("a", lambda t: F.array_remove("a", t))).alias("part"))
    covered = less.join(rules.select(F.col("a").alias("part"), F.col("c").alias("sure")), "part").where("sure >= c").select("a").distinct()
    return materialize(rules.join(covered, "a", "left_anti"), "url_rules")


def shortest(rules: list[tuple[list[str], float]]) -> list[tuple[list[str], float]]:
    """The rules that no shorter one with as much confidence covers."""
    kept: list[tuple[list[str], float]] = []
    for own, c in sorted(rules, key=lambda r: (len(r[0]), -r[1], r[0])):
        if not any(set(a) <= set(own) and sure >= c for a, sure in kept):
            kept.append((own, c))
    return kept


def _listed(rules: list[tuple[list[str], float]]) -> Column:
    """The highest confidence of the rules that fit the column tokens, by an index in a literal: each rule under its rarest token."""
    counts: dict[str, int] = {}
    for a, _ in rules:
        for t in a:
            counts[t] = counts.get(t, 0) + 1
    index: dict[str, list] = {}
    for a, c in rules:
        index.setdefault(min(a, key=lambda t: (counts[t], t)), []).append((a, c))
    if not index:
        return F.lit(None).cast("double")
    struct = lambda a, c: F.struct(F.lit(c).alias("c"), F.array(*map(F.lit, a)).alias("all"))
    table = F.create_map(*(x for t, held in sorted(index.items()) for x in (F.lit(t), F.array(*(struct(a, c) for a, c in held)))))
    filed = F.flatten(F.array_compact(F.transform("tokens", lambda t: F.try_element_at(table, t))))
    return F.array_max(F.transform(F.filter(filed, lambda r: F.size(F.array_except(r["all"], F.col("tokens"))) == 0), lambda r: r["c"]))


def _joined(df: DataFrame, rules: DataFrame) -> DataFrame:
    """df with the same number in the column hit, by a join of distinct token lists with the index."""
    each = rules.select("a", "c", F.explode("a").alias("t"))
    counts = each.groupBy("t").agg(F.count("*").alias("n"))
    index = each.join(counts, "t").groupBy("a", "c").agg(F.min(F.struct("n", "t"))["t"].alias("t"))
    lists = df.where("_open").select("tokens").distinct()
    met = lists.select("tokens", F.explode("tokens").alias("t")).join(index, "t").where(F.size(F.array_except("a", "tokens")) == 0)
    return df.join(met.groupBy("tokens").agg(F.max("c").alias("hit")), "tokens", "left")


def with_hits(df: DataFrame, mined: DataFrame) -> DataFrame:
    """df (tokens, _open) with the column hit: for open rows the highest confidence of the mined rules that fit, else null."""
    few = mined.limit(LITERAL + 1).collect()
    return _joined(df, mined) if len(few) > LITERAL else df.withColumn("hit", _listed(shortest([(list(r.a), float(r.c)) for r in few])))


def held_out(pages: DataFrame, rules=RULES, support: float = 0.002, confidence: float = 0.8) -> dict[str, float]:
    """How well rules mined without a fifth of the urls (by the hash of the url) give back the stated verdicts there: precision, recall, the share of blocked urls among those with a verdict, and the share that mined rules block of those without.
    """
    host, path = parts(F.col("url"))
    df = pages.select("url", host.alias("host"), path.alias("path"))
    _, verdict = decide(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.crc32(F.coalesce("url", F.lit(""))), F.lit(5)) == 0
    df = df.select(fold.alias("held"), verdict.alias("_v"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), F.lit(True).alias("_open"))
    df = materialize(df, "urls")
    mined = mine(df.where("not held").select("tokens", (F.col("_v") == "block").alias("blocked")), support, confidence)
    hit, block, decided = F.col("hit").isNotNull(), F.col("_v") == "block", F.col("_v").isNotNull()
    n = with_hits(df.where("held"), mined).agg(*(F.count_if(x).alias(str(i)) for i, x in enumerate((hit & block, hit & decided, block, decided, hit & ~decided, ~decided)))).first()
    ratio = lambda a, b: a / b if b else 0.0
    return {"precision": ratio(n[0], n[1]), "recall": ratio(n[0], n[2]), "base": ratio(n[2], n[3]), "unlabelled": ratio(n[4], n[5])}


def judge(pages: DataFrame, rules=RULES, support: float = 0.002, confidence: float = 0.8) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence (of the mined rule that blocks; else null)."""
    session(pages.sparkSession)
    host, path = parts(F.col("url"))
    df = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    df = df.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_v"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    mined = mine(df.select("tokens", (F.col("_v") == "block").alias("blocked")), support, confidence)
    df = with_hits(df.withColumn("_open", F.col("_v").isNull()), mined).drop("_open")
    hit = F.col("hit")
    df = df.withColumn("confidence", F.when(F.col("_v").isNull(), hit))
    own = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return df.select("page_id", "host", "path", "rule", F.coalesce("_v", own).alias("verdict"), "confidence")

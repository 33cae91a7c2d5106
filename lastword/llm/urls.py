"""URL verdicts: a list of host and path rules first, mined association rules for all other urls.

FP-growth mines combinations of url tokens from labelled pages: a page is labelled by the document
whose id is the last number of its url's path, bad if its quality is 0 or it is toxic. Combinations
that predict bad with enough support and confidence (its lower bound, so that chance makes no rule),
and better than each of their parts, become block rules. A rule is looked up by its rarest token and checked against all tokens of the url.

Edge cases: a null url, or one without ://, has empty host and path, no tokens, and is allowed;
repeated rows get equal verdicts; null page ids stay null; without labels of both kinds there are no
mined rules; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lastword.llm import frames

# The listed rules, as (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.5
DEVIATIONS = 3.0  # confidence counts at its Wilson lower bound, so that rare chances make no rules
BAD = "=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    name = verdict = None
    for where, start, says in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == where) | F.endswith(host, F.lit("." + where))) & F.startswith(path, F.lit(start))
        rule = F.lit(where + start)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct parts of a url, each with the kind of its place; numbers are one token."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    anchor = F.regexp_extract(url, "#(.*)", 1)

    def of(kind: str, text: Column, cut: str) -> Column:
        plain = F.transform(F.split(F.lower(text), cut),
                            lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "0")))
        return F.filter(plain, lambda x: F.length(x) > len(kind))

    scheme = F.regexp_extract(url, "^([a-zA-Z]+)://", 1)
    every = F.concat(of("s:", scheme, "/"), of("h:", host, r"\."), of("p:", path, r"[/._-]+"),
                     of("q:", query, "[&;]"), of("f:", anchor, "[/&]"))
    return F.array_sort(F.array_distinct(F.coalesce(every, F.array().cast("array<string>"))))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Tokens of every page whose document has a label, with BAD among them if it is bad."""
    _, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"([0-9]{1,18})[^0-9]*$", 1)
    marked = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_doc"))
              .agg(((F.coalesce(F.min("quality"), F.lit(1)) == 0)
                    | (F.coalesce(F.max("toxic"), F.lit(0)) == 1)).alias("_bad")))
    return (pages.select(tokens(F.col("url")).alias("tokens"),
                         F.when(number != "", number.cast("long")).alias("_doc"))
            .where(F.size("tokens") > 0).join(marked, "_doc")
            .select(F.when(F.col("_bad"), F.array_append("tokens", F.lit(BAD)))
                    .otherwise(F.col("tokens")).alias("items")))


def lower_bound(share: Column, n: Column, z: float = DEVIATIONS) -> Column:
    """Wilson's lower bound of a share seen in n cases."""
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def mine(examples: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, tokens, index (the rarest token), confidence, support of the kept block rules."""
    spark = examples.sparkSession
    empty = "rule_id bigint, tokens array<string>, index string, confidence double, support double"
    if examples.isEmpty():
        return spark.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(examples)
    total = examples.count()
    rules = (model.associationRules.where(F.array_contains("consequent", BAD))
             .where(lower_bound(F.col("confidence"), F.col("support") * total / F.col("confidence")) >= min_confidence)
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
             .withColumn("rule_id", F.xxhash64("tokens")))
    rules = frames.written(rules, "url-rules")
    # A rule goes if one of its parts predicts as well: parts are found by their own rarest token.
    single = (model.freqItemsets.where(F.size("items") == 1)
              .select(F.col("items")[0].alias("token"), "freq"))
    exploded = rules.select("rule_id", F.explode("tokens").alias("token")).join(single, "token")
    index = exploded.groupBy("rule_id").agg(F.min(F.struct("freq", "token"))["token"].alias("index"))
    rules = rules.join(index, "rule_id")
    parts = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("_c"),
                         F.col("index").alias("token"))
    worse = (rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
             .join(parts, "token")
             .where((F.size("part") < F.size("tokens")) & (F.col("_c") >= F.col("confidence"))
                    & (F.size(F.array_except("part", "tokens")) == 0))
             .select("rule_id").distinct())
    return frames.written(rules.join(worse, "rule_id", "left_anti")
                          .select("rule_id", "tokens", "index", "confidence", "support"), "url-kept")


def blocked(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Of distinct token sets those that hold all tokens of a rule, with the surest such rule."""
    best = Window.partitionBy("tokens").orderBy(F.desc("confidence"), "rule_id")
    hits = (sets.select("tokens", F.explode("tokens").alias("index"))
            .join(rules.withColumnRenamed("tokens", "rule"), "index")
            .where(F.size(F.array_except("rule", "tokens")) == 0)
            .select("tokens", "rule", "confidence", "rule_id"))
    return (hits.withColumn("_n", F.row_number().over(best)).where("_n = 1")
            .select("tokens", F.array_join("rule", " ").alias("mined_rule"), "confidence"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict; and the mined rule that blocks it, if one does."""
    host, path = host_and_path(F.col("url"))
    rule, says = listed(F.col("host"), F.col("path"))
    parsed = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"))
              .withColumn("rule", rule).withColumn("_listed", says)
              .withColumn("tokens", F.when(F.col("rule").isNull(), tokens(F.col("url")))))
    rules = mine(labelled(pages, labels))
    sets = parsed.where("tokens IS NOT NULL").select("tokens").distinct()
    return (parsed.join(blocked(sets, rules), "tokens", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("_listed", F.when(F.col("mined_rule").isNotNull(), F.lit("block"))
                               .otherwise(F.lit("allow"))).alias("verdict"), "mined_rule"))


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return judge(frames.table(spark, folder, "pages"), frames.table(spark, folder, "labels"))

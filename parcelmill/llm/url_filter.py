"""URL filter: allow and block rules, and a character language-model ratio for the URLs that no rule fits.

The URLs that rules accept and those that they reject train one Markov model each over 42 character classes. A model is of
variable order: the chance of a character after its two predecessors is interpolated (Witten-Bell) with that after one and
after none, the less a context was seen. The score of a URL is the mean log-likelihood ratio of its characters, accepted against
rejected. The threshold is the score that parts the URLs of the two kinds best.

All of it is DataFrame operations. A model has 42**3 entries whatever the input, so it is one array that goes to
every task; scoring is a projection, without join or shuffle, and training an aggregate that is combined before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelmill.llm.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "0123456789" + "/.-_?"  # all other characters are class 0, which also stands before the start
K = len(ALPHABET) + 1
BIN = 0.01  # of scores, for the threshold


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without `://`."""
    at = F.locate("://", url) if isinstance(url, str) else F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. Rules are (verdict, host/path)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later ones, which are longer, come outermost
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def grams(url: Column) -> Column:
    """For every character of the URL after `://`, lower-cased, the number of it and its two predecessors."""
    text = F.lower(F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(url), F.lit("")))
    classes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    behind = lambda n: F.slice(F.concat(F.array_repeat(F.lit(0), n), classes), F.lit(1), F.size(classes))
    return F.zip_with(F.zip_with(behind(2), behind(1), lambda x, y: x * K + y), classes, lambda xy, z: xy * K + z)


def train(labelled: DataFrame) -> DataFrame:
    """One row with the array `model`: for each of the K**3 grams the log-likelihood ratio of accepted to rejected URLs.

    labelled: (grams, verdict). A kind without URLs has the uniform model.
    """
    spark = labelled.sparkSession
    counts = labelled.select("verdict", F.explode("grams").alias("g")).groupBy("g").agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    table = stored(spark.range(K**3).select(F.col("id").cast("int").alias("g")).join(counts, "g", "left").fillna(0), "url-grams")

    def level(keys: DataFrame, order: int) -> DataFrame:
        """Counts c of the last `order` + 1 characters, n of their context, t of different characters after it."""
        key = F.pmod("g", F.lit(K ** (order + 1))).alias(f"k{order}")
        sums = keys.groupBy(key).agg(*[F.sum(v).alias(v) for v in ("allow", "block")])
        context = F.floor(F.col(f"k{order}") / K).alias("context")
        totals = sums.groupBy(context).agg(
            *[F.sum(v).alias(f"n_{v}{order}") for v in ("allow", "block")], *[F.count_if(F.col(v) > 0).alias(f"t_{v}{order}") for v in ("allow", "block")]
        )
        return sums.select(f"k{order}", context, F.col("allow").alias(f"c_allow{order}"), F.col("block").alias(f"c_block{order}")).join(totals, "context").drop("context")

    joined = table.select("g", *[F.pmod("g", F.lit(K ** (o + 1))).alias(f"k{o}") for o in range(3)])
    for order in range(3):
        joined = joined.join(level(table, order), f"k{order}")

    def chance(kind: str) -> Column:
        p = F.lit(1.0 / K)
        for order in range(3):
            c, n, t = (F.col(f"{x}_{kind}{order}") for x in "cnt")
            p = F.when(n > 0, (c + t * p) / (n + t)).otherwise(p)
        return p

    ratios = joined.select("g", (F.log(chance("allow")) - F.log(chance("block"))).alias("ratio"))
    return ratios.agg(F.transform(F.sort_array(F.collect_list(F.struct("g", "ratio"))), lambda x: x["ratio"]).alias("model"))


def score(grams: Column, model: Column) -> Column:
    """Mean ratio of the grams; 0 without any."""
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.element_at(model, g + 1))
    return F.when(F.size(grams) > 0, total / F.size(grams)).otherwise(0.0)


def threshold(scored: DataFrame) -> DataFrame:
    """One row with the `threshold` of least error, the mean of the shares of both kinds on the wrong side; of equals the least.

    scored: (score, verdict). Scores are counted in bins first, a few thousand whatever the input. 0 if a kind is missing.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    rows = bins.agg(F.sort_array(F.collect_list(F.struct("bin", "allow", "block"))).alias("bins"), F.sum("allow").alias("a"), F.sum("block").alias("b"))
    start = F.struct(F.lit(0.0).alias("below"), F.lit(0.0).alias("kept"), F.lit(2.0).alias("error"), F.lit(0.0).alias("at"))

    def step(s: Column, x: Column) -> Column:
        error = s["below"] / F.col("a") + 1 - s["kept"] / F.col("b")  # of a threshold at the lower end of this bin
        better = error < s["error"]
        return F.struct(
            (s["below"] + x["allow"]).alias("below"), (s["kept"] + x["block"]).alias("kept"),
            F.when(better, error).otherwise(s["error"]).alias("error"), F.when(better, x["bin"] * F.lit(BIN)).otherwise(s["at"]).alias("at"),
        )

    best = F.aggregate("bins", start, step, lambda s: s["at"])
    return rows.select(F.when((F.col("a") > 0) & (F.col("b") > 0), best).otherwise(0.0).alias("threshold"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """(row, host, path, rule, score, verdict) of every page: its columns, whatever their names, and the judgement of its URL.

    A rule decides where one fits, else the score: at least the threshold is allow. Null URLs have the score 0.
    """
    link = F.col(f"row.`{url}`")
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"))
    rows = rows.withColumns(dict(zip(("host", "path"), host_and_path(link))))
    rows = rows.withColumns(dict(zip(("rule", "ruled"), fitting_rule(F.col("host"), F.col("path"), rules))))
    narrow = rows.filter("ruled is not null").select(grams(link).alias("grams"), F.col("ruled").alias("verdict"))
    model = stored(train(narrow), "url-model")
    scored = narrow.withColumn("model", model.scalar()).select(score(F.col("grams"), F.col("model")).alias("score"), "verdict")
    limit = stored(threshold(scored), "url-threshold")
    out = rows.withColumn("grams", grams(link)).withColumn("model", model.scalar()).withColumn("limit", limit.scalar())
    out = out.withColumn("score", score(F.col("grams"), F.col("model")))
    method = F.when(F.col("score") >= F.col("limit"), F.lit("allow")).otherwise(F.lit("block"))
    return out.select("row", "host", "path", "rule", "score", F.coalesce("ruled", method).alias("verdict"))

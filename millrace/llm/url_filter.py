"""URL filter: host and path rules first, logistic regression on hashed character n-grams for the rest.

All of it is DataFrame expressions. The labelled table is small, so it is folded into one row (feature lists
per url, posting lists per bucket) and gradient descent is a fold over the rounds on that row. The weights are
an array of ``buckets`` doubles that reaches the scan as a scalar subquery; scoring a url is a fold over its
n-grams and shuffles nothing, so a host with a third of all pages is no different from the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 8192
ROUNDS, RATE, DECAY = 300, 60.0, 0.00005
GRAMS = (3, 5)
BLOCK_AT = 0.5

# (verdict, host, path start)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

BAD_WORDS = ("casino poker bets jackpot slots roulette pills viagra cheap-meds diet-pills adult xxx porn escort "
             "spam spam-mail ads adserver track tracker click-bait popup malware payday loans torrent warez crack "
             "free-money win-prize gambling betting lottery bingo blackjack sex nude camgirls hookup steroids "
             "pharmacy-discount replica-watches phishing keygen serial-key hacked coin-doubler get-rich").split()
GOOD_WORDS = ("library museum school college news weather garden recipes history science travel river music forum "
              "docs wiki council hospital football letters theatre bank poetry maps archive research journal "
              "gallery orchard railway harbour kitchen physics chemistry village market bakery cinema workshop "
              "teacher student children family mountain forest energy climate health courses language north south "
              "earth heather thread thatch anthem athletics smithy nation station about contact products article "
             "blog help shop cart account search category photos sports business technology essex sextant "
             "better alphabet spoken express training cooking reading building engineering nursing housing painting "
              "morning spring cycling walking learning").split()
TEMPLATES = ("https://{}.example.com/en/#", "http://www.{}.example.org/de/#.html", "https://m.{}.example.net/fr/#/",
             "http://blog.{}.example.com/es/#?page=2", "http://www.{}.example.net/en/#/", "https://m.{}.example.org/es/#",
             "https://{}.org/", "http://www.best-{}.info/index.php?id=#")
# The word in the path, on a host without it or with an innocent word (``@``).
PATH_TEMPLATES = ("https://www.portal.edu/{}/#", "http://shop.example.org/{}/", "https://example.org/a/#/{}.html",
                  "https://@.org/{}", "http://www.@.co.uk/new-{}/#", "https://@.example.net/pages/{}/index.html",
                  "http://static.@.io/#/online-{}-1", "https://{}.info/{}/#")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in small table ``(url, blocked)``: every word in every template, in host, path or both.

    Page numbers and innocent host words are chosen by hash. Both classes have the same shapes, so only words tell.
    """
    words = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(y).alias("blocked"))
                      for y, ws in ((1, BAD_WORDS), (0, GOOD_WORDS)) for w in ws])
    shapes = F.array(*[F.lit(t) for t in TEMPLATES + PATH_TEMPLATES])
    each = spark.range(1).select(F.explode(words).alias("w")).select("w.*", F.explode(shapes).alias("shape"))
    page = F.pmod(F.xxhash64("word", "shape"), F.lit(10_000)).cast("string")
    innocent = F.array(*[F.lit(w) for w in GOOD_WORDS])[
        F.pmod(F.xxhash64("shape", "word"), F.lit(len(GOOD_WORDS))).cast("int")]
    filled = F.replace(F.replace("shape", F.lit("{}"), F.col("word")), F.lit("@"), innocent)
    return each.select(F.replace(filled, F.lit("#"), page).alias("url"), "blocked")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A to Z lower-cased; empty if there is none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str, str]], part: int | None = None) -> Column:
    """The longest rule that fits host and path (``host + path start``), or its verdict with ``part=0``."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
        out = F.when(fits, F.lit(r[0] if part == 0 else r[1] + r[2])).otherwise(out)
    return out


def _grams(text: Column, tag: str) -> Column:
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        return F.when(F.length(marked) >= n, F.transform(
            F.sequence(F.lit(1), F.length(marked) - (n - 1)),
            lambda i: F.concat(F.lit(tag), F.substr(marked, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of_size(n) for n in range(GRAMS[0], GRAMS[1] + 1)])


def gram_buckets(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers (from 0) of the marked character n-grams of host and path, repeats included."""
    return F.transform(F.concat(_grams(host, "h"), _grams(path, "p")), lambda g: F.pmod(
        F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int"))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def train(labelled: DataFrame, buckets: int = BUCKETS, rounds: int = ROUNDS, rate: float = RATE,
          decay: float = DECAY) -> DataFrame:
    """One row with ``w``: ``buckets`` weights, then the bias. ``labelled(url, blocked)`` must be a small table.

    Rows without a label are left out; of an empty table all weights are zero.
    """
    rows = labelled.where(F.col("blocked").isNotNull()).select(
        F.col("blocked").cast("double").alias("y"), gram_buckets(host_of(F.col("url")), path_of(F.col("url")),
                                                                 buckets).alias("b"))
    rows = rows.select("y", F.concat("b", F.array(F.lit(buckets))).alias("b"))  # the last bucket is the bias
    rows = rows.select("y", "b", (F.lit(1.0) / F.sqrt(F.size("b").cast("double"))).alias("x"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct("b", "y", "x"))).alias("rows"))
    # Posting lists: for every bucket the numbers of the rows with it. Rows are few by contract.
    posts = one.select(F.posexplode("rows").alias("i", "r")).select(
        "i", F.explode("r.b").alias("bucket"), F.col("r.x").alias("x"))
    posts = posts.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("posts"))
    every = labelled.sparkSession.range(buckets + 1).select(F.col("id").cast("int").alias("bucket"))
    columns = every.join(posts, "bucket", "left").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("bucket", F.coalesce(
            "posts", F.array().cast("array<struct<i:int,x:double>>")).alias("posts")))), lambda p: p["posts"])
        .alias("posts"))
    base = one.select("rows", columns.scalar().alias("posts"))
    n = F.greatest(F.size("rows"), F.lit(1)).cast("double")
    rows_, posts_ = F.col("rows"), F.col("posts")

    def step(w: Column, _: Column) -> Column:
        wrong = F.transform(rows_, lambda r: F.lit(1.0) / (F.lit(1.0) + F.exp(-F.aggregate(
            r["b"], F.lit(0.0), lambda a, b: a + w[b]) * r["x"])) - r["y"])
        return _let(wrong, lambda e: F.zip_with(w, posts_, lambda v, ps: v * F.lit(1 - rate * decay) - F.aggregate(
            ps, F.lit(0.0), lambda a, p: a + p["x"] * e[p["i"]]) * F.lit(rate) / n))

    zeros = F.array_repeat(F.lit(0.0), buckets + 1)
    return base.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), zeros, step).alias("w"))


def blocked_score(host: Column, path: Column, w: Column, buckets: int = BUCKETS) -> Column:
    """Probability that the url is to be blocked."""
    b = F.concat(gram_buckets(host, path, buckets), F.array(F.lit(buckets)))
    z = _let(b, lambda ids: F.aggregate(ids, F.lit(0.0), lambda a, i: a + w[i]) / F.sqrt(F.size(ids).cast("double")))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=None, id_column: str = "page_id",
               buckets: int = BUCKETS, **options) -> DataFrame:
    """``pages(page_id, url)`` -> page_id, host, path, rule, verdict, score; one row per input row.

    The longest fitting rule decides (of rules equally long, the one whose text sorts last); where none fits, the
    model does (``block`` from 0.5). Null urls and urls without ``://`` have an empty host and path and are left to
    the model too. Urls of any length are read whole. Repeated rows are judged alike, each for itself; an empty
    table gives no rows. Other columns are not read.
    """
    rules = RULES if rules is None else rules
    model = train(labelled_urls(pages.sparkSession) if labelled is None else labelled, buckets, **options)
    split = pages.select(F.col(id_column), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                         model.scalar().alias("w"))
    ruled = split.select("*", rule_column(F.col("host"), F.col("path"), rules).alias("rule"),
                         rule_column(F.col("host"), F.col("path"), rules, 0).alias("ruled"),
                         F.round(blocked_score(F.col("host"), F.col("path"), F.col("w"), buckets), 6)
                         .alias("score"))
    by_model = F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")
    return ruled.select(id_column, "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")

"""URL filtering by pattern rules indexed by their rarest literal token.

A rule is a host and a path prefix (``*`` in the path stands for any run of
characters).  Its literal tokens are the labels of its host and the path
words that stand between separators on both sides.  Tokens are counted over
the urls themselves; each rule is filed under the rarest of its tokens, a
url's tokens fetch the rules filed under them, and only those rules' regular
expressions run on that url.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract, in its order.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT_VERDICT = "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        """Over ``host`` + newline + ``path``: the host or a subdomain of it,
        then the path prefix."""
        host = f"(?:[^\\n]*\\.)?{re.escape(self.host)}" if self.host else "[^\\n]*"
        return f"(?s)\\A{host}\\n" + ".*".join(re.escape(p) for p in self.path.split("*"))

    @property
    def tokens(self) -> list[str]:
        """Tokens that each fitting url is certain to have.  A word at the
        end of the prefix may go on in the url, so it is no token."""
        hosts = [f"h:{label}" for label in self.host.split(".") if label]
        words = re.findall(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", self.path)
        return hosts + [f"p:{w}" for w in words]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, with A-Z lower-cased; the path goes on up to ``?``,
    ``#`` or the end.  Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url; the empty token fetches rules without any."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    words = F.transform(F.split(path, r"[^A-Za-z0-9]+"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(F.array(F.lit("")), labels, words))


def rule_index(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(token, rule, verdict, regex, weight): each rule under its rarest
    token, counted over all of ``urls`` (columns host, path)."""
    spark = urls.sparkSession
    wanted = spark.createDataFrame(
        [(n, t) for n, r in enumerate(rules) for t in (r.tokens or [""])], "n int, token string")
    counts = (urls.select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
              .join(F.broadcast(wanted.select("token").distinct()), "token", "left_semi")
              .groupBy("token").count())
    rarest = (wanted.join(counts, "token", "left")
              .groupBy("n").agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token")))
    text = spark.createDataFrame([(n, r.text, r.verdict, r.regex, len(r.text)) for n, r in enumerate(rules)],
                                 "n int, rule string, verdict string, regex string, weight int")
    return text.join(rarest, "n").drop("n")


def judge_urls(pages: DataFrame, rules: list[Rule] | None = None, url_col: str = "url",
               default: str = DEFAULT_VERDICT, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages`` (default: all but clashing ones) and
    host, path, rule, verdict for every row.

    The longest fitting rule wins (ties: block before allow, then the rule's
    text).  A row that no rule fits, null urls among them, has a null rule
    and the default verdict.  Rows are judged one by one, so repeated rows
    and null ids are kept; an empty table gives an empty result.  The list of
    rules is a parameter of the call and so the size of its index is known;
    the index is shipped to each executor only while Spark's own broadcast
    limit allows it.
    """
    rules = [Rule(*r) for r in RULES] if rules is None else rules
    mine = {"host", "path", "rule", "verdict"}
    keep = [c for c in pages.columns if c not in mine] if keep is None else keep
    host, path = url_parts(F.col(url_col).cast("string"))
    urls = pages.select(F.struct(*keep).alias("_row"), host.alias("host"), path.alias("path"))
    index = rule_index(urls.select("host", "path"), rules)
    # One row per url and candidate; the id is made and folded again in the
    # same stage, so at most one row per url is shuffled.
    fetched = (urls.withColumn("_id", F.monotonically_increasing_id())
               .withColumn("token", F.explode(_tokens(F.col("host"), F.col("path"))))
               .join(index, "token", "left"))
    fits = F.rlike(F.concat("host", F.lit("\n"), "path"), F.col("regex"))
    best = F.max(F.when(fits, F.struct("weight", F.col("verdict").alias("v"), F.col("rule").alias("r"))))
    judged = fetched.groupBy("_id").agg(F.first("_row").alias("_row"), F.first("host").alias("host"),
                                        F.first("path").alias("path"), best.alias("best"))
    return judged.select("_row.*", "host", "path", F.col("best.r").alias("rule"),
                         F.coalesce("best.v", F.lit(default)).alias("verdict"))

"""URL filters: host and path rules, and gradient-boosted trees on lexical features where no rule fits.

Everything that touches the rows is a DataFrame expression: parsing, rules, features, and the trees, which become nested
CASE expressions. Trees are fitted on the driver on at most ``sample`` labelled URLs (those that a rule judges, or a table of
labelled URLs), which come there as numbers.

Features: length, path depth, digit ratio, entropy of the characters, number of parameters, fragment, hyphens, labels of the host,
longest path part, and the block rate of the host's last one and two labels among the labelled URLs (for the trees' own rows among those of other folds).

Defined results: a null url or one without ``://`` has empty host and path, no rule, and the verdict of its features; a null page_id keeps its row; repeated
rows are judged each; without labelled URLs of both kinds the base rate decides, allow if there are none; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import boosting
from palimpsest.llm.common import first_by_hash, own_columns, table

# The contract's rules.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Labelled URLs that the trees are fitted on at most, and suffixes with a rate of their own.
SAMPLE, SUFFIXES = 4000, 48
FOLDS = 4
NAMES = ("length", "depth", "digits", "entropy", "params", "fragment", "hyphens", "labels", "longest", "tld_rate", "domain_rate")
_COUNTED = len(NAMES) - 2


def parse(urls: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path`` to a table with ``url``."""
    mark = F.locate("://", F.coalesce("url", F.lit("")))
    rest = F.when(mark > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return urls.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def matched_rule(rules: Sequence[tuple[str, str]]) -> Column:
    """Number of the longest rule that fits, else null; of equally long ones the first."""
    out = None
    for i in sorted(range(len(rules)), key=lambda i: (-len(rules[i][1]), i)):
        host, slash, path = rules[i][1].partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.startswith(F.col("path"), F.lit(slash + path))
        out = F.when(fits, F.lit(i)) if out is None else out.when(fits, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def lexical_features(parsed: DataFrame) -> DataFrame:
    """Adds the features (all but the suffix rates) and the suffixes ``tld`` and ``domain``."""
    url = F.coalesce("url", F.lit(""))
    n = F.char_length(url)
    chars = F.split(url, "")
    share = lambda c: (n - F.char_length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - F.when(c == "", F.lit(0.0)).otherwise(share(c) * F.log2(share(c))))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    labels = F.split("host", r"\.")
    values = {
        "length": n,
        "depth": F.size(parts),
        "digits": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": entropy,
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "fragment": F.instr(url, "#") > 0,
        "hyphens": F.regexp_count(url, F.lit("-")),
        "labels": F.size(labels),
        "longest": F.coalesce(F.array_max(F.transform(parts, F.char_length)), F.lit(0)),
    }
    out = parsed.withColumns({k: v.cast("double") for k, v in values.items()})
    return out.withColumns({"tld": F.element_at(labels, -1), "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))})


def _rates(suffixes: list[str], y: np.ndarray) -> tuple[dict[str, float], float]:
    """Shrunk block rates of the most frequent suffixes, and the rate of all."""
    base = float((y.sum() + 1) / (len(y) + 2))
    seen, blocked = Counter(suffixes), Counter()
    for s, t in zip(suffixes, y.tolist(), strict=True):
        blocked[s] += t
    return {s: (blocked[s] + 5 * base) / (k + 5) for s, k in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:SUFFIXES]}, base


def left_out_rates(suffixes: list[str], y: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    """For each row the rate of its suffix among the rows of the other folds, so that no row's label is in its own features."""
    fold, out = np.arange(len(y)) % folds, np.zeros(len(y))
    for k in range(folds):
        rates, base = _rates([s for s, f in zip(suffixes, fold, strict=True) if f != k], y[fold != k])
        out[fold == k] = [rates.get(s, base) for s, f in zip(suffixes, fold, strict=True) if f == k]
    return out


class UrlModel:
    """Trees and suffix rates, as expressions over ``lexical_features``."""

    def __init__(self, rows: list[tuple], blocked: list[int]) -> None:
        """Trees are fitted on rates that leave a row's own fold out; URLs are judged with the rates of all rows."""
        y = np.array(blocked, float)
        suffixes = [[r[_COUNTED + i] or "" for r in rows] for i in range(2)]
        (self.tld, self.base), (self.domain, _) = (_rates(s, y) for s in suffixes)
        x = np.array([r[:_COUNTED] for r in rows], float).reshape(-1, _COUNTED)
        self.trees = boosting.fit(np.column_stack([x, *(left_out_rates(s, y) for s in suffixes)]), y, trees=24)
        if not len(y):
            self.trees.base = -1.0

    def _rate(self, column: str, rates: dict[str, float]) -> Column:
        if not rates:
            return F.lit(self.base)
        pairs = [F.lit(v) for kv in rates.items() for v in kv]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(self.base))

    def _node(self, t: boosting.Tree, i: int) -> Column:
        inner = len(t.feature)
        if i >= inner:
            return F.lit(t.leaf[i - inner])
        if t.feature[i] < 0:
            return self._node(t, 2 * i + 1)
        return F.when(F.col(NAMES[t.feature[i]]) > F.lit(t.cut[i]), self._node(t, 2 * i + 2)).otherwise(self._node(t, 2 * i + 1))

    def scored(self, features: DataFrame) -> DataFrame:
        """Adds ``block_score``, the probability of a block."""
        rows = features.withColumn("tld_rate", self._rate("tld", self.tld)).withColumn("domain_rate", self._rate("domain", self.domain))
        margin = F.lit(self.trees.base)
        for t in self.trees.trees:
            margin = margin + self._node(t, 0)
        return rows.withColumn("block_score", 1 / (1 + F.exp(-margin)))


def fit_urls(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """``labelled``: url and blocked (0 or 1). The first ``sample`` distinct URLs by hash are used."""
    rows = own_columns(labelled, "url", "blocked").where("url is not null and blocked is not null").groupBy("url").agg(F.max("blocked").alias("blocked"))
    # At most ``sample`` URLs are broadcast.
    rows = rows.join(F.broadcast(first_by_hash(rows, "url", sample)), "url")
    got = lexical_features(parse(rows)).orderBy(F.xxhash64("url"), "url").select(*NAMES[:_COUNTED], "tld", "domain", "blocked").collect()
    return UrlModel([tuple(r) for r in got], [int(r["blocked"]) for r in got])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``page_id, url, host, path, rule, block_score, verdict``; ``labelled`` replaces the rules' own verdicts as training rows."""
    rows = parse(own_columns(pages, "page_id", "url")).withColumn("fit", matched_rule(rules))
    blocks = [i for i, (verdict, _) in enumerate(rules) if verdict == "block"]
    if labelled is None:
        labelled = rows.where("fit is not null").select("url", F.col("fit").isin(blocks).cast("int").alias("blocked"))
    model = fit_urls(labelled, sample)
    names = F.array(*[F.lit(r) for _, r in rules]) if rules else F.array(F.lit(None).cast("string"))
    scored = model.scored(lexical_features(rows)).withColumn("rule", F.get(names, F.col("fit")))
    by_rule = F.when(F.col("fit").isin(blocks), "block").when(F.col("fit").isNotNull(), "allow")
    verdict = F.coalesce(by_rule, F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "url", "host", "path", "rule", "block_score", verdict.alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "block_score")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the filter SQL can tell: host, path and rule of all pages, and the verdict where a rule fits."""
    verdict = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    return op10_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", verdict.alias("verdict"))


URL_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
k AS (SELECT * FROM (VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')) AS v(rule, verdict)),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p, k
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
SELECT page_id, host, path, rule, verdict FROM p LEFT JOIN f USING (page_id)
"""

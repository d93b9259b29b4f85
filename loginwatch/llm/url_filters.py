"""URL verdicts: host and path rules, else a character language-model ratio. Built-in
functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loginwatch.llm.common import let, stored

#: Symbols of the models: letters, one digit, common marks; the rest is one symbol, and
#: one more stands before the start of a URL.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
MARKS = "/.-_?=&%:#~+@"
DIGIT, OTHER = len(LETTERS), len(LETTERS) + 1 + len(MARKS)
START = OTHER + 1
ALPHABET = START + 1
#: Characters of context at most, occurrences from which a context is trusted, and the
#: weight of the next shorter one.
ORDER = 3
MIN_CONTEXT = 4
BACKOFF = 2.0
#: Score bins of the calibration: bits per character from -RANGE to RANGE.
BINS, RANGE = 400, 8.0
#: A fifth of all URLs, by their digest.
HELD_OUT = "cast(conv(substring(md5(coalesce(url, '')), 1, 7), 16, 10) AS int) % 5 = 0"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``host`` (A-Z lower-cased) and ``path``; both empty for null or no ``://``."""
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(F.col("_rest"), "^[^/?#]*", 0)
    upper = LETTERS.upper()
    return (
        pages.drop("host", "path").withColumn("_rest", rest)
        .withColumn("path", F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1))
        .withColumn("host", F.translate(host, upper, LETTERS)).drop("_rest")
    )


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rule``: the longest that fits host and path, and its ``rule_verdict``; else null."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def symbols(url: Column) -> Column:
    """The symbols of a URL as numbers; upper and lower case count alike."""
    def number(c: Column) -> Column:
        at = F.instr(F.lit(LETTERS + "0" + MARKS), c)
        return F.when(at > 0, at - 1).otherwise(OTHER)
    folded = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "[0-9]", "0")
    return F.transform(F.filter(F.split(folded, ""), lambda c: c != ""), number)


def coded(url: Column) -> Column:
    """For every symbol of a URL the number of its longest context and itself, in base
    ``ALPHABET``."""
    def codes(s: Column) -> Column:
        def code(i: Column) -> Column:
            out = F.lit(0)
            for k in range(ORDER + 1):
                out = out * ALPHABET + F.get(s, i + k)
            return out
        n = F.size(s) - ORDER
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), code)).otherwise(F.array().cast("array<int>"))
    return let(F.concat(F.array_repeat(F.lit(START), ORDER), symbols(url)), codes)


def _counts(labelled: DataFrame) -> list[DataFrame]:
    """Per order: ``context``, its total, and dense arrays of counts by next symbol, for
    accepted and rejected URLs; contexts seen too rarely are left out."""
    longest = labelled.select("accepted", F.explode(coded(F.col("url"))).alias("code")).groupBy("code").agg(
        F.sum(F.expr("bigint(accepted)")).alias("good"), F.sum(F.expr("bigint(NOT accepted)")).alias("bad"),
    )
    longest = stored(longest, "url_grams")  # ALPHABET ** (ORDER + 1) rows at most
    out = []
    for order in range(ORDER + 1):
        cells = longest.withColumn("code", F.expr(f"code % {ALPHABET ** (order + 1)}")).groupBy("code").agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad")
        )
        by_context = cells.groupBy(F.expr(f"code div {ALPHABET}").alias("context")).agg(
            F.collect_list(F.struct(F.expr(f"code % {ALPHABET}").alias("symbol"), "good", "bad")).alias("cells"),
            F.sum(F.expr("good + bad")).alias("seen"),
        ).where(f"seen >= {MIN_CONTEXT if order else 0}")
        out.append(by_context.select("context", *[F.expr(f"""
            transform(sequence(0, {ALPHABET - 1}), s -> aggregate(
                filter(cells, x -> x.symbol = s), 0L, (a, x) -> a + x.{kind})) """).alias(kind) for kind in ("good", "bad")]))
    return out


def _interpolated(counts: str, shorter: str) -> str:
    total = f"aggregate({counts}, 0D, (a, x) -> a + x)"
    return f"zip_with({counts}, {shorter}, (n, p) -> (n + {BACKOFF}D * p) / ({total} + {BACKOFF}D))"


def model(labelled: DataFrame) -> DataFrame:
    """One row: ``places`` and ``gains``, the models as two arrays.

    ``labelled`` has ``url`` and ``accepted``. A model is learnt for the accepted and for
    the rejected URLs. Its order varies: the chance of a symbol after a context is
    interpolated with that after the next shorter one in proportion to what was seen
    (weight ``BACKOFF``), down to equal chances; contexts of fewer than ``MIN_CONTEXT``
    occurrences are left to the shorter one. ``gains`` holds, context by context, log2 of
    the chance among accepted over that among rejected URLs for each next symbol;
    ``places`` says for each possible longest context where its longest known suffix
    stands. Counts cover all labelled URLs and are combined before the shuffle; the
    arrays hold at most ``ALPHABET ** ORDER`` contexts, however many URLs there are.
    """
    orders, counts = [], _counts(labelled)
    equal = f"array_repeat(1D / {ALPHABET}, {ALPHABET})"
    for order, seen in enumerate(counts):
        if order == 0:
            base = labelled.sparkSession.range(1).select(F.lit(0).cast("long").alias("context"))
            zero = f"array_repeat(0L, {ALPHABET})"
            rows = base.join(seen, "context", "left").selectExpr(
                "context", f"coalesce(good, {zero}) AS good", f"coalesce(bad, {zero}) AS bad",
                f"{equal} AS good_p", f"{equal} AS bad_p",
            )
        else:
            parent = orders[-1].select(F.col("context").alias("parent"), "good_p", "bad_p")
            rows = seen.withColumn("parent", F.expr(f"context % {ALPHABET ** (order - 1)}")).join(parent, "parent")
        orders.append(stored(rows.selectExpr(
            "context", f"{_interpolated('good', 'good_p')} AS good_p", f"{_interpolated('bad', 'bad_p')} AS bad_p",
        ), f"url_order_{order}"))
    known = orders[0].select(F.lit(0).alias("order"), "*")
    for order in range(1, ORDER + 1):
        known = known.unionByName(orders[order].select(F.lit(order).alias("order"), "*"))
    known = known.select(
        "order", "context",
        F.expr("zip_with(good_p, bad_p, (g, b) -> log2(g) - log2(b))").alias("gain"),
        (F.row_number().over(Window.orderBy("order", "context")) - 1).alias("place"),
    )
    known = stored(known, "url_contexts")
    longest = labelled.sparkSession.range(ALPHABET ** ORDER).withColumnRenamed("id", "longest")
    for order in range(ORDER + 1):
        own = known.where(f"order = {order}").select(F.col("context").alias(f"c{order}"), F.col("place").alias(f"p{order}"))
        longest = longest.join(own, F.expr(f"longest % {ALPHABET ** order} = c{order}"), "left")
    suffix = F.coalesce(*[f"p{order}" for order in range(ORDER, -1, -1)])
    places = longest.agg(F.array_sort(F.collect_list(F.struct("longest", suffix.alias("place")))).alias("x"))
    gains = known.agg(F.array_sort(F.collect_list(F.struct("place", "gain"))).alias("x"))
    return places.select(
        F.expr("transform(x, r -> r.place)").alias("places"),
        gains.select(F.expr("flatten(transform(x, r -> r.gain))")).scalar().alias("gains"),
    )


def with_score(rows: DataFrame, learnt: DataFrame) -> DataFrame:
    """``score``: bits per character by which the accepted model explains a URL better; 0
    if it is empty."""
    def total(codes: Column) -> Column:
        def over(m: Column) -> Column:
            def gain(code: Column) -> Column:
                place = F.get(m["places"], F.floor(code / ALPHABET).cast("int"))
                return F.get(m["gains"], place * ALPHABET + code % ALPHABET)
            each = F.aggregate(codes, F.lit(0.0), lambda acc, code: acc + gain(code))
            return F.when(F.size(codes) > 0, each / F.size(codes)).otherwise(0.0)
        # Used once, so that the optimizer puts the subquery here and no row carries the model.
        return let(F.col("_model"), over)

    one = learnt.select(F.struct("places", "gains")).scalar()
    return rows.withColumn("_model", one).withColumn("score", let(coded(F.col("url")), total)).drop("_model")


def threshold(scored: DataFrame) -> DataFrame:
    """One row, ``cut``: the score that parts held-out accepted from rejected URLs best.

    The sum of both classes' shares on the right side is largest at it, over a fixed
    grid of scores; of equals the one nearest to 0. 0 if a class is missing.
    """
    at = F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor((F.col("score") + RANGE) * (BINS / (2 * RANGE))).cast("int")))
    bins = scored.groupBy(at.alias("bin")).agg(
        F.sum(F.expr("bigint(accepted)")).alias("good"), F.sum(F.expr("bigint(NOT accepted)")).alias("bad"),
    )
    lower = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    balance = bins.select(
        "bin", (1 - F.coalesce(F.sum("good").over(lower), F.lit(0)) / F.sum("good").over(every)
                + F.coalesce(F.sum("bad").over(lower), F.lit(0)) / F.sum("bad").over(every)).alias("sum"),
        (F.sum("good").over(every) > 0).alias("g"), (F.sum("bad").over(every) > 0).alias("b"),
    ).where("g AND b")
    edge = F.col("bin") * (2 * RANGE / BINS) - RANGE
    return balance.agg(F.max(F.struct("sum", (-F.abs(edge)).alias("near"), edge.alias("cut"))).alias("best")).select(
        F.coalesce("best.cut", F.lit(0.0)).alias("cut")
    )


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    A rule's verdict stands. URLs that fit one teach the models; a fifth of them, by the
    digest of the URL, is held out for the threshold. All other URLs are allowed when their
    score reaches it. A null URL counts as empty and scores 0. Nothing but counts is
    shuffled, and models reach the rows as two arrays of bounded size. Clashing columns
    are replaced.
    """
    rows = with_rule(with_host_and_path(pages.drop("rule", "score", "verdict", "rule_verdict")), rules)
    labelled = rows.where("rule_verdict IS NOT NULL").select(
        "url", (F.col("rule_verdict") == "allow").alias("accepted"), F.expr(HELD_OUT).alias("held_out"),
    )
    learnt = stored(model(labelled.where("NOT held_out")), "url_model")
    cut = stored(threshold(with_score(labelled.where("held_out"), learnt)), "url_threshold")
    return with_score(rows, learnt).withColumn(
        "verdict", F.coalesce("rule_verdict", F.when(F.col("score") >= cut.scalar(), "allow").otherwise("block"))
    ).drop("rule_verdict")


def url_verdicts(pages: DataFrame) -> DataFrame:
    """The result of the query; the pages' html is not read."""
    return judged(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")

"""Quality rules whose cutoffs are certified on labelled documents; built-in functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loginwatch.llm.common import WORD_BREAK, let, stored

#: Share of a stratum's good documents that all rules together may reject, and the chance
#: that the promise is broken in any stratum.
MAX_FALSE_REJECTION = 0.01
ERROR = 0.05
#: How much worse a wrongly rejected good document counts than a kept bad one.
HARM = 20.0


@dataclass(frozen=True)
class Rule:
    """Rejects when the sign times the measure exceeds a cutoff; cutoffs from lenient to strict."""

    name: str
    measure: str
    sign: int
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", 1, (2.0, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("dup_line_share", "n_dup_lines / greatest(n_lines, 1)", 1, (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("repeat_word_share", "n_repeat_words / greatest(n_words, 1)", 1, (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    Rule("long_words", "word_chars / greatest(n_words, 1)", 1, (12.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.5)),
    Rule("short_words", "word_chars / greatest(n_words, 1)", -1, (-2.0, -2.5, -3.0, -3.5, -4.0, -4.25, -4.5)),
    Rule("few_distinct_words", "n_distinct_words / greatest(n_words, 1)", -1, (-0.05, -0.1, -0.2, -0.3, -0.4, -0.5)),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are told apart by 64-bit hashes. A text whose hashes are all distinct is done;
    else hashes are sorted with their places, equal neighbours kept, and the union of
    their windows measured in order of place: n log n, without a set per window.
    """
    def among(hashes: Column) -> Column:
        def flagged(pairs: Column) -> Column:
            twice = F.filter(pairs, lambda x, i: (
                F.coalesce(F.get(pairs, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False))
            ))
            places = F.sort_array(F.transform(twice, lambda x: x["at"]))
            start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
            return F.aggregate(
                places, start,
                lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")),
                lambda acc: acc["n"],
            )
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(pairs, flagged))

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(hashes, among))


def measures(text: Column) -> Column:
    """The counts of ``MEASURES`` (long) of a text; null counts as empty."""
    def of_text(t: Column) -> Column:
        def of_words(words: Column) -> Column:
            lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
            return let(lines, lambda ln: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
                (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
                _repeat_words(words).alias("n_repeat_words"),
                F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
                F.size(ln).cast("long").alias("n_lines"),
            ))
        return let(F.filter(F.split(t, WORD_BREAK), lambda w: w != ""), of_words)
    return let(F.coalesce(text, F.lit("")), of_text)


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def rejecting_step() -> str:
    """SQL: the first step of strictness at which a rule rejects; NULL if none ever does.

    Step ``t`` has every rule at the ``t``-th of its cutoffs, or at its strictest one: the
    steps are fixed beforehand, and what one rejects the next one rejects too.
    """
    def of(rule: Rule) -> str:
        value, more = f"{rule.sign} * ({rule.measure})", len(rule.cutoffs) + 1
        return f"nullif({more} - ({' + '.join(f'int({value} > {c}D)' for c in rule.cutoffs)}), {more})"

    return f"least({', '.join(map(of, RULES))})"


def measured(documents: DataFrame) -> DataFrame:
    """``documents`` with ``MEASURES``, ``base_failed`` and ``step``, from which on the rules
    reject the document. Clashing columns are replaced."""
    added = (*MEASURES, "base_failed", "step")
    rows = documents.select(
        *[c for c in documents.columns if c not in added], measures(F.col("text")).alias("_m")
    ).select("*", "_m.*").drop("_m")
    return rows.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("step", F.expr(rejecting_step()))


def _log_factorial(x: str) -> str:
    """SQL: the logarithm of ``x`` factorial, by Stirling's series from 10 on."""
    y = f"({x} + 1D)"
    series = (
        f"({y} - 0.5D) * ln({y}) - {y} + {0.5 * math.log(2 * math.pi)!r}D"
        f" + 1 / (12 * {y}) - 1 / (360 * pow({y}, 3)) + 1 / (1260 * pow({y}, 5))"
    )
    return f"if({x} < 10, ln(cast(factorial(int(least({x}, 10))) AS double)), {series})"


def binomial_tail(n: str, k: str, share: float) -> str:
    """SQL: the chance of ``k`` or fewer events among ``n`` of probability ``share``, exact to
    rounding; 1 where ``k`` is no less than expected, as no test can pass there.

    Below that, terms fall from ``k`` downwards. They are summed in units of the largest;
    those more than 12 times the root of ``k`` away are below any rounding, so there are few
    however large the counts.
    """
    top = (
        f"{_log_factorial(n)} - ({_log_factorial(k)}) - ({_log_factorial(f'({n} - {k})')})"
        f" + {k} * {math.log(share)!r}D + ({n} - {k}) * {math.log1p(-share)!r}D"
    )
    units = f"""
        aggregate(
            sequence(0L, least({k}, 60L + 12L * cast(sqrt({k}) AS bigint))),
            struct(1D as term, 0D as total),
            (acc, i) -> struct(
                acc.term * ({k} - i) / ({n} - {k} + i + 1) * {(1 - share) / share!r}D as term, acc.total + acc.term as total),
            acc -> acc.total)
    """
    return f"if({k} >= {share}D * {n}, 1D, exp({top}) * {units})"


def certified_steps(
    rows: DataFrame, labels: DataFrame, share: float = MAX_FALSE_REJECTION, error: float = ERROR,
) -> DataFrame:
    """Per ``stratum`` the step of strictness that is certified (``reject_step``), if any is.

    ``rows`` has ``doc_id``, ``stratum``, ``base_failed`` and ``step``. The holdout is all
    labelled documents that pass the base rules. For every stratum and step the hypothesis
    that all rules together reject more than ``share`` of its good documents is tested with
    the exact binomial tail of the good ones they did reject. Strata share ``error`` equally
    (Bonferroni); within a stratum the steps, fixed beforehand, are tested from lenient to
    strict and end at the first that fails, which needs no further correction. Of the
    certified steps the one with the best balance of rejected bad and good documents is
    taken, the more lenient of equals; any choice among them keeps the promise. A
    stratum with too few good documents gets no step, so nothing is rejected on its account.
    """
    one_label = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    held = rows.where("NOT base_failed").join(one_label, "doc_id")
    # At most one row per stratum and step from here on.
    by_step = held.groupBy("stratum", "step").agg(
        F.sum(F.expr("bigint(quality = 1)")).alias("good"), F.sum(F.expr("bigint(quality <> 1)")).alias("bad")
    )
    cells = by_step.groupBy("stratum").agg(
        F.collect_list(F.struct("step", "good", "bad")).alias("steps"),
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
    )
    strata = cells.agg(F.count(F.lit(1)).alias("n_strata"))
    last = max(len(r.cutoffs) for r in RULES)
    tests = (
        cells.select("*", F.explode(F.sequence(F.lit(1), F.lit(last))).alias("at"))
        .select(
            "stratum", "at", "n_good", "n_bad",
            *[F.expr(f"aggregate(filter(steps, x -> x.step <= at), 0L, (a, x) -> a + x.{c})").alias(c) for c in ("good", "bad")],
        )
        .withColumn("chance", F.expr(binomial_tail("n_good", "good", share)))
    )
    allowed = F.lit(error) / strata.scalar()
    order = Window.partitionBy("stratum").orderBy("at")
    passed = tests.withColumn("ok", F.min(F.col("chance") <= allowed).over(order)).where("ok AND bad > 0")
    gain = F.expr(f"bad / greatest(n_bad, 1) - {HARM}D * good / greatest(n_good, 1)")
    return passed.withColumn("gain", gain).where("gain > 0").groupBy("stratum").agg(
        F.max(F.struct("gain", F.expr("-at").alias("lenient"), "at")).alias("best")
    ).select("stratum", F.col("best.at").alias("reject_step"))


def _strata(documents: DataFrame) -> DataFrame:
    """The stratum of a document: its language, the empty one for null."""
    return documents.withColumn("stratum", F.coalesce("lang", F.lit("")))


def judged(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """``rows`` (measured, with ``stratum``) with ``kept``.

    ``steps`` is a stored table with one row per stratum: from its file size the
    optimizer sees whether it can be broadcast, and else shuffles.
    """
    # One condition over both sides: a part of it that Spark could test before the join would be
    # computed from the text there and again after it.
    verdict = "CASE WHEN base_failed THEN false ELSE NOT coalesce(step <= reject_step, false) END"
    return rows.join(steps, "stratum", "left").withColumn("kept", F.expr(verdict)).drop("reject_step")


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict for every document; null and empty texts fail the base rules.

    Texts are read once: steps are chosen and applied on a narrow table of counts.
    """
    rows = stored(measured(_strata(documents).select("doc_id", "stratum", "text")).drop("text"), "quality_measures")
    steps = stored(certified_steps(rows, labels), "quality_steps")
    return judged(rows, steps).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns.

    The counts are computed once for the steps and again for the verdict, which costs
    less than joining verdicts to texts: no text is shuffled.
    """
    own = documents.select(F.struct("*").alias("_row"), "doc_id", "text", "lang")
    rows = _strata(documents.select("doc_id", "text", "lang"))
    narrow = stored(measured(rows).select("doc_id", "stratum", "base_failed", "step"), "quality_measures")
    steps = stored(certified_steps(narrow, labels), "quality_steps")
    return judged(measured(_strata(own)), steps).where("kept").select("_row.*")

"""Detection quality against labels.

A flagged row is a true positive when its event or campaign is malicious under any
class. Recall is measured on the rule's designed class only: anchors for event-grain
rules, distinct campaigns for campaign-grain rules. All rules of a grain are scored in
one pass; nothing is looked up per flagged row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from loginwatch.operators.normalize import failures


@dataclass(frozen=True)
class Rule:
    label: str
    grain: str
    designed_class: str
    technique: str


# The seven rules and what each is designed to catch.
RULES = {
    "unfamiliar_country": Rule("Unfamiliar Country", "event", "unfamiliar_country", "T1078"),
    "impossible_travel": Rule("Impossible Travel", "event", "impossible_travel", "T1078"),
    "after_hours": Rule("After-Hours Login", "event", "after_hours", "T1078"),
    "brute_force": Rule("Brute Force (success)", "event", "brute_force_success", "T1110.001"),
    "password_spray": Rule("Password Spray", "campaign", "password_spray", "T1110.003"),
    "bruteforce_failed": Rule("Failed Brute Force", "campaign", "brute_force_failed", "T1110.001"),
    "inactive_account": Rule("Inactive Account", "event", "terminated_account", "T1078.002"),
}


def rules_of(grain: str) -> list[str]:
    return [name for name, rule in RULES.items() if rule.grain == grain]


def _designed_rule(names: list[str]) -> Column:
    """The rule a label's class is designed for; NULL for other classes."""
    pairs = [F.lit(v) for n in names for v in (RULES[n].designed_class, n)]
    return F.try_element_at(F.create_map(*pairs), F.col("anomaly_class"))


def _totals(ledger: DataFrame, names: list[str]) -> DataFrame:
    """Ledger rows to counts per rule, rules without any row included.

    ``rows`` counts flagged rows, ``flagged`` says whether the item was caught.
    """
    columns = ["rows", "flagged", "malicious", "expected"]
    every = ledger.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("rule"),
        *[F.lit(0).cast("bigint").alias(c) for c in columns],
    )
    rows = ledger.select("rule", *columns).unionByName(every)
    return rows.groupBy("rule").agg(*[
        F.coalesce(F.expr(f"sum({value})"), F.lit(0).cast("bigint")).alias(name)
        for name, value in {
            "flagged": "rows",
            "tp": "if(malicious > 0, rows, 0)",
            "fp": "if(malicious > 0, 0, rows)",
            "tp_designed": "if(flagged > 0, expected, 0)",
            "fn": "if(flagged > 0, 0, expected)",
        }.items()
    ])


def event_findings(detections: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [detections[n].select(F.lit(n).alias("rule"), "event_id") for n in rules_of("event")],
    )


def _event_ledger(findings: DataFrame, labels: DataFrame) -> DataFrame:
    """Per rule and event: rows flagged, malicious under any class, designed anchor.

    Findings and labels are stacked and met once by event id; each input is read once.
    Benign labels that are nobody's anchor cannot change a count and stay out.
    """
    rule = _designed_rule(rules_of("event"))
    marked = labels.select(
        "event_id", F.when(F.col("is_anchor") == 1, rule).alias("rule"),
        F.lit(0).cast("bigint").alias("flagged"), F.col("is_malicious").cast("bigint").alias("malicious"),
    ).where((F.col("malicious") > 0) | F.col("rule").isNotNull())
    stacked = findings.select(
        "event_id", "rule", F.lit(1).cast("bigint").alias("flagged"), F.lit(0).cast("bigint").alias("malicious")
    ).withColumn("expected", F.lit(0).cast("bigint")).unionByName(
        marked.withColumn("expected", F.col("rule").isNotNull().cast("bigint"))
    )
    cells = stacked.repartition("event_id").groupBy("event_id", "rule").agg(
        F.sum("flagged").alias("flagged"), F.max("malicious").alias("malicious"),
        F.max("expected").alias("expected"),
    )
    # An event has at most one cell per rule and one without, so this window is tiny.
    verdict = F.max("malicious").over(Window.partitionBy("event_id"))
    return cells.withColumn("malicious", verdict).where(F.col("rule").isNotNull())


def event_metrics(findings: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts for all event-grain rules; ``findings`` is ``(rule, event_id)`` rows."""
    ledger = _event_ledger(findings, labels).withColumn("rows", F.col("flagged"))
    return _totals(ledger, rules_of("event"))


def event_errors(findings: DataFrame, labels: DataFrame) -> DataFrame:
    """The flagged benign events and the missed anchors themselves, one row each."""
    missed = (F.col("flagged") == 0) & (F.col("expected") > 0)
    false_alarm = (F.col("flagged") > 0) & (F.col("malicious") <= 0)
    return _event_ledger(findings, labels).where(missed | false_alarm).select(
        "rule", F.when(missed, "FN").otherwise("FP").alias("error"), "event_id"
    )


def _campaign_ledger(
    detections: Mapping[str, DataFrame], events: DataFrame, labels: DataFrame
) -> DataFrame:
    """Per rule, one row for every flagged key and one for every campaign in play.

    A key is its account, source and day, not its text, which is NULL for an unknown source.
    Members are the failures sharing these columns. Failures meet their labels by event id first and are
    folded per account, source, day and campaign, so a busy source reaches the key
    joins as a few rows.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    marks = labels.where(F.col("campaign_id").isNotNull() | (F.col("is_malicious") > 0)).select(
        "event_id", F.col("is_malicious").cast("bigint").alias("malicious"), "campaign_id"
    )
    marked = (
        failures(events).select("event_id", "username", "source_ip", "login_date")
        .join(marks, "event_id")
        .groupBy("username", "source_ip", "login_date", "campaign_id")
        .agg(F.max("malicious").alias("malicious"))
    )
    marked = marked.selectExpr(
        "username AS m_user", "source_ip AS m_ip", "login_date AS m_date", "campaign_id", "malicious"
    )
    key = ["rule", "username", "source_ip", "login_date"]

    def members(rule: str, username: str) -> DataFrame:
        # Without the account in the key, a source's accounts are folded before they meet it.
        side = marked if username == "username" else marked.groupBy("m_ip", "m_date", "campaign_id").agg(
            F.max("malicious").alias("malicious")
        )
        found = detections[rule].selectExpr(f"'{rule}' AS rule", f"{username} AS username", "source_ip", "login_date", "campaign_key")
        # An unknown source is a source of its own, as in the rules' grouping.
        same = "source_ip <=> m_ip AND login_date = m_date" + (" AND username = m_user" if username == "username" else "")
        return found.join(side, F.expr(same), "left").select(*key, "campaign_key", "campaign_id", "malicious")

    every = members("password_spray", "cast(NULL AS string)").unionByName(members("bruteforce_failed", "username"))
    cells = every.groupBy(*key, "campaign_key", "campaign_id").agg(
        F.max(F.coalesce("malicious", zero)).alias("malicious")
    )
    per_key = Window.partitionBy(*key)
    keyed = cells.withColumn("key_bad", F.max("malicious").over(per_key)).withColumn(
        "is_first", F.row_number().over(per_key.orderBy("campaign_id")) == 1
    )

    def fact(kind: str, item: str, flagged: Column) -> Column:
        own = F.lit(kind == "key")
        return F.struct(
            F.lit(kind).alias("kind"), F.col(item).alias("item"),
            *[F.when(own, F.col(c)).alias(c) for c in key[1:]], flagged.alias("flagged"),
            F.when(own, F.col("key_bad")).otherwise(zero).alias("malicious"), zero.alias("expected"),
        )

    covers = F.col("campaign_id").isNotNull() & (F.col("key_bad") > 0)
    facts = keyed.select("rule", F.explode(F.array(
        F.when(F.col("is_first"), fact("key", "campaign_key", one)),
        F.when(covers, fact("campaign", "campaign_id", one)),
    )).alias("f")).where(F.col("f").isNotNull()).select("rule", "f.*")
    expected = labels.where(F.col("campaign_id").isNotNull()).select(
        _designed_rule(rules_of("campaign")).alias("rule"), F.lit("campaign").alias("kind"),
        F.col("campaign_id").alias("item"), *[F.lit(None).cast(t).alias(c) for c, t in keyed.select(*key[1:]).dtypes],
        zero.alias("flagged"), zero.alias("malicious"), one.alias("expected"),
    ).where(F.col("rule").isNotNull())
    return facts.unionByName(expected).groupBy("rule", "kind", "item", *key[1:]).agg(
        *[F.max(c).alias(c) for c in ("flagged", "malicious", "expected")]
    )


def campaign_metrics(
    detections: Mapping[str, DataFrame], events: DataFrame, labels: DataFrame
) -> DataFrame:
    """Counts for both campaign-grain rules."""
    # A covered campaign is a hit, but only keys are flagged rows.
    is_key = F.col("kind") == "key"
    ledger = _campaign_ledger(detections, events, labels).withColumn(
        "rows", F.when(is_key, F.col("flagged")).otherwise(0)
    )
    return _totals(ledger, rules_of("campaign"))


def campaign_findings_counted(
    detections: Mapping[str, DataFrame], events: DataFrame, labels: DataFrame
) -> DataFrame:
    """Per campaign rule the findings and what the scores call flagged; they must agree."""
    found = reduce(DataFrame.unionByName, [
        detections[n].agg(F.count(F.lit(1)).alias("findings")).select(F.lit(n).alias("rule"), "findings")
        for n in rules_of("campaign")
    ])
    return found.join(campaign_metrics(detections, events, labels).select("rule", "flagged"), "rule")


def campaign_errors(
    detections: Mapping[str, DataFrame], events: DataFrame, labels: DataFrame
) -> DataFrame:
    """The benign keys flagged and the campaigns missed, as rows.

    ``item`` is a campaign or the text of a key; a key's columns tell keys of unknown
    sources apart, whose text is NULL.
    """
    ledger = _campaign_ledger(detections, events, labels)
    wrong_key = (F.col("kind") == "key") & (F.col("malicious") <= 0)
    missed = (F.col("kind") == "campaign") & (F.col("flagged") == 0)
    return ledger.where(wrong_key | missed).select(
        "rule", F.when(wrong_key, "FP").otherwise("FN").alias("error"), "item", "username", "source_ip", "login_date"
    )


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; nothing to measure scores 1."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(1.0))


def rule_scores(*counts: DataFrame) -> DataFrame:
    """Precision and recall per rule, from the event and campaign counts."""
    rows = reduce(DataFrame.unionByName, counts)
    info = F.create_map(*[
        v for n, r in RULES.items()
        for v in (F.lit(n), F.struct(F.lit(r.label).alias("label"), F.lit(r.technique).alias("technique"),
                                     F.lit(r.grain).alias("grain")))
    ])
    return rows.withColumn("info", info[F.col("rule")]).select(
        "rule", F.col("info.label").alias("label"), F.col("info.technique").alias("technique"),
        F.col("info.grain").alias("grain"), "flagged", "tp", "fp", "fn", "tp_designed",
        _ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        _ratio(F.col("tp_designed"), F.col("tp_designed") + F.col("fn")).alias("recall"),
    )


def micro_average(scores: DataFrame) -> DataFrame:
    """Totals over all rules and the scores they give, one row."""
    totals = scores.agg(*[F.sum(c).alias(c) for c in ("flagged", "tp", "fp", "fn", "tp_designed")])
    return totals.withColumns({
        "precision": _ratio(F.col("tp"), F.col("flagged")),
        "recall": _ratio(F.col("tp_designed"), F.col("tp_designed") + F.col("fn")),
    })


def dataset_summary(
    events: DataFrame,
    labels: DataFrame,
    employees: DataFrame,
    machines: DataFrame,
    queue: DataFrame,
    integrity: list[DataFrame],
    patches: DataFrame,
) -> DataFrame:
    """The headline numbers, one row."""
    def counted(name: str, rows: DataFrame, *conditions: tuple[str, Column]) -> DataFrame:
        wanted = conditions or ((name, F.lit(True)),)
        values = F.array(*[
            F.struct(F.lit(n).alias("measure"), F.count_if(c).alias("value")) for n, c in wanted
        ])
        return rows.agg(values.alias("m")).select(F.explode("m").alias("m")).select("m.*")

    severity = F.col("severity")
    parts = [
        counted("events", events),
        counted("malicious_events", labels.where(F.col("is_malicious") == 1).select("event_id").distinct()),
        counted("employees", employees),
        counted("devices", machines),
        counted(
            "triage", queue, ("triage_rows", F.lit(True)), ("high", severity == "HIGH"),
            ("medium", severity == "MEDIUM"), ("low", severity == "LOW"),
        ),
        *[counted("integrity_issues", rows) for rows in integrity],
        counted("critical_patch", patches.where(F.col("patch_risk") == "CRITICAL")),
    ]
    names = [
        "events", "malicious_events", "employees", "devices", "triage_rows", "high", "medium", "low",
        "integrity_issues", "critical_patch",
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.agg(*[
        F.coalesce(F.sum(F.when(F.col("measure") == n, F.col("value"))), F.lit(0)).alias(n) for n in names
    ])


def asset_metrics(findings: DataFrame, asset_labels: DataFrame) -> DataFrame:
    """Scores per asset class; ``findings`` is ``(anomaly_class, asset_id)`` rows.

    A finding is right when the asset carries that class; a label no check found is missed.
    """
    found = findings.groupBy("anomaly_class", "asset_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = asset_labels.select("anomaly_class", "asset_id").distinct().withColumn("labelled", F.lit(True))
    both = found.join(wanted, ["anomaly_class", "asset_id"], "full")
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    labelled = F.col("labelled").isNotNull()
    counts = both.groupBy("anomaly_class").agg(
        F.sum(n).alias("flagged"),
        F.sum(F.when(labelled, n).otherwise(0)).alias("tp"),
        F.sum(F.when(~labelled, n).otherwise(0)).alias("fp"),
        F.count_if(labelled & F.col("n").isNotNull()).alias("tp_designed"),
        F.count_if(labelled & F.col("n").isNull()).alias("fn"),
    )
    return counts.withColumns({
        "precision": _ratio(F.col("tp"), F.col("flagged")),
        "recall": _ratio(F.col("tp_designed"), F.col("tp_designed") + F.col("fn")),
    })


def asset_findings(
    orphans: DataFrame, mismatches: DataFrame, deviceless: DataFrame, patches: DataFrame
) -> DataFrame:
    """Integrity and patch findings under the asset label classes."""
    # Class names.
    branches = [
        ("orphan_device", orphans, "device_id"),
        ("inventory_mismatch", mismatches, "device_id"),
        ("user_without_device", deviceless, "employee_id"),
        ("critical_patch_age", patches.where(F.col("patch_risk") == "CRITICAL"), "device_id"),
    ]
    return reduce(
        DataFrame.unionByName,
        [rows.select(F.lit(n).alias("anomaly_class"), F.col(c).alias("asset_id")) for n, rows, c in branches],
    )

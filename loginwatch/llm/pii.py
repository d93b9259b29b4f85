"""Personal data and the terms that give it away; built-in functions only.

Base spans follow fixed patterns. Terms near them are weighed by what the corpus says:
a term whose occurrences mostly stand beside one protected entity reveals it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loginwatch.llm.common import let, split_join, stored

#: Kinds in the order in which spans of one start are listed.
EMAIL, IP, CARD, PHONE, GENERAL, REMOVED = range(6)
KINDS = ("email", "ip", "card", "phone", "general", "removed")
MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]", "")
BASE = (EMAIL, IP, CARD, PHONE)

#: The patterns of the kinds. Where a try inside a run must fail as it did at the run's
#: start, ``\\G`` and the look-behind skip it, and runs are taken whole: no pattern is
#: quadratic in a long run, nor does it recurse.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must contain to be searched for a kind at all.
HINTS = ("@", r"[0-9]\.[0-9]", "[0-9][ -]?[0-9]", r"\+[0-9]")

#: A term: letters and digits. Terms each side of an entity, and characters that are
#: looked at for them.
TERM = r"[\p{L}\p{N}]{3,}+"
NEAR, REACH = 3, 96
#: Shares of an entity's information that a term may disclose before it is generalised
#: and before it is removed, and distinct windows that must show it.
GENERALISE, REMOVE = 0.85, 0.97
#: Slots by hash in which told terms are marked, a broadcast of bounded size.
SLOTS = 1 << 16

_BLOCK = 256


def starts(lengths: Column) -> Column:
    """Offsets of pieces from ``lengths``: structs of ``gap`` before a piece and its ``size``.

    A running sum in blocks, as appending to one array is quadratic.
    """
    empty = F.array().cast("array<int>")

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["gap"]
        return F.struct((at + x["size"]).alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

    def block(acc: Column, b: Column, all_lengths: Column) -> Column:
        own = F.aggregate(
            F.slice(all_lengths, b * _BLOCK + 1, F.lit(_BLOCK)),
            F.struct(acc["at"].alias("at"), empty.alias("out")), step,
        )
        return let(own, lambda o: F.struct(o["at"].alias("at"), F.concat(acc["out"], o["out"]).alias("out")))

    return let(lengths, lambda ls: F.when(F.size(ls) == 0, empty).otherwise(F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / _BLOCK).cast("int")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, b: block(acc, b, ls), lambda acc: acc["out"],
    )))


def occurrences(text: Column, pattern: str) -> Column:
    """Matches of a pattern as structs of ``start``, ``stop`` (code points) and ``value``.

    The same search gives the matches and what lies between them; their lengths add up to
    the places.
    """
    def of(matches: Column, gaps: Column) -> Column:
        lengths = F.transform(matches, lambda m, i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"),
        ))
        return let(starts(lengths), lambda at: F.transform(matches, lambda m, i: F.struct(
            F.get(at, i).alias("start"), (F.get(at, i) + F.length(m)).alias("stop"), m.alias("value"),
        )))
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: let(F.split(text, pattern, -1), lambda g: of(m, g)),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.ascii(F.substr(digits, F.length(digits) - i, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + worth(i))
    return total % 10 == 0


def _valid(kind: int, value: Column) -> Column:
    if kind == IP:
        # Without leading zeros a part has three digits at most, and as a number 255.
        return F.forall(F.split(value, r"\."), lambda p: let(F.regexp_replace(p, "^0+(?=[0-9])", ""), lambda x: (
            (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255"))
        )))
    if kind == CARD:
        return let(_digits(value), lambda d: F.length(d).between(14, 19) & _luhn(d))
    if kind == PHONE:
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All valid base spans by start, then kind: structs of ``start``, ``kind``, ``stop``, ``value``."""
    nothing = F.array().cast("array<struct<start: int, kind: int, stop: int, value: string>>")

    def of_kind(t: Column, kind: int) -> Column:
        valid = F.filter(occurrences(t, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        spans = F.transform(valid, lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value"),
        ))
        return F.when(t.rlike(HINTS[kind]), spans).otherwise(nothing)

    return let(F.coalesce(text, F.lit("")), lambda t: F.array_sort(F.concat(*[of_kind(t, k) for k in BASE])))


def contexts(text: Column, spans: Column) -> Column:
    """The ``NEAR`` terms each side of every span, up to the spans beside it: structs of
    ``entity``, ``term`` (lower case), ``start``, ``stop`` and ``window``, a hash of the
    entity's surroundings."""
    def beside(s: Column, i: Column) -> Column:
        left = F.greatest(s["start"] - REACH, F.coalesce(F.get(spans, i - 1)["stop"], F.lit(0)), F.lit(0))
        right = F.least(s["stop"] + REACH, F.coalesce(F.get(spans, i + 1)["start"], s["stop"] + REACH))

        def terms(begin: Column, end: Column, last: bool) -> Column:
            size = F.greatest(end - begin, F.lit(0))
            found = occurrences(F.substr(text, begin + 1, size), TERM)
            # A term cut off by the reach is none.
            if last:
                whole = F.filter(found, lambda m: (m["start"] > 0) | (begin == 0) | (size < REACH))
                near = let(whole, lambda w: F.slice(w, F.greatest(F.size(w) - NEAR + 1, F.lit(1)), F.lit(NEAR)))
            else:
                near = F.slice(F.filter(found, lambda m: (m["stop"] < REACH)), 1, NEAR)
            return F.transform(near, lambda m: F.struct(
                F.lower(m["value"]).alias("term"), (m["start"] + begin).alias("start"), (m["stop"] + begin).alias("stop"),
            ))

        window = F.xxhash64(F.substr(text, left + 1, F.greatest(right - left, F.lit(0))))
        both = F.concat(terms(left, s["start"], True), terms(s["stop"], right, False))
        return F.transform(both, lambda t: F.struct(
            F.concat(F.get(F.array(*map(F.lit, KINDS)), s["kind"]), F.lit(":"), s["value"]).alias("entity"),
            t["term"].alias("term"), t["start"].alias("start"), t["stop"].alias("stop"), window.alias("window"),
        ))
    return F.flatten(F.transform(spans, beside))


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def term_counts(documents: DataFrame) -> DataFrame:
    """Occurrences of every term in all whole texts; counted in parts before the shuffle."""
    return documents.select(F.explode(F.regexp_extract_all(_text(), F.lit(TERM), F.lit(0))).alias("term")).groupBy(
        "term").agg(F.count(F.lit(1)).alias("n")).groupBy(F.lower("term").alias("term")).agg(F.sum("n").alias("n"))


def disclosing(mentions: DataFrame, counts: DataFrame) -> DataFrame:
    """Pairs of an entity and a term that gives it away: ``pair``, ``term``, ``kind``, and
    ``n`` mentions.

    Information content of an entity: -log2 of the share of all term occurrences that lie
    in its windows. What a term discloses is their pointwise mutual information: how much
    likelier one of its occurrences lies in such a window than any occurrence. A term
    found nowhere else discloses everything, a share of 1; one from ``GENERALISE`` of the
    entity's information on is generalised, from ``REMOVE`` on removed. Two windows that
    differ must show the pair: copies of one passage are no evidence.
    """
    pairs = mentions.groupBy("pair", "entity", "term").agg(
        F.sum("times").alias("together"), F.count(F.lit(1)).alias("mentions"),
        (F.min("window") < F.max("window")).alias("shown"),
    )
    entities = mentions.groupBy("entity").agg(F.sum("times").alias("in_windows"))
    shown = stored(pairs.where("shown").drop("shown"), "pii_pairs")
    total = shown.count()
    per_entity = shown.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).join(entities, "entity")
    per_term = shown.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(
        counts.withColumnRenamed("n", "seen"), "term"
    )
    half = stored(split_join(shown, stored(per_entity, "pii_entities"), "entity", total).drop("n"), "pii_weighed")
    weighed = split_join(half, stored(per_term, "pii_seen"), "term", total).drop("n").withColumn(
        "everything", counts.agg(F.sum("n")).scalar()
    )
    share = F.log2(F.col("together") * F.col("everything") / (F.col("seen") * F.col("in_windows")))
    content = F.log2(F.col("everything") / F.col("in_windows"))
    return weighed.withColumn("share", F.when(content > 0, share / content).otherwise(0.0)).where(
        f"share >= {GENERALISE}"
    ).select(
        "pair", "term", F.expr(f"if(share >= {REMOVE}, {REMOVED}, {GENERAL})").alias("kind"), F.col("mentions").alias("n"),
    )


def weighed_data(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Base spans of every document (``doc_id``, ``key``, a digest of the text, ``base``), the
    mentions of terms near them, and the pairs that give an entity away."""
    bases = documents.select("doc_id", "text").withColumn("base", base_spans(F.col("text")))
    searched = stored(bases.select(
        "doc_id", F.md5(_text()).alias("key"), "base",
        F.when(F.size("base") > 0, let(F.col("base"), lambda b: contexts(_text(), b))).alias("near"),
    ), "pii_spans")
    mentions = stored(
        searched.select("key", F.explode("near").alias("m")).select("key", "m.*")
        .groupBy("key", "entity", "term", "start", "stop", "window").agg(F.count(F.lit(1)).alias("times"))
        .withColumn("pair", F.concat_ws(" ", "entity", "term")), "pii_mentions",
    )
    counts = stored(term_counts(documents), "pii_terms")
    return searched.select("doc_id", "key", "base"), mentions, stored(disclosing(mentions, counts), "pii_disclosing")


def told_terms(documents: DataFrame) -> DataFrame:
    """For every distinct text that holds them anywhere, the terms that give an entity away:
    ``key``, ``told`` (structs of ``term`` and ``kinds``) and ``n``, the documents of that text.

    Only terms that share a slot with a told one are shuffled.
    """
    searched, _, told = weighed_data(documents)
    kinds = stored(told.groupBy("term").agg(F.array_sort(F.collect_set("kind")).alias("kinds")), "pii_told")
    slot = F.pmod(F.xxhash64("term"), F.lit(SLOTS)).alias("slot")
    terms = F.array_distinct(F.transform(F.regexp_extract_all(_text(), F.lit(TERM), F.lit(0)), F.lower))
    held = stored(
        documents.select(F.md5(_text()).alias("key"), F.explode(terms).alias("term")).select("key", "term", slot)
        .join(F.broadcast(kinds.select(slot).distinct()), "slot", "left_semi").select("key", "term").distinct(), "pii_held",
    )
    sized = stored(kinds.join(held.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term"), "pii_told")
    by_text = split_join(held, sized, "term", held.count()).where("kinds IS NOT NULL").groupBy("key").agg(
        F.collect_list(F.struct("term", "kinds")).alias("told")
    )
    return stored(by_text.join(searched.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key"), "pii_told_texts")


def term_spans(text: Column, told: Column) -> Column:
    """Every occurrence of the told terms: structs of ``start``, ``kind`` and ``stop``."""
    def spans(m: Column, kinds: Column) -> Column:
        return F.transform(kinds, lambda k: F.struct(m["start"].alias("start"), k.alias("kind"), m["stop"].alias("stop")))

    return let(F.map_from_entries(told), lambda by: F.flatten(F.transform(
        F.filter(occurrences(text, TERM), lambda m: F.map_contains_key(by, F.lower(m["value"]))),
        lambda m: spans(m, F.element_at(by, F.lower(m["value"]))),
    )))


def personal_data(documents: DataFrame) -> DataFrame:
    """Every document as ``row`` (all its columns) with ``base`` and ``spans``, the base and
    term spans by start, then kind.

    A term that gives an entity away is marked wherever it stands, also far from the entity
    and in texts without one. Texts are matched to the told terms they hold by a digest.
    Null texts count as empty; repeated rows and null ids are like any other.
    """
    rows = documents.select(F.struct("*").alias("row"), _text().alias("text"), F.md5(_text()).alias("key"))
    joined = split_join(rows, told_terms(documents), "key", documents.count())
    none = F.array().cast("array<struct<start: int, kind: int, stop: int>>")
    terms = F.when(F.col("told").isNotNull(), term_spans(F.col("text"), F.col("told"))).otherwise(none)

    def both(base: Column) -> Column:
        plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
        return F.struct(plain.alias("base"), F.array_sort(F.concat(plain, terms)).alias("spans"))

    found = joined.select("row", "text", let(base_spans(F.col("text")), both).alias("found"))
    return found.select("row", "text", "found.*")


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"),
    )), ",")


def span_report(documents: DataFrame) -> DataFrame:
    """The result of the query."""
    return personal_data(documents.select("doc_id", "text")).select(
        "row.doc_id",
        *[F.expr(f"bigint(size(filter(base, s -> s.kind = {k})))").alias(f"n_{KINDS[k]}") for k in BASE],
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with a mask for each span; of spans that overlap, the first names the mask."""
    masks = F.array(*map(F.lit, MASKS))
    empty = F.array().cast("array<string>")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.concat(acc["out"], F.array(gap, F.get(masks, s["kind"])))
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"), F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), empty.alias("out")), step,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1, F.length(text))),
    )


def sanitised(documents: DataFrame) -> DataFrame:
    """The documents with masked texts and ``n_chars`` to match; all rows and columns stay.
    What is masked are the spans of :func:`personal_data`."""
    present = "text IS NOT NULL"
    changed = personal_data(documents.where(present)).select("row", "text", masked(F.col("text"), F.col("spans")).alias("new"))
    same = F.col("new") == F.col("text")
    values = {
        "text": F.col("new"),
        "n_chars": F.when(same, F.col("row.n_chars")).otherwise(F.length("new").cast("long")),
    }
    own = changed.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in documents.columns])
    return documents.where(f"NOT ({present})").unionByName(own)

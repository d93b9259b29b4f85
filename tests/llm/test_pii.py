import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from loginwatch.llm import pii

from .cases import documents, odd_documents, table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True,
        "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
    }[kind]


def slow_base(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), k, m.end(), m[0]) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(found)


def slow_contexts(text, base):
    out = []
    for i, (start, kind, stop, value) in enumerate(base):
        left = max(start - pii.REACH, base[i - 1][2] if i else 0, 0)
        right = min(stop + pii.REACH, base[i + 1][0] if i + 1 < len(base) else stop + pii.REACH, len(text))
        window = text[left:max(right, left)]
        before = [m for m in regex.finditer(r"[\p{L}\p{N}]{3,}+", text[left:start])
                  if m.start() or not left or start - left < pii.REACH][-pii.NEAR:] if start > left else []
        after = [m for m in regex.finditer(r"[\p{L}\p{N}]{3,}+", text[stop:max(right, stop)]) if m.end() < pii.REACH][:pii.NEAR]
        for m, at in [(m, left) for m in before] + [(m, stop) for m in after]:
            out.append((f"{pii.KINDS[kind]}:{value}", m[0].lower(), m.start() + at, m.end() + at, window))
    return out


def slow_report(rows):
    texts = [t or "" for _, t in rows]
    base = [slow_base(t) for t in texts]
    near = [slow_contexts(t, b) for t, b in zip(texts, base)]
    seen = Counter(m[0].lower() for t in texts for m in regex.finditer(r"[\p{L}\p{N}]{3,}+", t))
    total = sum(seen.values())
    together, inside, windows = Counter(), Counter(), defaultdict(set)
    for own in near:
        for entity, term, _, _, window in own:
            together[entity, term] += 1
            inside[entity] += 1
            windows[entity, term].add(window)
    told = {}
    for (entity, term), n in together.items():
        content = math.log2(total / inside[entity])
        share = math.log2(n * total / (seen[term] * inside[entity])) / content if content > 0 else 0
        if len(windows[entity, term]) > 1 and share >= pii.GENERALISE:
            told[entity, term] = 5 if share >= pii.REMOVE else 4
    kinds = defaultdict(set)
    for (_, term), kind in told.items():
        kinds[term].add(kind)
    for (doc_id, _), text, b in zip(rows, texts, base):
        terms = {
            (m.start(), k, m.end()) for m in regex.finditer(r"[\p{L}\p{N}]{3,}+", text) for k in kinds.get(m[0].lower(), ())
        }
        spans = sorted([x[:3] for x in b] + list(terms))
        names = [",".join(f"{pii.KINDS[k]}:{s}:{z}" for s, k, z in part) for part in ([x[:3] for x in b], spans)]
        counts = Counter(k for _, k, _, _ in b)
        yield doc_id, *(counts[k] for k in range(4)), hashlib.sha256(names[0].encode()).hexdigest(), names[1]


FILL = "ordinary words that stand all over the place in every text of this little corpus and mean nothing "
TEXTS = [
    "write to a.b@c-d.com or x@y.z.w, not to @no.one, a@b or é@example.com. 10.0.0.1 1.2.3.4.5 999.1.1.1 007.08.9.010 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 or 41111111111111112222222 +1 (555) 123-4567 +49301234567890123 +1 2",
    "a@b.c@d.e f.g@h.i_j@k.l 😀 z@z.zz ☕4111111111111111☕ +12 345.678-9012) +(12)",
    "1" * 3000 + " " + "a" * 3000 + "@" + "b." * 2000 + "c", "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 " * 5, "+1" + "(" * 2000,
    " ".join(f"10.{i % 256}.{i // 256}.7" for i in range(700)),
    FILL * 30,
    FILL + "Zanzibar bureau mail zz@top.com every week Quuxon " + FILL,
    FILL + "again the Zanzibar office: zz@top.com is what Quuxon reads " + FILL,
    FILL + "nothing but words around zz@top.com here " + FILL,
    FILL + "nothing but words around zz@top.com here " + FILL, None, "",
]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


FAR = [
    *[f"{FILL}{a} Xanadu {b} mail xx@top.com every week {FILL}" for a in "abc" for b in "abc"],
    f"see xx@top.com {FILL * 3} XANADU again", f"no entity, but Xanadu, {FILL}Xanadus",
]


def test_the_fixture_has_terms_that_fire():
    """Not only beside the entity: in a text without one, too."""
    spans = [r[-1] for r in slow_report(list(enumerate(TEXTS + FAR)))]
    assert sum(s.count("general") + s.count("removed") for s in spans) >= 15
    assert "general" in spans[-1] + spans[-2] or "removed" in spans[-1]
    assert not set(pii.KINDS[:4]) & {x.split(":")[0] for x in spans[-1].split(",")}


@pytest.mark.parametrize("make", [
    lambda s: documents(s, TEXTS), lambda s: documents(s, TEXTS + FAR), odd_documents, lambda s: documents(s, []), lambda s: table(s, "documents"),
])
def test_report_equals_brute_force(spark, make):
    docs = make(spark)
    want = list(slow_report([(r.doc_id, r.text) for r in docs.collect()]))
    assert rows(pii.span_report(docs)) == sorted(want, key=repr)


def test_revealing_terms_are_found_and_common_ones_left(spark):
    docs = documents(spark, TEXTS)
    spans = {r.doc_id: r.spans for r in pii.span_report(docs).collect()}
    terms = {TEXTS[i][int(s.split(":")[1]):int(s.split(":")[2])] for i in (8, 9) for s in spans[i].split(",") if s[:5] in ("gener", "remov")}
    assert terms == {"Zanzibar", "Quuxon"}
    assert "general" not in spans[10] and "removed" not in spans[10]


def test_what_the_report_lists_is_what_is_masked(spark):
    docs = documents(spark, TEXTS + FAR)
    spans, texts = ({r.doc_id: r[-1] for r in f.select("doc_id", c).collect()} for f, c in ((pii.span_report(docs), "spans"), (pii.sanitised(docs), "text")))
    for i, text in enumerate(TEXTS + FAR):
        out, at = [], 0
        for kind, start, stop in (s.split(":") for s in spans[i].split(",") if s):
            if int(start) >= at:
                out += [text[at:int(start)], pii.MASKS[pii.KINDS.index(kind)]]
            at = max(at, int(stop))
        assert texts[i] == (None if text is None else "".join(out) + text[at:])


def test_masked_texts(spark):
    docs = documents(spark, TEXTS).withColumn("spans", F.lit(1)).withColumn("key", F.lit("mine"))
    out = pii.sanitised(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        assert not slow_base(r.text), r.text[:80]
        assert r.n_chars == len(r.text or "") and r.key == "mine"
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[7] == TEXTS[7] and "Zanzibar" not in got[8] and "[EMAIL]" in got[8] and got[12] is None
    assert got[1].startswith("[CARD] and 4111-1111-1111-1112 or 41111111111111112222222 [PHONE] +49301234567890123")


def test_only_built_in_functions(spark):
    for frame in (pii.span_report(documents(spark, TEXTS)), pii.sanitised(documents(spark, TEXTS))):
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", frame._jdf.queryExecution().toString())


def test_told_terms_are_masked_in_every_text(spark):
    """Beside the entity, far off in its text, and in texts without an entity."""
    far = FILL * 3 + "nothing of note " + FILL
    texts = [*TEXTS, FILL * 40, *[f"{FILL}{a} Xanadu {b} mail xx@top.com every week {FILL}" for a in "abc" for b in "abc"],
             f"see xx@top.com {far} XANADU again", f"no entity, but Xanadu, {FILL}Xanadus"]
    docs = documents(spark, texts)
    assert any("Xanadu" in texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for i, r in enumerate(
        sorted(pii.span_report(docs).collect(), key=lambda r: r.doc_id)) for s in r.spans.split(",") if s[:5] in ("gener", "remov"))
    got = {r.doc_id: r for r in pii.sanitised(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        left = regex.findall(r"[\p{L}\p{N}]{3,}+", got[i].text or "")
        assert not {"xanadu", "zanzibar", "quuxon"} & {w.lower() for w in left} and got[i].n_chars == len(got[i].text or "")
    assert got[len(texts) - 1].text.endswith("Xanadus") and got[7].text == texts[7] and got[12].text is None

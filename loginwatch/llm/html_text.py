"""Main text of pages: wrappers inferred per host by aligning token streams."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loginwatch.llm.common import split_join, stored
from loginwatch.llm.url_filters import with_host_and_path

#: Elements that make up a region's path.
CONTAINERS = frozenset(
    "html body div section article main nav header footer aside form ul ol dl table dialog details menu fieldset center".split()
)
#: Elements that end a block of text; all others run on.
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre blockquote figure figcaption address hr summary hgroup option".split()
)
#: Elements whose text is never the article's, and those without an end.
NEVER = frozenset("nav footer aside form button select textarea dialog menu iframe svg noscript template object canvas audio video math head title".split())
RAW = frozenset("script style".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark what surrounds an article.
MARKS = frozenset("""
    nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside widget notice notices cookie
    cookies consent banner alert popup modal newsletter subscribe signup ad ads adv advert adverts advertisement
    sponsor sponsored promo share sharing social related recommended comment comments disqus reply replies
    respond login search form pager pagination copyright toolbar skip complementary contentinfo
""".split())
#: Marks that, outside an article, also surround it.
OUTER = frozenset(("header",))
#: Marks of an article element that is a comment or a teaser, and words that name content.
NOT_ARTICLES = frozenset("comment comments reply replies respond related recommended ad ads advert promo sponsored teaser".split())
CONTENT = frozenset("content article post entry story main".split())
#: Marks that say who speaks; a paragraph of the article may be such a one.
VOICES = frozenset("comment comments reply replies respond related recommended".split())
#: Words beside a mark that only say what shape it has; any other word makes it a name.
SHAPES = frozenset("""
    area bar block body box button container content entry feed form group head header holder inner item items left
    link links list main md outer panel right row section site slot sm text title top unit wrap wrapper
""".split())
#: A text is part of a host's template if so many different pages at least have it at its
#: place, and this share of all that differ.
SEVERAL, SHARE = 3, 0.75
#: Containers whose fixed texts are labels of the values beside them.
LABELLED = re.compile(r"(^|>)(table|dl)[.>]|(^|>)(table|dl)$")
#: Longest group of tokens whose repetition is looked for.
PERIOD = 10
#: Token streams that are aligned in one task for one bucket of a host.
FAN = 64

_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
TAG = -1
#: A tag without a stray mark inside; it never backtracks.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/><"'=]*+)((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_SPACE = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): ``open`` with its attributes, ``close``, ``text``.

    Comments, declarations, scripts and styles are left out. Every search runs forward
    and a missing end is looked for once, so the time is linear.
    """
    at, n, missing = 0, len(page), set()

    def find(what: str, start: int) -> int:
        if what in missing:
            return -1
        found = page.find(what, start)
        if found < 0:
            missing.add(what)
        return found

    while at < n:
        less = find("<", at)
        if less < 0:
            yield "text", "", page[at:]
            return
        if less > at:
            yield "text", "", page[at:less]
        if (plain := _TAG.match(page, less)) and plain[2].lower() not in RAW:
            yield "close" if plain[1] else "open", plain[2].lower(), plain[3]
            at = plain.end()
            continue
        if page.startswith("<!--", less):
            end = find("-->", less + 4)
            at = n if end < 0 else end + 3
            continue
        name = _NAME.match(page, less + 1)
        if not name:
            if page[less + 1: less + 2] in ("!", "?"):
                end = find(">", less)
                at = n if end < 0 else end + 1
            else:
                yield "text", "", "<"
                at = less + 1
            continue
        end = find(">", name.end())
        while end >= 0:  # not one inside a quoted value
            part = page[name.end(): end]
            quote = next((q for q in "\"'" if part.count(q) % 2), None) if '"' in part or "'" in part else None
            if quote is None or (close := find(quote, end)) < 0:
                break
            end = find(">", close)
        if end < 0:
            end = n
        tag, rest = name[1].lower(), page[name.end(): end]
        at = end + 1
        if page[less + 1] == "/":
            yield "close", tag, ""
            continue
        yield "open", tag, rest
        if tag in RAW:
            ending = re.compile(f"</{tag}", re.I).search(page, at)
            at = ending.start() if ending else n


def _marks(rest: str) -> tuple[list[str], frozenset[str], bool]:
    """Words of class, id and role in lower case, those that may be marks, and whether the
    element is hidden."""
    words, names, hidden = [], [], False
    for name, a, b, c in _ATTRIBUTE.findall(rest) if "=" in rest or "hidden" in rest else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif name != "style":
            for one in value.split():
                found = [w.lower() for w in _WORD.findall(one)]
                words += found
                # A name such as ``comment-policy`` says more than the mark in it.
                if all(w in MARKS or w in OUTER or w in SHAPES or w.isdigit() for w in found):
                    names += found
    return words, frozenset(names), hidden


class Walk:
    """Follows the regions of a page while its tokens pass.

    ``path`` lists the open containers by label (element and words of its class); ``out``
    counts those whose text is not the article's. An article in a form that wraps the
    whole page starts from 0.
    """

    def __init__(self):
        self.stack: list[tuple[str, str, bool, int]] = []
        self.tags: dict[str, int] = {}
        self.out = self.links = self.articles = 0
        self.path = ""

    def open(self, tag: str, rest: str) -> str:
        words, own, hidden = _marks(rest) if rest else ((), frozenset(), False)
        if tag not in CONTAINERS and tag not in ("li", "dd", "tr", "td"):
            own = own - VOICES
        if tag == "a":
            self.links += 1
        if tag in ("main", "body", "html"):
            outside = hidden
        elif tag == "article":
            outside = hidden or bool(own & NOT_ARTICLES)
        else:
            outside = tag in NEVER or hidden or bool(own & MARKS) or not self.articles and (tag in OUTER or bool(own & OUTER))
        label = tag + "".join(f".{w}" for w in sorted(set(words)) if not w.isdigit())
        if tag in VOID:
            return label
        if tag in ("p", "li") and self.stack and self.stack[-1][0] == tag:
            self._pop()  # their end may be left out
        if tag in CONTAINERS or outside:
            before = self.out
            if tag in ("article", "main"):
                self.articles += 1
                if all(entry[1] == "form" for entry in self.stack if entry[2]):
                    self.out = 0
            self.stack.append((tag, label, outside, before))
            self.tags[tag] = self.tags.get(tag, 0) + 1
            self.out += outside
            self.path = f"{self.path}>{label}" if self.path else label
        return label

    def _pop(self) -> None:
        tag, label, _, self.out = self.stack.pop()
        self.tags[tag] -= 1
        if not self.tags[tag]:
            del self.tags[tag]
        self.articles -= tag in ("article", "main")
        self.path = self.path[: -len(label) - 1] if self.stack else ""

    def close(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in self.tags:
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()


def blocks(page: str) -> Iterator[tuple[str, int, int, str]]:
    """(path, out, link characters, text) of every block; of a tag, ``out`` is ``TAG``."""
    walk, text, linked = Walk(), [], 0

    def flush() -> tuple[int, str] | None:
        nonlocal linked
        if not text:
            return None
        body = " ".join(html.unescape("".join(text)).split())
        found = (linked, body) if body else None
        text.clear()
        linked = 0
        return found

    open_tags, paragraph = walk.tags, False
    for kind, tag, rest in tokens(page):
        if kind == "text":
            text.append(rest)
            if walk.links:
                linked += len(rest)
            continue
        ends = tag in BLOCKS or tag in NEVER
        if kind == "open":
            if not ends and not rest:
                if tag == "a":
                    walk.links += 1
                elif tag == "br":
                    text.append(" ")
                continue
            before = walk.path, walk.out
            label = walk.open(tag, rest)
            if ends or walk.path != before[0]:
                if body := flush():
                    yield *before, *body
                if paragraph and ends:
                    yield "", TAG, 0, "</p>"
                    paragraph = False
                if ends and tag not in VOID:
                    yield "", TAG, 0, f"<{label}>"
                    paragraph = tag == "p"
            elif tag == "br":
                text.append(" ")
        else:
            if ends or tag in open_tags:
                if body := flush():
                    yield walk.path, walk.out, *body
                if paragraph and ends:
                    yield "", TAG, 0, "</p>"
                    paragraph = False
                if ends and tag != "p":
                    yield "", TAG, 0, f"</{tag}>"
            walk.close(tag)
    if body := flush():
        yield walk.path, walk.out, *body


# A wrapper is a list of items: a tag; a slot ["#", path, characters, text]; a literal
# ["=", path, text] of the template; a group ["+", items], found once or more; ["?", [item]],
# an item that may be missing. Texts are digests; that of a slot is null where pages differ.

def _key(item) -> str:
    """The structure of an item as text: slots are alike whatever they hold."""
    if isinstance(item, str):
        return item
    if item[0] == "#":
        return f"#{item[1]}"
    if item[0] == "=":
        return f"={item[1]}={item[2]}"
    return f"{item[0]}({' '.join(map(_key, item[1]))})"


def _joined(a, b):
    """One item for two alike: slots add up and keep a text only if it is the same."""
    if isinstance(a, str) or a[0] == "=":
        return a
    if a[0] == "#":
        return ["#", a[1], a[2] + b[2], a[3] if a[3] == b[3] else None]
    return [a[0], _all_joined(a[1], b[1])]


def _all_joined(a: list, b: list) -> list:
    return [_joined(x, y) for x, y in zip(a, b)]


def folded(items: list) -> list:
    """Repetitions of up to ``PERIOD`` neighbouring items as groups, as they come to an end."""
    out: list = []
    keys: list[str] = []
    for item in items:
        out.append(item)
        keys.append(_key(item))
        again = True
        while again:
            again = False
            for p in range(1, min(PERIOD, len(out) - 1) + 1):
                tail = keys[-p:]
                if keys[-p - 1] == f"+({' '.join(tail)})":
                    group = ["+", _all_joined(out[-p - 1][1], out[-p:])]
                    cut = p + 1
                elif keys[-p - 1] == tail[-1] and 2 * p <= len(out) and keys[-2 * p: -p] == tail:
                    group = ["+", _all_joined(out[-2 * p: -p], out[-p:])]
                    cut = 2 * p
                else:
                    continue
                out[-cut:], keys[-cut:] = [group], [f"+({' '.join(tail)})"]
                again = True
                break
    return out


def digest(text: str) -> str:
    data = text.encode("utf-8", "replace")
    return f"{zlib.crc32(data)}.{len(data)}"


def token_stream(page: str | None) -> list:
    """The tags and slots of a page, one by one."""
    return [
        text if out == TAG else ["#", path, 0 if out else max(0, len(text) - linked), digest(text)]
        for path, out, linked, text in blocks(page or "")
    ]


def with_literals(items: list, literals: frozenset[str]) -> list:
    """A token stream in which texts of the host's template are told from slots, so that
    what repeats around them does not swallow them; repetitions folded."""
    return folded([
        ["=", x[1], x[3]] if not isinstance(x, str) and x[2] and f"{x[1]}={x[3]}" in literals else x for x in items
    ])


def stream(page: str | None) -> list:
    """The token stream of a page as a wrapper of its own, repetitions folded."""
    return folded(token_stream(page))


def _inner(item):
    return item[1][0] if isinstance(item, list) and item[0] == "?" else item


def _alike(a, b):
    """One item for two of the same structure, which may be missing if either may."""
    joined = _joined(_inner(a), _inner(b))
    return joined if _inner(a) is a and _inner(b) is b else ["?", [joined]]


def _optional(items: list) -> list:
    return [x if _inner(x) is not x else ["?", [x]] for x in items]


def _resolved(a: list, b: list) -> list:
    """A mismatch of two runs of items: a repeated group and one of its rounds are that group,
    two repeated groups are one of both, and all else may be found or not."""
    for one, other in ((a, b), (b, a)):
        for i, x in enumerate(one):
            group = _inner(x)
            if isinstance(group, str) or group[0] != "+":
                continue
            size, keys = len(group[1]), list(map(_key, group[1]))
            for k in range(len(other) - size + 1):
                if list(map(_key, other[k: k + size])) == keys:
                    both = ["+", _all_joined(group[1], other[k: k + size])]
                    return [
                        *_optional(one[:i] + other[:k]), both if group is x else ["?", [both]],
                        *_optional(one[i + 1:] + other[k + size:]),
                    ]
    groups = [next((i for i, x in enumerate(run) if _key(_inner(x)).startswith("+")), None) for run in (a, b)]
    if None not in groups:
        i, k = groups
        both = ["+", merged(_inner(a[i])[1], _inner(b[k])[1])]
        sure = _inner(a[i]) is a[i] and _inner(b[k]) is b[k]
        return [*_optional(a[:i] + b[:k]), both if sure else ["?", [both]], *_optional(a[i + 1:] + b[k + 1:])]
    return _optional(a) + _optional(b)


def merged(a: list, b: list) -> list:
    """The wrapper of all that two wrappers describe: their items are aligned, equal ones
    joined and mismatches resolved."""
    out: list = []
    keys = [[_key(_inner(x)) for x in run] for run in (a, b)]
    for what, i, j, k, m in SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        out += map(_alike, a[i:j], b[k:m]) if what == "equal" else _resolved(a[i:j], b[k:m])
    return folded(out)


def _slots(items: list) -> Iterator[list]:
    for item in items:
        if isinstance(item, list):
            if item[0] == "#":
                yield item
            elif item[0] != "=":
                yield from _slots(item[1])


def _within(path: str, region: str) -> bool:
    return not region or path == region or path.startswith(region + ">")


def main_region(wrapper: list, pages: int) -> str | None:
    """The path of the region that holds the article; null if there is no text.

    Text that all pages of a host share belongs to the template and does not count, unless
    there is one page. An article or main element comes first, then a container named like one,
    then the page. Of these, the one with most of the text; inside it, the innermost that
    holds all of that, so headlines and lead paragraphs beside an inner article stay.
    """
    for fixed in (pages > 1, False):
        volume: dict[str, int] = defaultdict(int)
        for _, path, size, text in _slots(wrapper):
            labels = path.split(">") if path else []
            for depth in range(len(labels) + 1):
                volume[">".join(labels[:depth])] += 0 if fixed and text is not None else size
        found = {path: v for path, v in volume.items() if v > 0}
        if found:
            break
    else:
        return None

    def last(path: str) -> list[str]:
        return path.rsplit(">", 1)[-1].split(".")

    kinds = (
        {p for p in found if last(p)[0] in ("article", "main") or "main" in last(p)[1:]},
        {p for p in found if set(last(p)[1:]) & CONTENT}, set(found),
    )
    own = next(k for k in kinds if k)
    best = min(own, key=lambda p: (-found[p], len(p), p))
    return max((p for p in own if _within(p, best) and found[p] == found[best]), key=lambda p: (len(p), p))


def text_of(page: str | None, region: str | None, literals: frozenset[str] = frozenset()) -> str:
    """The slots of the region, without the texts of the host's template.

    A page that has more text of its own outside the host's region than in it is built
    otherwise, and has a region of its own. Where template texts would be half of
    what is left or more, the page is one of many near copies, and keeps them.
    """
    found = [(path, text) for path, out, _, text in blocks(page or "") if out == 0]
    own = [(path, text, f"{path}={digest(text)}" in literals) for path, text in found] if literals else [(p, t, False) for p, t in found]

    def inside(where: str | None) -> list[tuple[str, bool]]:
        return [(t, fixed) for path, t, fixed in own if where is not None and _within(path, where)]

    def size(texts) -> int:
        return sum(len(t) for t, fixed in texts if not fixed)

    chosen = inside(region)
    if 2 * size(chosen) < size((t, fixed) for _, t, fixed in own) or not chosen:
        other = inside(main_region(stream(page), 1))
        chosen = other if size(other) > size(chosen) or not chosen else chosen
    if 2 * size(chosen) <= sum(len(t) for t, _ in chosen):
        return "\n\n".join(t for t, _ in chosen)
    return "\n\n".join(t for t, fixed in chosen if not fixed)


def template_texts(tokens_: DataFrame) -> DataFrame:
    """``host`` and ``literals``: the texts that a host's different pages share at one place.

    ``tokens_`` has a row per page: ``host``, ``anchor`` (its longest text) and ``places`` (path
    and digest of its texts, without those of tables and definition lists, where fixed
    texts are labels). Pages are told apart by their longest text, so copies of
    a page support nothing. Counted in two levels that combine map-side: a text that
    every page of a host has is spread over their anchors. A host has at most as many
    literals as ``SHARE`` of a page's texts allow.
    """
    pages = tokens_.select("host", "anchor").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    seen = tokens_.select("host", "anchor", F.explode("places").alias("place")).distinct()
    shared = seen.where("NOT endswith(place, anchor)").groupBy("host", "place").agg(F.count(F.lit(1)).alias("seen")).where(f"seen >= {SEVERAL}")
    return shared.join(pages, "host").where(f"seen >= {SHARE}D * n").groupBy("host").agg(
        F.sort_array(F.collect_list("place")).alias("literals")
    )


def wrappers(shapes: DataFrame) -> DataFrame:
    """``host``, ``wrapper`` (JSON) and ``n``, its pages; ``shapes`` has one row per page:
    ``host``, ``shape`` (JSON of the stream without what slots hold) and ``slots``.

    Pages of one shape are first combined by counts and extremes, map-side. Then different shapes
    are merged in rounds: at most some ``FAN`` of a host in a group, by hash, until each host
    has one wrapper. So a host of any size is spread, and every page counts.
    """
    sums = shapes.select("host", "shape", F.posexplode("slots").alias("at", "slot")).groupBy("host", "shape", "at").agg(
        F.sum("slot.size").alias("size"),
        F.when(F.min("slot.text") == F.max("slot.text"), F.min("slot.text")).alias("text"),
    ).groupBy("host", "shape").agg(F.array_sort(F.collect_list(F.struct("at", "size", "text"))).alias("slots"))
    counted = shapes.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"))
    filled = counted.join(sums, ["host", "shape"], "left").select("host", "n", _filled("shape", F.col("slots.size"), F.col("slots.text")).alias("wrapper"))
    current = stored(filled, "html_wrappers")
    largest = current.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    buckets = -(-largest // FAN)
    while largest > 1:
        bucket = F.pmod(F.xxhash64("wrapper"), F.lit(buckets)).alias("bucket")
        current = stored(
            current.select("host", "wrapper", "n", bucket).groupBy("host", "bucket")
            .applyInPandas(_merge_group, "host string, wrapper string, n long"), "html_wrappers",
        )
        if buckets == 1:
            break
        buckets = -(-buckets // FAN)
    return current


def _merge_group(group: pd.DataFrame) -> pd.DataFrame:
    rows = sorted(zip(group["wrapper"], group["n"]))
    wrapper = json.loads(rows[0][0])
    for text, _ in rows[1:]:
        wrapper = merged(wrapper, json.loads(text))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(wrapper)], "n": [sum(n for _, n in rows)]})


def _fill(items: list, values: Iterator[tuple]) -> list:
    return [
        x if isinstance(x, str) or x[0] == "=" else ["#", x[1], *next(values)] if x[0] == "#" else [x[0], _fill(x[1], values)]
        for x in items
    ]


def _bare(items: list) -> list:
    return [x if isinstance(x, str) or x[0] == "=" else x[:2] if x[0] == "#" else [x[0], _bare(x[1])] for x in items]


def _filled(shape: str, sizes, texts):
    @F.pandas_udf(T.StringType())
    def fill(shapes: pd.Series, sizes_: pd.Series, texts_: pd.Series) -> pd.Series:
        def one(shape_, size, text):
            values = iter(() if size is None else [(int(s), t) for s, t in zip(size, text)])
            return json.dumps(_fill(json.loads(shape_), values))
        return pd.Series([one(*x) for x in zip(shapes, sizes_, texts_)], dtype=object)
    return fill(shape, sizes, texts)


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    The host of a null or odd URL is empty, and such pages form a host. Null and empty
    pages have an empty text. Only digests, streams and wrappers are shuffled; a host's
    template texts and its region, one path, come back to its pages, by broadcast for hosts
    of more than a thousandth of all pages. Repeated rows and null ids are like any other.
    """
    hosted = with_host_and_path(pages.select("page_id", "url", "html")).drop("path")

    @F.pandas_udf("items string, anchor string, places array<string>")
    def read(htmls: pd.Series) -> pd.DataFrame:
        found = [token_stream(x) for x in htmls]
        slots = [[x for x in items if not isinstance(x, str) and x[2] and not LABELLED.search(x[1])] for items in found]
        return pd.DataFrame({
            "items": pd.Series([json.dumps(x) for x in found], dtype=object),
            "anchor": pd.Series([max(((x[2], x[3]) for x in s), default=(0, ""))[1] for s in slots], dtype=object),
            "places": pd.Series([sorted({f"{x[1]}={x[3]}" for x in s}) for s in slots], dtype=object),
        })

    read_once = stored(hosted.select("host", read("html").alias("s")).select("host", "s.*"), "html_tokens")
    total = read_once.count()
    sizes = read_once.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    texts = stored(sizes.join(template_texts(read_once.select("host", "anchor", "places")), "host", "left"), "html_literals")

    @F.pandas_udf("shape string, slots array<struct<size: long, text: string>>")
    def shape(items: pd.Series, literals: pd.Series) -> pd.DataFrame:
        streams = [with_literals(json.loads(x), frozenset(() if t is None else t)) for x, t in zip(items, literals)]
        return pd.DataFrame({
            "shape": pd.Series([json.dumps(_bare(x)) for x in streams], dtype=object),
            "slots": pd.Series([[{"size": s[2], "text": s[3]} for s in _slots(x)] for x in streams], dtype=object),
        })

    told = split_join(read_once.select("host", "items"), texts, "host", total, bound=1000)
    shapes = stored(told.select("host", shape("items", "literals").alias("s")).select("host", "s.*"), "html_shapes")

    @F.pandas_udf(T.StringType())
    def region(texts: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([main_region(json.loads(w), n) for w, n in zip(texts, counts)], dtype=object)

    regions = stored(
        wrappers(shapes).select("host", "n", region("wrapper", "n").alias("region")).join(texts.drop("n"), "host", "left"),
        "html_regions",
    )

    @F.pandas_udf(T.StringType())
    def extract(htmls: pd.Series, regions_: pd.Series, literals: pd.Series) -> pd.Series:
        return pd.Series([
            text_of(h, r, frozenset(() if t is None else t)) for h, r, t in zip(htmls, regions_, literals)
        ], dtype=object)

    placed = split_join(hosted, regions, "host", total, bound=1000)
    return placed.select("page_id", "url", extract("html", "region", "literals").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )

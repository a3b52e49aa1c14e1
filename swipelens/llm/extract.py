"""Main text of web pages by the maximum-scoring subsequence of their words and tags.

A page is read as a sequence of words and tags. Words score positive and tags negative; one
linear scan finds the contiguous run with the largest sum, the content region. The weights are
log ratios of how often a word or tag stands inside and outside the content of labelled pages,
counted over what is scored: dropped elements are gaps, inline tags are neutral.
Labelled are the pages whose own markup names their content: exactly one ``article`` or
``main`` element. At most ``LABELLED_PAGES`` of them are counted, chosen by a hash of the page.

Names are evidence as well. For every tag with a class, id or role word the labelled pages tell
how many words it holds inside and outside the content; where most are outside, words of such an
element score negative on every page, listed name or not. Where a page marks its content and most
of its words are in there, the words around it score negative too. The scan decides on both.

Elements that are no content by their kind or name (menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) never give text, inside the region
or outside it. Inside an ``article`` or ``main`` only adverts, reader comments and share bars go
by their name, and only if it says nothing else. Elements that hold an ``article`` or ``main``
are not dropped for a name of the layout, and an advert or anything left open ends where the
content begins. Menus, sidebars and groups of comments or related pages that hold articles of
their own stay out as long as there is other content. On a page without marked content, a form or
an element whose name says more than a listed word stays if it holds most of the page's words:
it wraps the page. Quotes delimit a value directly after ``=`` only.

Character references are decoded; white space inside a block becomes one space; blocks are
trimmed and joined by one space, in page order. Whole pages are read.

Edge cases: a null or blank page, or one without content, gives the empty text and 0. Plain
text is a page of one block. Comments, tags and raw elements without an end reach to the end
of the page. Repeated rows give repeated results; an empty table gives an empty result. Further
columns pass through; input columns named like a result column are replaced.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import ship, whole

LABELLED_PAGES = 2000
#: Larger pages are not used as labelled ones, so that the sample stays within memory.
LABELLED_BYTES = 1 << 16
#: A name is evidence if so many labelled pages have words in it; the names most pages have are learned.
NAME_PAGES = 3
LEARNED_NAMES = 10_000

# Names of HTML elements and of what pages are made of besides content.
RAW = frozenset("script style noscript template iframe svg textarea select object canvas annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
DROPPED = frozenset("head nav footer aside form button dialog menu".split())
CONTENT = frozenset(["article", "main"])
#: Instead of the tags of a dropped element.
GAP, OUT = "#gap", "#out"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr math".split()
)
NOT_CONTENT = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus discussion footer gdpr masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pagination popup promo promotion related replies reply respond share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
ADVERTS = frozenset("ad ads advert adverts advertisement advertising".split())
#: Groups whose items are often marked up as articles of their own.
GROUPS = frozenset("comment comments disqus related replies reply respond".split())
#: Inside the content a name counts if it has one of these words, and else only words of PLACES.
NAMES_INSIDE = frozenset(
    "ad ads adsbygoogle advert adverts advertisement comment comments consent cookie cookies disqus newsletter share "
    "sharing sidebar subscribe".split()
)
PLACES = frozenset(
    "area article banner bar block body bottom box buttons container count entry form group holder inline inner left "
    "links list notice outer page panel post right row section signup slot social thread tools top unit widget wrap "
    "wrapper".split()
)
CONTAINERS = frozenset("div section aside ul ol dl table figure footer header nav center details fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MATH = frozenset(
    "maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
KNOWN_TAGS = frozenset(
    "a article aside b blockquote body br button code dd div dl dt em figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html i img input label li link main meta nav ol p pre section small span strong sub sup table tbody td "
    "th thead title tr u ul".split()
)
#: Bounds of the learned weights: a word always adds, a tag always costs.
WORD_BOUNDS = (0.2, 3.0)
TAG_BOUNDS = (-3.0, -0.02)
#: A known tag that no labelled page shows where text is scored: less than a word for both its tags.
UNSEEN = -0.05

RESULTS = ["text", "n_chars"]

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: The rest of a tag. A quote without a partner is an ordinary character.
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Weights:
    """Score of a word, and of the tags by name; other tags cost ``other``. A word in an element
    whose name speaks against content has the score in ``names``."""

    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)
    other: float = -1.0
    names: dict[str, float] = field(default_factory=dict)

    def of(self, tag: str) -> float:
        """Inline tags are neutral. A script or a gap says nothing about the text around it, so it costs the least."""
        if tag in INLINE or tag in MATH:
            return 0.0
        return TAG_BOUNDS[1] if tag in RAW or tag == GAP else self.tags.get(kind_of(tag), self.other)

    @classmethod
    def of_counts(cls, inside: dict[str, int], outside: dict[str, int]) -> "Weights":
        """Log ratios of the shares. Words are counted as "#". One more count of each kind is
        spread over inside and outside as all counts are, so that a rare kind is near neutral."""
        total_in, total_out = sum(inside.values()), sum(outside.values())
        if not total_in or not total_out:
            return cls()
        part = total_in / (total_in + total_out)

        def ratio(kind: str, bounds: tuple[float, float]) -> float:
            score = math.log((inside.get(kind, 0) + part) / total_in)
            score -= math.log((outside.get(kind, 0) + 1 - part) / total_out)
            return min(max(score, bounds[0]), bounds[1])

        seen = (set(inside) | set(outside)) - {"#"}
        tags = {**dict.fromkeys(KNOWN_TAGS, UNSEEN), **{k: ratio(k, TAG_BOUNDS) for k in seen}}
        return cls(ratio("#", WORD_BOUNDS), dict(sorted(tags.items())), tags.get("other", UNSEEN))


def name_scores(inside: dict[str, int], outside: dict[str, int]) -> dict[str, float]:
    """Log ratios of the words in elements of a name; only names that hold more words outside."""
    scores = {n: math.log((inside.get(n, 0) + 0.5) / (outside[n] + 0.5)) for n in sorted(outside)}
    return {n: max(score, TAG_BOUNDS[0]) for n, score in scores.items() if score < 0}


def tokens(page: str) -> Iterator[tuple[str, bool, str]]:
    """(kind, closing, rest): kind "" is text; otherwise a lower-case tag with its attributes."""
    at, size = 0, len(page)
    while at < size:
        hit = _OPEN.search(page, at)
        if hit is None:
            yield "", False, page[at:]
            return
        if hit.start() > at:
            yield "", False, page[at:hit.start()]
        comment, other, slash, name = hit.groups()
        if comment:
            end = page.find("-->", hit.end())
            at = size if end < 0 else end + 3
            continue
        if other:
            end = page.find(">", hit.end())
            at = size if end < 0 else end + 1
            continue
        rest = _REST.match(page, hit.end())
        if rest is None:
            return
        end = rest.end()
        name = name.lower()
        yield name, bool(slash), page[hit.end():end - 1]
        at = end
        if name in RAW and not slash and not page[end - 2:end - 1] == "/":
            close = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
            if close is None:
                return
            at = close.start()


#: Why an element is dropped: by its kind or as a group of its own, as an advert, by a name of the layout,
#: or as a form or by a name that says more than that.
KIND, ADVERT, LAYOUT, UNCLEAR = 1, 2, 3, 4


def _words_of(name: str, attributes: str) -> Iterator[str]:
    """The words of class, id and role. The id of a heading is an anchor, not a name."""
    for attribute, *groups in _NAMES.findall(attributes):
        if attribute.lower() != "id" or name not in HEADINGS:
            yield from "".join(groups).replace("_", "-").split()


def _names_outside(name: str, attributes: str) -> set[str]:
    """Words of NOT_CONTENT that are a part of a name."""
    if name in CONTENT or name in ("html", "body"):
        return set()
    parts = (p.lower() for w in _words_of(name, attributes) for p in (*w.split("-"), *_PARTS.findall(w)))
    return NOT_CONTENT.intersection(parts)


def _said(word: str) -> set[str]:
    parts = [p.lower() for p in (word.split("-") if word == word.lower() else _PARTS.findall(word))]
    return {p for p in parts if p and not p.isdigit()}


def _names_inside(name: str, attributes: str) -> set[str]:
    """Words of NAMES_INSIDE in names that say nothing else."""
    found = set()
    if name in CONTAINERS:
        for said in map(_said, _words_of(name, attributes)):
            if said <= NAMES_INSIDE | PLACES:
                found |= said & NAMES_INSIDE
    return found


def _clear(name: str, attributes: str) -> bool:
    """Whether one of the names says that the element is no content, and nothing else."""
    words = map(_said, _words_of(name, attributes))
    return any(said & NOT_CONTENT and said <= NOT_CONTENT | PLACES for said in words)


def _evidence(name: str, attributes: str) -> tuple[str, ...]:
    """The keys under which the names of an element are learned."""
    return tuple({f"{name}.{word.lower()}" for word in _words_of(name, attributes)})


def _reason(name: str, attributes: str, inside: bool) -> int:
    """0 if the element is not dropped."""
    if name in DROPPED or (name == "header" and not inside):
        return UNCLEAR if name == "form" else KIND
    if inside and any(a.lower() == "role" and "navigation" in g for a, *g in _NAMES.findall(attributes)):
        return KIND
    names = (_names_inside if inside else _names_outside)(name, attributes)
    if not names:
        return 0
    if names & GROUPS:
        return KIND
    if inside or names & ADVERTS:
        return ADVERT
    return LAYOUT if _clear(name, attributes) else UNCLEAR


@dataclass(slots=True, eq=False)
class _Element:
    name: str
    parent: "_Element | None"
    reason: int
    #: The innermost article or main around, if no dropped element is between.
    shown: "_Element | None" = None
    inside: bool = False
    closed: bool = False
    holds: bool = False
    has_text: bool = False
    #: Stands in a group that is closed by its own end.
    grouped: bool = False
    drop: bool = False
    #: Dropped only up to the first article or main in it.
    ends: bool = False
    names: tuple[str, ...] = ()


def _keep_wrappers(found: list[tuple[str, bool, str]], opened: dict[int, _Element], owners: dict[int, _Element]) -> None:
    """Elements dropped for an unclear reason stay if they hold most words of those not dropped otherwise."""
    hidden: dict[_Element, bool] = {}
    words: Counter = Counter()
    for one in opened.values():
        hidden[one] = one.reason in (KIND, ADVERT, LAYOUT) or (one.parent is not None and hidden[one.parent])
    total = 0
    for at, (name, _, rest) in enumerate(found):
        one = owners.get(at)
        if not name and not (one is not None and hidden[one]):
            total += (n := len(rest.split()))
            if one is not None:
                words[one] += n
    for one in reversed(opened.values()):
        if one.parent is not None:
            words[one.parent] += words[one]
        if one.reason == UNCLEAR and 2 * words[one] > total:
            one.drop = False


def _elements(
    found: list[tuple[str, bool, str]],
) -> tuple[dict[int, _Element], dict[int, list[_Element]], dict[int, _Element]]:
    """The elements by the position of their first tag, those that end at a position, and the
    innermost ones around the texts.

    The end of an element ends those that were opened inside it; an end without a beginning is
    ignored. An open paragraph ends where the next block begins.
    """
    opened: dict[int, _Element] = {}
    ended: dict[int, list[_Element]] = {}
    owners: dict[int, _Element] = {}
    stack: list[_Element] = []
    names: Counter = Counter()
    for at, (name, closing, rest) in enumerate(found):
        if not name:
            if stack:
                owners[at] = stack[-1]
                if stack[-1].shown and not rest.isspace():
                    stack[-1].shown.has_text = True
        elif closing:
            gone = ended[at] = []
            while names[name]:
                gone.append(stack.pop())
                names[gone[-1].name] -= 1
                if gone[-1].name == name:
                    gone[-1].closed = True
                    break
        elif name not in VOID and name not in RAW and not rest.endswith("/"):
            if name not in INLINE and stack and stack[-1].name == "p":
                ended[at] = [stack.pop()]
                names["p"] -= 1
                ended[at][0].closed = True
            parent = stack[-1] if stack else None
            inside = parent is not None and (parent.inside or parent.name in CONTENT)
            one = opened[at] = _Element(name, parent, _reason(name, rest, inside), inside=inside, names=_evidence(name, rest))
            if name in CONTENT:
                one.shown = one
                around = parent
                while around is not None and not around.holds:
                    around.holds = True
                    around = around.parent
            elif not one.reason and parent is not None:
                one.shown = parent.shown
            stack.append(one)
            names[name] += 1
    for one in opened.values():
        one.grouped = (one.parent is not None and one.parent.grouped) or (one.reason == KIND and one.closed)
    other = any(one.has_text and not one.grouped for one in opened.values())
    for one in opened.values():
        one.drop = bool(one.reason)
        if one.holds:
            one.drop = bool(one.reason) and not (one.reason in (LAYOUT, UNCLEAR) and one.closed)
            one.ends = not (one.reason == KIND and one.closed and other)
    reasons = {one.reason for one in opened.values()}
    if UNCLEAR in reasons and not any(one.name in CONTENT for one in opened.values()):
        _keep_wrappers(found, opened, owners)
    return opened, ended, owners


def items(page: str) -> Iterator[tuple[str, str, bool, _Element | None]]:
    """(tag, text, in_content, around): the tags, and the texts that may be content with the
    innermost elements around them, in page order.

    An element that is no content is given as its two ends alone, named ``GAP`` inside the
    content and ``OUT`` elsewhere.
    """
    found = list(tokens(page))
    opened, ended, owners = _elements(found)
    dropped: list[_Element] = []
    content = 0
    for at, (name, closing, rest) in enumerate(found):
        if not name:
            if not dropped:
                yield "", rest, content > 0, owners.get(at)
            continue
        hidden, gap = bool(dropped), GAP if content else OUT
        for one in ended.get(at, ()):
            content -= one.name in CONTENT
            if dropped and dropped[-1] is one:
                dropped.pop()
        one = opened.get(at)
        if one is not None:
            if name in CONTENT:
                dropped = [d for d in dropped if not d.ends]
            elif name == "body":
                # An unfinished head, menu or page header does not reach into the page.
                dropped = [d for d in dropped if d.closed or d.name not in ("head", "nav", "header")]
            if one.drop:
                dropped.append(one)
            content += name in CONTENT
        if not (hidden and dropped):
            yield gap if (hidden or dropped) and name not in CONTENT else name, "", content > 0, None


def kind_of(name: str) -> str:
    return name if name in KNOWN_TAGS or name == OUT else "other"


def count_kinds(page: str) -> tuple[Counter, Counter] | None:
    """Words ("#") and tags inside and outside the content of a labelled page, as they are scored."""
    inside, outside, regions = Counter(), Counter(), 0
    was_inside = False
    for name, text, in_content, _ in items(page):
        regions += in_content and not was_inside
        was_inside = in_content
        if not name:
            (inside if in_content else outside)["#"] += len(text.split())
        elif not (name in INLINE or name in MATH or name in RAW or name == GAP):
            (inside if in_content else outside)[kind_of(name)] += 1
    return (inside, outside) if regions == 1 else None


def count_names(page: str) -> tuple[Counter, Counter]:
    """Words in the elements of each name, inside and outside the content."""
    counted: dict[_Element | None, list[int]] = {}
    for name, text, in_content, around in items(page):
        if not name:
            counted.setdefault(around, [0, 0])[not in_content] += len(text.split())
    names: dict[_Element | None, frozenset[str]] = {None: frozenset()}
    inside, outside = Counter(), Counter()
    for one, (within, beyond) in counted.items():
        path = []
        while one not in names:
            path.append(one)
            one = one.parent
        found = names[one]
        for one in reversed(path):
            found = names[one] = found.union(one.names) if one.names else found
        for key in found:
            inside[key] += within
            outside[key] += beyond
    return inside, outside


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest sum; empty if no sum is positive."""
    best, low, high, run, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, low, high = run, start, i + 1
    return low, high


def region_scores(found: list[tuple[str, str, bool, _Element | None]], weights: Weights) -> list[float]:
    """What each item adds to the region it is in."""
    sizes = [0 if name else len(text.split()) for name, text, _, _ in found]
    inside = sum(size for size, one in zip(sizes, found) if one[2])
    marked = inside > 0 and 2 * inside >= sum(sizes)
    known: dict[_Element, float] = {}
    scores = []
    for size, (name, _, in_content, around) in zip(sizes, found):
        if name:
            scores.append(weights.of(name))
        elif in_content:
            scores.append(weights.word * size)
        else:
            score = -weights.word if marked else weights.word
            scores.append(min(score, _against(around, weights.names, known)) * size)
    return scores


def _against(around: _Element | None, names: dict[str, float], known: dict[_Element, float]) -> float:
    """The strongest evidence of the names around a text; infinite if there is none."""
    path = []
    while around is not None and around not in known:
        path.append(around)
        around = around.parent
    least = math.inf if around is None else known[around]
    for one in reversed(path):
        least = known[one] = min(least, *(names.get(n, math.inf) for n in one.names), math.inf)
    return least


def main_text(page: str, weights: Weights) -> str:
    found = list(items(page))
    low, high = best_region(region_scores(found, weights))
    blocks: list[str] = []
    open_block: list[str] = []
    for name, text, *_ in found[low:high]:
        if not name:
            open_block.append(references.unescape(text))
        elif name not in INLINE:
            blocks.append("".join(open_block))
            open_block = []
    blocks.append("".join(open_block))
    return " ".join(" ".join(block.split()) for block in blocks if block.strip())


def fit(pages: DataFrame, html: str = "html", limit: int = LABELLED_PAGES) -> Weights:
    """Count words and tags of the labelled pages. One row per tag name and ``LEARNED_NAMES`` more reach the driver."""
    ship(pages.sparkSession)
    text = F.lower(F.col(html))
    labelled = pages.where(F.octet_length(html) <= LABELLED_BYTES).where(
        text.contains("<article") | text.contains("<main")
    ).select(F.xxhash64(html).alias("h"), F.col(html).alias("page"))
    # A share of the hashes that leaves a little less than the limit; only what is left is sorted.
    share = (1 << 40) * limit * 9 // (10 * max(1, labelled.count()))
    labelled = labelled.where(F.pmod("h", F.lit(1 << 40)) < share).orderBy("h", "page").limit(limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Tags are counted under their own names, the words of named elements under "tag.name".
            inside, outside, seen = Counter(), Counter(), Counter()
            for page in batch["page"]:
                counted = count_kinds(page)
                if counted:
                    for of_page in (counted, count_names(page)):
                        inside.update(of_page[0])
                        outside.update(of_page[1])
                        seen.update(of_page[0].keys() | of_page[1].keys())
            kinds = sorted(seen)
            if kinds:
                columns = {"i": inside, "o": outside, "n": seen}
                yield pd.DataFrame({"kind": kinds, **{c: [of[k] for k in kinds] for c, of in columns.items()}})

    counts = (
        labelled.repartition(8, "h").select("page").mapInPandas(run, "kind STRING, i BIGINT, o BIGINT, n BIGINT")
        .groupBy("kind").agg(F.sum("i").alias("i"), F.sum("o").alias("o"), F.sum("n").alias("n"))
    )
    named = F.col("kind").contains(".")
    most = F.when(named, F.col("n")).otherwise(F.lit(1 << 62))
    rows = (
        counts.where(~named | ((F.col("o") > F.col("i")) & (F.col("n") >= NAME_PAGES)))
        .orderBy(most.desc(), "kind").limit(LEARNED_NAMES + len(KNOWN_TAGS) + 3).collect()
    )
    tags = [r for r in rows if "." not in r["kind"]]
    weights = Weights.of_counts({r["kind"]: r["i"] for r in tags}, {r["kind"]: r["o"] for r in tags})
    names = [r for r in rows if "." in r["kind"]]
    weights.names = name_scores({r["kind"]: r["i"] for r in names}, {r["kind"]: r["o"] for r in names})
    return weights


def extract(pages: DataFrame, html: str = "html", weights: Weights | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars``; the page itself is not returned. No shuffle."""
    ship(pages.sparkSession)
    chosen = weights or fit(pages, html)

    @F.pandas_udf("string")
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, chosen) for page in batch], dtype=object)

    kept = [c for c in pages.columns if c not in (*RESULTS, html)]
    found = pages.select(*kept, of(whole(html)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))

"""Main text of HTML pages by tag-path ratios.

A page is read into elements and text leaves; each leaf has its root-to-leaf tag path
(formatting tags left out, classes kept). Per path, text length and punctuation
are summed and divided by the number of leaves; the two ratios are put back in
page order, smoothed with a Gaussian window, fused (product of the two, each over its mean),
and a path is content if its fused value is over a threshold that depends on the
values' deviation. Elements that by tag or name are menus, headers,
footers, sidebars, notices, adverts, forms (unless they hold an article or most of the
text) or reader comments never count. The
content paths name the smallest element that holds all their text (if that is the
body: nearly all), and all of its leaves outside such elements are the main text,
short paragraphs and headings included, as are all leaves of content paths elsewhere.

Output: a block's white space becomes one space, blocks are trimmed and joined in
page order by one line feed. Character references are decoded; nothing is capped.

Defined cases. Null, empty and text-free pages give the empty text. Unclosed and
stray tags are repaired as browsers do in the common cases; a page cut off in
the middle gives what it has. Repeated rows give repeated results; extra columns
may have any name; an empty table gives an empty result.

Scale: no shuffle; a task holds one batch of pages. A page's time grows with its length, however
deep its elements lie and whatever stays unclosed.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, no_gc, table
from tessera.llm.registry import query

RAW_TO_END = {"script", "style", "textarea", "title"}  # without an end, these take the rest of the page
RAW = {"script", "style", "noscript", "template", "iframe", "object", "textarea", "title", "svg", "math", "canvas"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section select
    summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LEAF_BLOCKS = HEADINGS | set("p li dt dd td th pre blockquote figcaption caption tr ul ol table dl".split())
#: may wrap a whole page; count as the ones below unless they hold an article or most text
WRAPPERS = {"form", "fieldset"}
#: elements that never hold main text, and names (of classes and ids) that say the same
BOILER_TAGS = set("nav footer aside button select option dialog menu search head input label".split())
BOILER_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
BOILER_NAMES = set("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline consent
    cookie cookies copyright dialog disclaimer footer footnav gdpr header hero login masthead menu modal nav navbar
    navigation navi newsletter notice notification notifications overlay pager pagination paywall popup promo
    promoted promotion recommended related share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription tags teaser toolbar widget widgets""".split())
COMMENT_NAMES = set("comment comments commentlist disqus discussion replies reply respond responses".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
NAME_END = re.compile(r"[\s/>]")
QUOTE_OR_END = re.compile(r"""[>"']""")
ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?¿¡…،。，、；：！？]")
SMOOTH = 1.0
LAMBDA = 0.5
HOLDS = 0.7


class Element:
    __slots__ = ("tag", "parent", "step", "boiler", "suspect", "wrapper", "article", "depth", "at", "last",
                 "text", "holds", "out", "bad", "in_header", "path", "weight", "blocks")

    def __init__(self, tag: str, parent: Element | None, step: str, boiler: bool, suspect: bool):
        self.tag, self.parent, self.step, self.boiler, self.suspect = tag, parent, step, boiler, suspect
        self.wrapper = tag in WRAPPERS
        #: the nearest article, or else main, that it lies in or is
        self.article = self if tag in ("article", "main") else parent.article if parent is not None else None
        self.depth = 1 if parent is None else parent.depth + 1
        self.at = self.last = -1  # its place among the elements with text, and that of the last one inside it
        self.text = self.weight = self.blocks = 0
        self.holds = self.out = self.bad = self.in_header = False
        self.path = -1

    def chain(self):
        e: Element | None = self
        while e is not None:
            yield e
            e = e.parent

    def inside(self, box: Element) -> bool:
        return box.at <= self.at <= box.last


class Tags:
    """The tags of a page, found in one pass: whatever a search has gone over without
    a result is not gone over again."""

    def __init__(self, page: str):
        self.page = page
        self.name_end = self.special = (-1, -1)  # (from, the next one found from there)
        self.ends: dict[int, int] = {}  # quote or end outside quotes -> the tag's end, or -1
        self.open_end = page.rfind(">")

    def _next(self, pattern: re.Pattern, pos: int, last: tuple[int, int]) -> tuple[int, int]:
        if last[0] <= pos <= last[1]:
            return pos, last[1]
        m = pattern.search(self.page, pos)
        return pos, m.start() if m else len(self.page)

    def _end(self, pos: int) -> int:
        """Where the tag ends whose attributes begin at ``pos``: after the first > outside
        quotes; -1 if there is none or a quote stays open."""
        self.special = self._next(QUOTE_OR_END, pos, self.special)
        at, path, end = self.special[1], [], -1
        while at < len(self.page):
            if at in self.ends:
                end = self.ends[at]
                break
            path.append(at)
            if self.page[at] == ">":
                end = at + 1
                break
            close = self.page.find(self.page[at], at + 1)
            if close < 0:
                break
            m = QUOTE_OR_END.search(self.page, close + 1)
            if m is None:
                break
            at = m.start()
        self.ends.update(dict.fromkeys(path, end))
        return end

    def next(self, pos: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, attributes) of the first tag from ``pos`` on; the
        name of a comment or declaration is empty."""
        page = self.page
        while True:
            at = page.find("<", pos)
            if at < 0:
                return None
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, "", "", ""
            if at > self.open_end:  # nothing closes a tag any more, but a comment may be open
                at = page.find("<!--", at)
                return None if at < 0 else (at, len(page), "", "", "")
            if page.startswith(("<!", "<?"), at):
                return at, page.find(">", at) + 1, "", "", ""
            if page[at + 1:at + 2].isascii() and (page[at + 1:at + 2].isalpha() or page[at + 1:at + 2] == "/"):
                start = at + 2 if page[at + 1] == "/" else at + 1
                first = page[start:start + 1]
                if first.isascii() and first.isalpha():
                    self.name_end = self._next(NAME_END, start, self.name_end)
                    stop = self.name_end[1]
                    end = self._end(stop)
                    if end < 0 and (m := QUOTE_OR_END.search(page, start, stop)):  # a quote in the name opens a value
                        stop = m.start()
                        end = self._end(stop)
                    if end >= 0:
                        return at, end, page[at + 1:start], page[start:stop], page[stop:end - 1]
            pos = at + 1


def _element(tag: str, attrs: str, parent: Element | None) -> Element:
    a = {k.lower(): v.strip("\"'") for k, v in ATTR.findall(attrs)} if attrs.strip(" /") else {}
    words = {w.lower() for k in ("class", "id") for w in NAME_WORD.findall(a.get(k, ""))}
    inside = parent is not None and parent.article is not None
    boiler = tag in BOILER_TAGS or a.get("role") in BOILER_ROLES or "hidden" in a or a.get("aria-hidden") == "true" \
        or "display:none" in a.get("style", "").replace(" ", "").lower() or tag == "header" and not inside
    suspect = tag not in ("html", "body", "article", "main") and bool(words & (BOILER_NAMES | COMMENT_NAMES))
    if words & COMMENT_NAMES and tag not in ("html", "body", "main"):
        boiler = boiler or not words & {"count", "open", "enabled"}
    name = ".".join(sorted(words)[:3])
    return Element(tag, parent, f"{tag}.{name}" if name else tag, boiler, suspect)


def leaves_of(page: str) -> list[tuple[Element, str, bool]]:
    """The page's blocks of text in order: (block element, text, starts anew)."""
    out: list[list] = []
    root = Element("html", None, "html", False, False)
    here, block, pos, fresh_block = root, root, 0, True
    endless: set[str] = set()  # raw tags with no end in the rest of the page
    open_inline: list[tuple[str, bool]] = []  # inline tags inside the block, and whether they hide their text
    inline: Counter[str] = Counter()  # how many of each are open
    hiding = 0
    open_blocks: Counter[str] = Counter()  # tags from the root to ``here``
    near: dict[tuple[int, str], Element] = {}

    def put(raw: str) -> None:
        nonlocal fresh_block
        if raw and not hiding:
            if fresh_block or not out or out[-1][0] is not here:
                out.append([here, [raw]])
                fresh_block = False
            else:
                out[-1][1].append(raw)

    def leave(upto: Element) -> None:
        """Close the open elements down from ``here`` until ``upto`` is the innermost."""
        nonlocal here
        while here is not upto:
            open_blocks[here.tag] -= 1
            here = here.parent

    def clear_inline() -> None:
        nonlocal hiding
        open_inline.clear()
        inline.clear()
        hiding = 0

    def item_of(e: Element, tag: str) -> Element:
        """The nearest element from ``e`` up that ``tag`` ends or that stops the search."""
        ends, stop = CLOSES[tag]
        seen = []
        while e is not root and e.tag not in stop and e.tag not in ends and (id(e), tag) not in near:
            seen.append((id(e), tag))
            e = e.parent
        e = near.get((id(e), tag), e)
        near.update(dict.fromkeys(seen, e))
        return e

    tags = Tags(page)
    elements = [root]  # kept alive: ``near`` names them by id
    while (found := tags.next(pos)) is not None:
        start, after, closing, tag, attrs = found
        put(page[pos:start])
        pos, tag = after, tag.lower()
        if not tag:
            continue
        if closing:
            if tag in BLOCKS or tag == "head":
                if open_blocks[tag] > 0:
                    e = here
                    while e.tag != tag:
                        e = e.parent
                    leave(e.parent)
                    fresh_block = True
                    clear_inline()
            elif inline[tag] > 0:
                while True:
                    name, hides = open_inline.pop()
                    inline[name] -= 1
                    hiding -= hides
                    if name == tag:
                        break
            continue
        if tag in RAW:
            end = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            if end is None and tag not in RAW_TO_END:
                endless.add(tag)
            elif not attrs.rstrip().endswith("/") or tag in RAW_TO_END:
                pos = end.end() if end else len(page)
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in ("html", "body") and here is root:
            if tag == "body":
                here = _element(tag, attrs, root)
                here.boiler = False
                elements.append(here)
                open_blocks[tag] += 1
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag not in BLOCKS and tag != "head":
            hides = _element(tag, attrs, None).boiler if attrs or tag in BOILER_TAGS else False
            open_inline.append((tag, hides))
            inline[tag] += 1
            hiding += hides
            continue
        fresh_block = True
        clear_inline()
        if tag != "head":  # a block ends an open paragraph or heading; items end their like
            ends, stop = CLOSES.get(tag, (set(), set()))
            while here is not root and here.tag not in stop and (
                    here.tag in ends or here.tag == "p" or here.tag in HEADINGS and tag in HEADINGS or here.tag == "head"):
                leave(here.parent)
            if ends:
                f = item_of(here, tag)
                if f.tag in ends:
                    leave(f.parent)
        if tag != "hr":
            here = _element(tag, attrs, here)
            elements.append(here)
            open_blocks[tag] += 1
    put(page[pos:].split("<")[0] if "<" in page[pos:] and ">" not in page[pos:] else page[pos:])
    done = []
    for e, parts in out:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            done.append((e, text))
    return done


def path_scores(paths: list, lengths: list[int], marks: list[int]) -> list[float]:
    """Fused value of each leaf: the smoothed ratios of its path."""
    total: dict = {}
    for p, n, k in zip(paths, lengths, marks):
        t = total.setdefault(p, [0, 0, 0])
        t[0] += n
        t[1] += k
        t[2] += 1
    text = [total[p][0] / total[p][2] for p in paths]
    punct = [total[p][1] / total[p][2] for p in paths]
    reach = max(1, round(3 * SMOOTH))
    kernel = [math.exp(-(d * d) / (2 * SMOOTH * SMOOTH)) for d in range(-reach, reach + 1)]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i in range(len(x)):
            lo, hi = max(0, i - reach), min(len(x), i + reach + 1)
            k = kernel[lo - i + reach:hi - i + reach]
            out.append(sum(a * b for a, b in zip(x[lo:hi], k)) / sum(k))
        return out

    mean = lambda x: sum(x) / len(x) or 1.0
    a, b = smooth(text), smooth(punct)
    ma, mb = mean(a), mean(b)
    fused = [(x / ma) * (y / mb) for x, y in zip(a, b)]
    of_path: dict = {}
    for p, f in zip(paths, fused):
        of_path.setdefault(p, []).append(f)
    value = {p: mean(f) if sum(f) else 0.0 for p, f in of_path.items()}
    return [value[p] for p in paths]


def elements_of(leaves: list[tuple[Element, str]]) -> list[Element]:
    """The elements that hold the leaves, each before those inside it, numbered."""
    out = []
    for e, _ in leaves:
        new = []
        while e is not None and e.at < 0:
            e.at = 0
            new.append(e)
            e = e.parent
        for x in reversed(new):
            x.at = x.last = len(out)
            out.append(x)
    # in depth-first order, so that an element's own are those from ``at`` to ``last``
    kids: dict[int, list[Element]] = {}
    for x in out[1:]:
        kids.setdefault(id(x.parent), []).append(x)
    order, todo = [], out[:1]
    while todo:
        x = todo.pop()
        x.at = x.last = len(order)
        order.append(x)
        todo.extend(reversed(kids.get(id(x), ())))
    for x in reversed(order):
        if x.parent is not None:
            x.parent.last = max(x.parent.last, x.last)
    return order


def _upwards(elements: list[Element], name: str) -> None:
    """Add a number of each element to those around it."""
    for x in reversed(elements):
        if x.parent is not None:
            setattr(x.parent, name, getattr(x.parent, name) + getattr(x, name))


def main_text(page: str | None) -> str:
    """The main text of one page."""
    leaves = leaves_of(page or "")
    if not leaves:
        return ""
    elements = elements_of(leaves)
    lengths = [len(t) for _, t in leaves]
    marks = [len(PUNCTUATION.findall(t)) for _, t in leaves]

    def weigh() -> tuple[bool, int]:
        """Whether an article or main has text, and the length of all text that counts."""
        for x in elements:
            x.out = x.boiler or x.parent is not None and x.parent.out
            x.text, x.holds = 0, False
        for (e, _), n in zip(leaves, lengths):
            if not e.out:
                e.text += n
        _upwards(elements, "text")
        for x in reversed(elements):
            if x.parent is not None and x.text and (x.holds or x.article is x):
                x.parent.holds = True
        return any(x.article is x and x.text for x in elements), elements[0].text

    marked, whole = weigh()
    wrappers = [x for x in elements if x.wrapper]
    for x in wrappers:
        x.boiler = x.boiler or not x.holds and 2 * x.text <= whole
    # a name alone does not condemn an element that holds most of a page without an article
    if wrappers:
        marked, whole = weigh()
    # inside an article, elements of one name that together hold half of its text or more are left to the path scores
    named: Counter[tuple[int, str]] = Counter()
    inner: Counter[tuple[int, str]] = Counter()  # such names from the root to the element in hand
    stack: list[Element] = []
    for x in elements if marked else ():
        while stack and not x.inside(stack[-1]):
            y = stack.pop()
            inner[id(y.article), y.step] -= 1
        if x.suspect and x.article is not None and not x.out:
            key = id(x.article), x.step
            if not inner[key]:
                named[key] += x.text
            inner[key] += 1
            stack.append(x)

    def condemned(e: Element) -> bool:
        a = e.article
        if a is not None and a.text:
            return 2 * named[id(a), e.step] < a.text
        return marked or 2 * e.text <= whole

    numbers: dict[tuple[int, str], int] = {}  # tag paths, as numbers
    for x in elements:
        up = x.parent
        x.bad = x.boiler or x.suspect and not x.holds and condemned(x) or up is not None and up.bad
        x.in_header = x.tag == "header" or up is not None and up.in_header
        x.path = numbers.setdefault((-1 if up is None else up.path, x.step), len(numbers))

    good = [i for i, (e, _) in enumerate(leaves) if not e.bad]
    if not good:
        return ""
    scores = path_scores([leaves[i][0].path for i in good], [lengths[i] for i in good], [marks[i] for i in good])
    top = sum(scores) / len(scores)
    spread = math.sqrt(sum((s - top) ** 2 for s in scores) / len(scores))
    limit = min(LAMBDA * spread, max(scores)) if max(scores) > 0 else 0.0
    seeds = [i for i, s in zip(good, scores) if s >= limit]
    for i in seeds:
        leaves[i][0].weight += lengths[i]
    for i in good:
        leaves[i][0].blocks += leaves[i][0].tag not in HEADINGS
    _upwards(elements, "weight")
    _upwards(elements, "blocks")
    weight = elements[0].weight

    def smallest(share: float) -> Element:
        return max((x for x in elements if x.weight >= share * weight and x.tag not in LEAF_BLOCKS), key=lambda x: x.depth)

    # the smallest element, not itself a block of text, that holds all of it; if that is the body, all of the part
    # of the body that holds nearly all
    box = smallest(1.0)
    if box.tag in ("body", "html"):
        box = smallest(HOLDS)
        within = [x for x in box.chain() if x.tag not in ("body", "html")]
        if within:
            box = next(x for x in within if x.weight == within[-1].weight)
    for x in box.chain():  # an article is not cut into its sections
        if x.tag == "article" and not x.bad:
            box = x
    if box.tag not in ("article", "main", "body", "html"):  # headings beside it belong to it
        while box.parent is not None and box.parent.tag not in ("body", "html") and box.parent.blocks == box.blocks:
            box = box.parent
    loose = box.tag in ("body", "html")
    kept, seed = [], set(seeds)
    for i in good:
        e = leaves[i][0]
        if not e.inside(box) and i not in seed:
            continue
        if loose and i not in seed and e.tag not in HEADINGS and not seeds[0] < i < seeds[-1]:
            continue  # no element to go by: content paths and what lies between
        if e.in_header and e.tag not in HEADINGS and i not in seed:
            continue
        kept.append(leaves[i][1])
    return "\n".join(kept)


def extracted(page: Column) -> Column:
    """The main text of an HTML column."""

    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        with no_gc():
            return pd.Series([main_text(p) for p in pages], dtype=object)

    return of(page)


def extract(pages: DataFrame, html_col: str = "html", to: str = "main_text") -> DataFrame:
    """``pages`` with one more column, its main text, named ``to`` (with underscores
    before it if ``pages`` has such a column)."""
    (name,) = fresh(pages, to)
    return pages.withColumn(name, extracted(col(pages, html_col)))


@query("op2_html_extraction")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    p = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), to="text")
    return p.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

"""Main text of web pages by equivalence classes of template tokens.

Pages of a host come from few templates. A page is read into tokens: tags, told apart by the
path of elements they stand in and their number among equal siblings, and texts of blocks with
their path. Over all pages of a host
the tokens with equal occurrence vectors (how often on which page) form classes. A class is valid
if its tokens keep one order on every page. The largest valid class of tags that stand once on a
page is the template's frame; what stands between its tokens are slots. Texts of another valid
class belong to the template if it nests in the frame: it has a tag, and each text stands in the
same slot on every page. Extraction walks a page slot by slot, leaves out the template's texts and
parts whose names say that they are boilerplate, and returns the slots that hold the page's own
prose, with the elements around them.
"""

from __future__ import annotations

import hashlib
import html as markup
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.scratch import stored

#: Distinct pages of a host that hold a class, at least, and their share of the host's in percent.
MIN_PAGES, MIN_SHARE_PCT = 5, 10
#: A slot is returned if it has this part of the prose of the page's fullest slot, and how many
#: times more prose counts that stands in an element named article or main.
LEAST_PART, NAMED_WEIGHT = 0.125, 8

# Element and attribute names of HTML, and words that name parts of a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav noscript ol optgroup option p pre section summary table tbody td template tfoot "
    "th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
ASIDE_TAGS = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noframes noscript object option "
    "script select style svg template textarea title xmp".split()
)
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts alert alerts advertisement advertisements advertising adsense banner breadcrumb "
    "breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr hidden legal "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain "
    "overlay pager pagination popup promo promoted promotion promotions recommend recommendations "
    "recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored sponsors subscribe subscription taboola toolbar topbar widget widgets".split()
)
ARTICLE_ASIDE_WORDS = frozenset(
    "ad ads advert advertisement comment comments promo related reply sponsored teaser".split()
)
# Inside an article a name tells a part only if nothing but such words and these are in it.
ARTICLE_NAMES = ASIDE_WORDS - frozenset("hidden legal copyright search social".split())
NEUTRAL_WORDS = frozenset(
    "area articles bar block box container content inner inline item items links list outer panel "
    "posts section slot story stories text unit wrap wrapper".split()
)

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|</?[a-zA-Z][^<>]*\Z",
    re.S,
)
_UNFINISHED = re.compile(r"<!--.*|<[!?].*|()()()()()()</?[a-zA-Z][^<>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(slots=True)
class Element:
    tag: str
    block: bool
    path: int
    aside: bool
    article: int | None  # number of the outermost article it stands in
    parents: tuple[int, ...]  # numbers of the elements around, itself last
    link: bool
    mark: int = 0  # parts of the block's text when it was opened


@dataclass(slots=True)
class Block:
    path: int
    aside: bool
    article: int | None
    parents: tuple[int, ...]
    text: str
    linked: int  # characters in links
    at: int  # tags opened or closed before it


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    #: How often each tag token occurs, and how many tags come before the first.
    tags: Counter = field(default_factory=Counter)
    first: dict[int, int] = field(default_factory=dict)
    n_tags: int = 0

    def saw(self, token: int) -> None:
        seen = self.tags.get(token)
        if seen is None:
            self.tags[token] = 1
            self.first[token] = self.n_tags
        else:
            self.tags[token] = seen + 1
        self.n_tags += 1


def _attributes(text: str) -> tuple[list[list[str]], str, bool]:
    """The words of each name in class and id, the role, and whether the element is hidden."""
    names, role, hidden = [], "", False
    for name, value in _ATTRIBUTE.findall(text) if text else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            names.extend([part.lower() for part in _NAME_PARTS.findall(one)] for one in value.split())
        elif name == "role":
            role = value.lower()
        elif name == "hidden" or value.lower() == "true":
            hidden = True
    return names, role, hidden


def _is_aside(tag: str, names: list[list[str]], role: str, hidden: bool, in_article: bool) -> bool:
    words = {word for name in names for word in name}
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return hidden or bool(words & ARTICLE_ASIDE_WORDS)
    if tag == "header" or "header" in words or role == "banner":
        if not in_article:
            return True
        role = ""
    if in_article:
        told = any(
            ARTICLE_NAMES & set(name) and all(w in ASIDE_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in name)
            for name in names if name != ["banner"]
        )
    else:
        told = bool(words & ASIDE_WORDS)
    return hidden or tag in ASIDE_TAGS or role in ASIDE_ROLES or told


def _judged(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """The label of a block element among its siblings, and whether the element stands aside."""
    names, role, hidden = _attributes(attributes)
    label = ".".join([tag, *sorted({word for name in names for word in name})])
    return label, _is_aside(tag, names, role, hidden, in_article)


# The same few tags come again on all pages of a host; long ones are not kept.
_LONGEST_KEPT = 300
_judged_before = lru_cache(1 << 14)(_judged)


class _Reader:
    """Builds a Page from the tags and texts of one document, mending what is not closed."""

    def __init__(self):
        self.page = Page()
        self.root = Element("", False, 0, False, None, (0,), False)
        self.stack: list[Element] = []
        self.is_open: Counter = Counter()  # elements of each tag on the stack
        self.siblings: Counter = Counter()  # elements so far by their parent's path and own label
        self.count = 0
        self.parts: list[str] = []
        self.linked = 0

    @property
    def top(self) -> Element:
        return self.stack[-1] if self.stack else self.root

    def text(self, raw: str) -> None:
        if raw:
            decoded = markup.unescape(raw) if "&" in raw else raw
            self.parts.append(decoded)
            if self.top.link:
                self.linked += len(decoded)

    def flush(self) -> None:
        """End a block of text; what an inline element put aside has added is left out."""
        stack = self.stack
        own = len(stack) - 1
        while own >= 0 and not stack[own].block:
            own -= 1
        at = stack[own] if own >= 0 else self.root
        inline = stack[own + 1 :]
        if self.parts:
            aside = next((e for e in inline if e.aside and not at.aside), None)
            parts = self.parts if aside is None else self.parts[: aside.mark]
            text = " ".join("".join(parts).split())
            if text:
                self.page.blocks.append(
                    Block(at.path, at.aside, at.article, at.parents, text, self.linked, self.page.n_tags)
                )
            self.parts, self.linked = [], 0
        # inline elements below the block were set when it was opened
        for e in inline:
            e.mark = 0

    def open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
            if self.is_open["p"]:
                self._close_to("p", ("table", "td", "th", "article", "section", "div", "li", "body", "aside", "blockquote"))
            if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
                same = ("dd", "dt") if tag in ("dd", "dt") else ("td", "th") if tag in ("td", "th") else (tag,)
                for name in same:
                    self._close_to(name, ("ul", "ol", "dl", "table", "select", "nav", "menu"))
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        parent = self.top
        article = parent.article
        judged = _judged_before if len(attributes) <= _LONGEST_KEPT else _judged
        label, own = judged(tag, attributes, article is not None)
        self.count += 1
        if article is None and tag in ("article", "main") and not (own or parent.aside):
            article = self.count
        elif tag == "article" and not own and not self.is_open["article"] and not parent.aside:
            article = self.count  # an article inside main is the closer of the two
        path, parents = parent.path, parent.parents
        if block:
            number = self.siblings[path, label] = self.siblings[path, label] + 1
            named = _tag_token if len(label) <= _LONGEST_KEPT else _tag_token.__wrapped__
            path = named(path, label, number)
            if len(parents) < 200:
                parents = (*parents, self.count)
        self.stack.append(
            Element(tag, block, path, parent.aside or own, article, parents, parent.link or tag == "a", len(self.parts))
        )
        self.is_open[tag] += 1
        if block:
            self.page.saw(path)

    def _pop(self) -> Element:
        element = self.stack.pop()
        self.is_open[element.tag] -= 1
        if element.block:
            self.page.saw(~element.path)
        return element

    def close(self, tag: str) -> None:
        if self.is_open[tag]:
            if tag in BLOCKS:
                self.flush()
            while True:
                element = self._pop()
                if element.tag == tag:
                    if tag not in BLOCKS and element.aside and not self.top.aside:
                        del self.parts[element.mark :]
                    return
        elif tag in BLOCKS:
            self.flush()

    def _close_to(self, tag: str, stops: tuple[str, ...]) -> None:
        if not self.is_open[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                while len(self.stack) > at:
                    self._pop()
                return
            if self.stack[at].tag in stops:
                return


def read_page(html: str | None) -> Page:
    """Blocks of text in page order, and how often each path of elements is opened."""
    reader = _Reader()
    html = html or ""
    at, n = 0, len(html)
    last = html.rfind(">")
    while at < n:
        begin = html.find("<", at)
        # behind the last ">" no tag ends: the pattern would look for one from every "<"
        if begin > last and not html.startswith(("<!", "<?"), begin):
            found = _UNFINISHED.search(html, begin)
        else:
            found = _TAG.search(html, at)
        if not found:
            reader.text(html[at:])
            break
        reader.text(html[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            if html.startswith("<![CDATA[", found.start()):
                reader.text(found[0][9:-3])
            continue
        tag = name.lower()
        if found[1] or found[4]:
            reader.close(tag)
            continue
        attributes = found[3] or found[6] or ""
        reader.open(tag, attributes)
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            reader.close(tag)
    reader.flush()
    return reader.page


def _token(kind: str, path: int, text: str = "") -> int:
    digest = hashlib.blake2b(f"{kind}\0{path}\0{text}".encode(errors="surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


@lru_cache(1 << 16)
def _tag_token(path: int, label: str, number: int) -> int:
    return _token("tag", path, f"{label}#{number}")


def text_token(block: Block) -> int:
    return _token("text", block.path, block.text)


def slots_of(page: Page, frame: list[int]) -> list[int]:
    """For each block its slot: the last token of the frame before it (0: none).

    Without a frame on the page, the element around a block's own is its slot.
    """
    edges = sorted((page.first[token], token) for token in frame if page.tags[token] == 1)
    if len(edges) < 2:
        return [b.parents[-2] if len(b.parents) > 1 else 0 for b in page.blocks]
    places = [place for place, _ in edges]
    return [edges[k - 1][1] if (k := bisect_left(places, b.at)) else 0 for b in page.blocks]


def prose_of(block: Block) -> int:
    """Characters of prose: none in texts that stand aside or are mostly links."""
    if block.aside:
        return 0
    if block.article is not None:
        return NAMED_WEIGHT * len(block.text)
    return 0 if 2 * block.linked > len(block.text) else len(block.text)


def _around(blocks: list[Block]) -> int:
    """The innermost element around all blocks that is not a block's own."""
    common = blocks[0].parents[:-1] or blocks[0].parents
    for b in blocks[1:]:
        own = b.parents[:-1] or b.parents
        k = 0
        while k < min(len(common), len(own)) and common[k] == own[k]:
            k += 1
        common = common[:k]
    return common[-1] if common else 0


def extract(page: Page, template: set[int], frame: list[int] = (), full: set[int] = frozenset()) -> str:
    """The blocks of the slots that hold the article, joined by line ends; empty if there are none.

    A slot's weight is the prose in it that is not the template's; in elements named article or
    main prose counts NAMED_WEIGHT times. Of the host's fullest slots (``full``), or of all if
    those are empty here, the ones with LEAST_PART of the greatest weight are returned (of equal
    ones all), each with all that stands in the innermost element around its prose, or in the
    articles of the page if it is in one. There the texts of the template stay: a passage that
    all articles share is theirs.
    """
    weight: Counter = Counter()
    members: dict[int, list[Block]] = {}
    for b, slot in zip(page.blocks, slots_of(page, list(frame))):
        prose = prose_of(b)
        if prose and (b.article is not None or text_token(b) not in template):
            weight[slot] += prose
            members.setdefault(slot, []).append(b)
    if not full.isdisjoint(weight):
        weight = Counter({slot: n for slot, n in weight.items() if slot in full})
    if not weight:
        return ""
    least = LEAST_PART * max(weight.values())
    chosen = [members[slot] for slot in weight if weight[slot] >= least]
    # prose outside of a named article is weighed against it, text in one is not left out
    named = any(b.article is not None for blocks in chosen for b in blocks)
    around = {_around(blocks) for blocks in chosen if not all(b.article is not None for b in blocks)}
    out = []
    for b in page.blocks:
        if b.aside:
            continue
        if b.article is not None:
            if named:
                out.append(b.text)
        elif not around.isdisjoint(b.parents) and text_token(b) not in template:
            out.append(b.text)
    return "\n".join(out)


def _tokens(batches):
    """Per page: host, a hash of the page, and its tokens with counts, first places and prose."""
    names = ["host", "digest", "token", "n", "at", "is_tag", "prose"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        hosts, digests, tokens, counts, firsts, is_tag, prose = columns
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = read_page(html)
            digest = _token("page", 0, html or "")
            texts: Counter = Counter()
            places: dict[int, int] = {}
            weights: dict[int, int] = {}
            for b in page.blocks:
                token = text_token(b)
                texts[token] += 1
                if token not in places:
                    places[token], weights[token] = b.at, prose_of(b)
            n_tags, n_texts = len(page.tags), len(texts)
            hosts += [host] * (n_tags + n_texts)
            digests += [digest] * (n_tags + n_texts)
            tokens += page.tags
            tokens += texts
            counts += page.tags.values()
            counts += texts.values()
            firsts += map(page.first.__getitem__, page.tags)
            firsts += places.values()
            is_tag += [True] * n_tags + [False] * n_texts
            prose += [0] * n_tags
            prose += weights.values()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(found, F.lit(""))


def deduce_templates(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share_pct: int = MIN_SHARE_PCT
) -> DataFrame:
    """host, frame (tags), template (texts) and full (slots) of every host of (host, html) with a frame.

    The full slots are those that hold, over all pages, LEAST_PART of the prose of the fullest; a
    slot is named by the token of the frame before it.

    Occurrence vectors are compared by a hash that adds up over pages; equal pages count once.
    A class is looked at if ``min_pages`` distinct pages and ``min_share_pct`` percent of the
    host's hold it. That share bounds a host's tokens by a multiple of a page's.
    """
    told = pages.filter("host is not null").select("host", "html").mapInArrow(
        _tokens, "host string, digest bigint, token bigint, n bigint, at bigint, is_tag boolean, prose bigint"
    )
    once = told.groupBy("host", "token", "digest").agg(
        F.max("n").alias("n"), F.min("at").alias("at"), F.max("is_tag").alias("is_tag"), F.max("prose").alias("prose")
    )
    once = stored(once, "tokens")
    vectors = once.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("digest", "n")).alias("vector"),
        F.count("*").alias("n_pages"), F.max("n").alias("most"), F.max("is_tag").alias("is_tag"),
    )
    vectors = stored(vectors.filter(F.col("n_pages") >= min_pages), "vectors")
    widest = vectors.groupBy("host").agg(F.max("n_pages").alias("host_pages"))
    frequent = vectors.join(widest, "host").filter(100 * F.col("n_pages") >= min_share_pct * F.col("host_pages"))
    frequent = stored(frequent.select("host", "token", "vector", "n_pages", "most", "is_tag"), "frequent")
    # valid classes: one order of their tokens on all pages (equal places: by token)
    placed = stored(once.select("host", "token", "digest", "at").join(frequent, ["host", "token"]), "placed")
    order = F.xxhash64(F.transform(F.sort_array(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]))
    per_page = placed.groupBy("host", "vector", "digest").agg(order.alias("order"))
    valid = per_page.groupBy("host", "vector").agg((F.min("order") == F.max("order")).alias("ordered"))
    valid = stored(valid.filter("ordered").select("host", "vector"), "valid")
    classes = placed.join(valid, ["host", "vector"], "left_semi")
    # the frame: the valid class with most tags that stand once on a page
    tags = frequent.filter("is_tag and most = 1").join(valid, ["host", "vector"], "left_semi")
    sizes = tags.groupBy("host", "vector").agg(F.count("*").alias("n_tags"), F.max("n_pages").alias("n_pages"))
    frames = sizes.groupBy("host").agg(F.max_by("vector", F.struct("n_pages", "n_tags", "vector")).alias("vector"))
    frames = stored(tags.join(frames, ["host", "vector"], "left_semi").select("host", "token"), "frames")
    edges = placed.join(frames, ["host", "token"], "left_semi").groupBy("host", "digest").agg(
        F.sort_array(F.collect_list(F.struct("at", "token"))).alias("edges")
    )
    edges = stored(edges, "edges")
    # texts of classes that nest: in one slot of the frame on every page, beside a tag of their class
    tagged = frequent.filter("is_tag").select("host", "vector").distinct()
    texts = classes.filter("not is_tag").join(tagged, ["host", "vector"], "left_semi")
    before = F.filter("edges", lambda edge: edge["at"] < F.col("at"))
    slot = F.when(F.size(before) > 0, F.element_at(before, -1)["token"]).otherwise(0)
    slotted = texts.join(edges, ["host", "digest"]).select("host", "token", "n_pages", slot.alias("slot"))
    nested = slotted.groupBy("host", "token").agg(
        F.min("slot").alias("low"), F.max("slot").alias("high"), F.count("*").alias("n"), F.max("n_pages").alias("n_pages")
    )
    nested = stored(nested.filter("low = high and n = n_pages").select("host", "token"), "nested")
    # the full slots, by the prose of other texts
    own = once.filter("prose > 0").join(nested, ["host", "token"], "left_anti").join(edges, ["host", "digest"])
    weights = own.groupBy("host", slot.alias("slot")).agg(F.sum(F.col("prose") * F.col("n")).alias("weight"))
    weights = stored(weights, "weights")
    greatest = weights.groupBy("host").agg(F.max("weight").alias("greatest"))
    full = weights.join(greatest, "host").filter(F.col("weight") >= LEAST_PART * F.col("greatest"))
    out = frames.groupBy("host").agg(F.collect_set("token").alias("frame"))
    out = out.join(nested.groupBy("host").agg(F.collect_set("token").alias("template")), "host", "left")
    return out.join(full.groupBy("host").agg(F.collect_set("slot").alias("full")), "host", "left")


def _extracted(batches):
    for batch in batches:
        texts = []
        # most pages of a batch share their host's template: made into sets once
        sets: dict[str, tuple] = {}
        for host, html, *lists in zip(*[batch.column(c).to_pylist() for c in ("host", "html", "template", "frame", "full")]):
            if host not in sets:
                sets[host] = tuple(set(found or ()) for found in lists)
            template, frame, full = sets[host]
            texts.append(extract(read_page(html), template, frame, full))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block is one blank, blocks are
    joined by a line end in page order. A null or empty html has an empty text. Pages without
    a host in their url have no template: there the elements around blocks are the slots. Slots of
    equal weight are all returned. Pages are read in time proportional to their length, whatever is
    left open in them. Repeated rows are extracted alike; other columns are ignored. Runs jobs when called.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    templates = stored(deduce_templates(rows), "templates")
    kind = pages.schema["page_id"].dataType.simpleString()
    found = (
        rows.join(templates, "host", "left").select("page_id", "url", "host", "html", "template", "frame", "full")
        .mapInArrow(_extracted, f"page_id {kind}, url string, text string")
    )
    return found.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags.  The first pass decides what the
rules can: blocks in navigation, notices, comments and the like are dropped,
and length, link density and stop-word density sort the rest.  Where articles
hold most of the text, being inside one is a further sign.  The second pass
gives short, undecided blocks the label of their nearest decided neighbours.
"""

import html
import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Rules(NamedTuple):
    """Lengths in characters, densities from 0 to 1."""

    most_links: float = 0.33
    short: int = 70
    long: int = 200
    few_stop_words: float = 0.15
    many_stop_words: float = 0.28


# Fixed lists of frequent function words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an "
    "they which one you were her all she there would their we him been has when who will more no if out so "
    "der die das und ist von den dem des mit zu auf für im ein eine einer eines sich auch nicht als an es "
    "bei aus nach wie wird sind oder war werden dass nur noch durch einen einem über "
    "le la les de des du un une et est en que qui dans pour sur par au aux avec ce cette il elle ne pas plus "
    "se son sa ses ou mais nous vous ils leur été sont être "
    "el los las del y que una por con para su al lo como más o pero sus se es ha fue son entre cuando muy "
    "sin sobre también me hasta hay donde".split()
)

# Fixed values of HTML.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section select summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH_ENDERS = BLOCKS - frozenset("legend caption option optgroup".split())
DROPPED = frozenset("head nav footer aside form button select menu dialog object canvas audio video label".split())
MARKS = frozenset(
    "nav navbar navigation menu sidebar ad ads adv advert adverts advertisement advertising banner sponsor sponsored "
    "promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription social share sharing related recommended recommendations breadcrumb breadcrumbs pagination "
    "pager comment comments reply replies respond disqus discussion footer masthead widget widgets toolbar login "
    "signup search copyright legal disclaimer skip".split()
)
# What a name made of several words may add to a mark.
PLACES = frozenset(
    "site page main top bottom left right primary secondary inner outer global post posts article box bar block list "
    "item items link links section area container wrapper wrap slot unit form buttons icons text message content".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?P<rawattrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[^\W\d_]+")
# Fixed list: words of offers, in the four languages; two of them, or a price, make an offer.
SALES = frozenset(
    "sale sales offer offers discount coupon promo deal deals buy shop outlet voucher price prices "
    "angebot angebote rabatt aktion gutschein preis preise kaufen sparen bestellen "
    "soldes promotion remise achetez prix offre panier livraison oferta ofertas descuento precio precios compra rebajas cupón".split()
)
_PRICE = re.compile(r"[$€£]\s?\d|\d\s?(?:[€£%]|EUR\b|USD\b)")
_BETWEEN = re.compile(r"[_-]+")


def _values(attributes: str, *names: str) -> list[str]:
    return [next(filter(None, v), "").lower() for name, *v in _ATTRIBUTE.findall(attributes) if name.lower() in names]


def _hidden(attributes: str) -> bool:
    return bool(attributes) and bool(_values(attributes, "hidden"))


def _marked(attributes: str) -> bool:
    """Whether the names of an element call it something other than main text.

    A name counts as a whole: ``site-footer`` and ``cookie-banner`` are marks,
    ``no-sidebar`` and ``search-result`` are not.
    """
    if not attributes:
        return False
    for name in " ".join(_values(attributes, "class", "id")).split():
        parts = set(filter(None, _BETWEEN.split(name)))
        if not MARKS.isdisjoint(parts) and parts <= MARKS | PLACES:
            return True
    return any(value in ROLES for value in _values(attributes, "role"))


class Element:
    """``text``: characters outside links, ``article``: those of them in an unmarked article."""

    __slots__ = ("tag", "above", "dropped", "marked", "inside", "own", "core", "text", "article")

    def __init__(self, tag, above=None, dropped=False, marked=False):
        main = tag in ("article", "main")
        self.tag, self.above, self.dropped, self.marked = tag, above, dropped, marked
        self.inside = main or above is not None and above.inside
        self.own = not marked and (main or above is not None and above.own)
        self.core, self.text, self.article = tag == "main", 0, 0


class Block:
    __slots__ = ("parts", "linked", "element", "heading")

    def __init__(self, element, heading):
        self.parts, self.linked = [], 0
        self.element, self.heading = element, heading

    @property
    def dropped(self):
        return self.element.dropped

    @property
    def inside(self):
        return self.element.inside

    @property
    def listing(self):
        return "pre" in (self.element.tag, self.element.above and self.element.above.tag)


def _settle_marks(elements: list[Element], blocks: list[tuple[str, Block]]) -> None:
    """Drop what is below a marked element, unless that holds the main text by its tags or its size."""
    for text, block in blocks:
        if not block.dropped:
            unlinked = max(0, len(text) - block.linked)
            block.element.text += unlinked
            block.element.article += unlinked if block.element.own else 0
    for element in reversed(elements[1:]):
        above = element.above
        above.text += element.text
        above.article += element.article
        above.core = above.core or not element.dropped and (element.core or element.tag == "h1" and element.text > 0)
    page = elements[0]
    for element in elements[1:]:
        if element.marked and not element.core:
            elsewhere = page.article - element.article
            element.dropped = element.dropped or 2 * element.text <= page.text or 10 * elsewhere >= page.text
        element.dropped = element.dropped or element.above.dropped


def blocks_of(page: str) -> list[tuple[str, Block]]:
    """The non-empty blocks of a page with their text, in page order."""
    stack = [Element("")]
    elements = stack[:]
    links, done, block = 0, [], None

    def closed():
        nonlocal block
        if block:
            text = " ".join("".join(block.parts).split())
            if text:
                done.append((text, block))
        block = None

    for token in _TOKEN.finditer(page):
        text, tag = token["text"], token["tag"]
        if text:
            if block is None:
                block = Block(stack[-1], any(e.tag in HEADINGS for e in stack[-3:]))
            decoded = html.unescape(text)
            block.parts.append(decoded)
            if links:
                block.linked += len(decoded.strip())
        elif tag:
            tag = tag.lower()
            if tag == "a":
                links = 0 if token["end"] else 1
            if tag == "br":
                if block:
                    block.parts.append(" ")
                continue
            if tag in BLOCKS:
                closed()
            if token["end"]:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), 0)
                if depth:
                    if any(e.tag in BLOCKS or e.marked or e.dropped != e.above.dropped for e in stack[depth:]):
                        closed()
                    del stack[depth:]
                continue
            if tag in VOID or token["attrs"].endswith("/"):
                continue
            if tag in ("body", "article", "main", "nav", "footer", "section", "div"):
                links = 0
            if tag in PARAGRAPH_ENDERS:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag in BLOCKS), 0)
                if depth and (stack[depth].tag == "p" or stack[depth].tag == tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    del stack[depth:]
            if tag == "body":
                del stack[1:]
            above, out, marked = stack[-1], False, False
            if tag not in ("html", "body"):
                out = tag in DROPPED or tag == "header" and not above.inside or _hidden(token["attrs"])
                marked = not out and _marked(token["attrs"])
                if (out or marked) and tag not in BLOCKS:
                    closed()
            stack.append(Element(tag, above, above.dropped or out, marked))
            elements.append(stack[-1])
    closed()
    _settle_marks(elements, done)
    return done


def _first_pass(text: str, block: Block, contained: bool, prose: bool, rules: Rules):
    """True, False, or None for undecided.

    ``contained``: most of the text is in articles, so that being inside one
    counts; ``prose``: the lists of stop words know the language of the page.
    """
    if block.dropped:
        return False
    length = max(1, len(text))
    inside, outside = contained and block.inside, contained and not block.inside
    if block.linked > rules.most_links * length:
        return None if inside and length < rules.short else False
    density = _stop_words(text)
    if "©" in text and not (inside and (length >= rules.long or length >= rules.short and density >= rules.few_stop_words)):
        return False
    if block.heading:
        return None
    if length < rules.short:
        return False if outside else None
    if outside:
        return density >= rules.many_stop_words and length >= rules.long
    if inside:
        # Few stop words alone may be names or numbers in prose; an offer or links are a second sign.
        unlike = prose and length >= rules.long and density < rules.few_stop_words / 2 and not block.listing
        unlike = unlike and (block.linked > 0 or _offers(text))
        return True if density >= rules.few_stop_words else False if unlike else None
    if density >= rules.many_stop_words:
        return True if length >= rules.long else None
    return None if density >= rules.few_stop_words else False


def _offers(text: str) -> bool:
    return bool(_PRICE.search(text)) or len(SALES.intersection(_WORD.findall(text.lower()))) > 1


def _stop_words(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def main_text(page, rules=Rules()) -> str:
    """The blocks of the main text, joined by line ends; empty for an empty page."""
    found = blocks_of(page) if page else []
    there = [(len(t), b.inside) for t, b in found if not b.dropped]
    contained = 2 * sum(n for n, inside in there if inside) > sum(n for n, _ in there)
    prose = not contained or _stop_words(" ".join(t for t, b in found if b.inside and not b.dropped)) >= rules.few_stop_words
    labels = [_first_pass(t, b, contained, prose, rules) for t, b in found]
    if contained:  # blocks of an article go by their neighbours in it, not by what surrounds it
        within = [at for at, (_, b) in enumerate(found) if b.inside and not b.dropped]
        for at, label in zip(within, _second_pass([labels[at] for at in within], [True] * len(within))):
            labels[at] = label
    labels = _second_pass(labels, [not b.dropped for _, b in found])
    return "\n".join(text for (text, _), label in zip(found, labels) if label)


def _second_pass(labels: list, open_blocks: list[bool]) -> list[bool]:
    """The labels, undecided ones as their nearest decided neighbours."""
    if not any(labels):  # nothing is certain: what is not ruled out stays
        return [label is None and is_open for label, is_open in zip(labels, open_blocks)]
    after = [None] * len(labels)
    coming = None
    for at in range(len(labels) - 1, -1, -1):
        coming = at if labels[at] is not None else coming
        after[at] = coming
    out, before = [], None
    for at, label in enumerate(labels):
        if label is not None:
            before = at
        else:
            near = [d for d in (before, after[at]) if d is not None]
            least = min(abs(at - d) for d in near)
            label = any(labels[d] for d in near if abs(at - d) == least)
        out.append(label)
    return out


def page_texts(pages: DataFrame, html_col="html", name="text", rules=Rules()) -> DataFrame:
    """``pages`` with their main text in column ``name`` instead of the page.

    A null or empty page has an empty text.  All other columns stay.
    """
    kept = pages.drop(name) if name != html_col else pages

    def run(frames):
        for frame in frames:
            texts = [main_text(page, rules) for page in frame[html_col]]
            yield frame.drop(columns=[html_col]).assign(**{name: texts})

    fields = [f for f in kept.schema.fields if f.name != html_col]
    schema = T.StructType([*fields, T.StructField(name, T.StringType())])
    text = F.col(html_col).cast("string")
    return kept.withColumn(html_col, text).mapInPandas(run, schema)

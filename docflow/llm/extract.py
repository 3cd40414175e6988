"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by where they stand (menus, footers,
adverts and the like), link density, stop-word density and length. Short blocks and blocks of middling density stay
undecided; the second pass gives them the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from docflow.llm.shared import slices

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you
    aber als am an auch auf aus bei das dass dem den der des die ein eine einen er es für hat ich im in ist mit nach nicht noch sich sie sind so über um und von war wie zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous
    al como con de del el ella en entre era es esta este fue ha hay la las lo los más me mi muy no o para pero por que se sin su sus también un una y ya""".split()
)
# Tags whose content is no markup and no text, containers that are not the article, and tags that end a block.
RAW = frozenset("script style noscript noframes noembed iframe textarea title xmp".split())
ASIDE = frozenset("nav footer aside form button select dialog menu head template svg".split())
BLOCK = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html
    legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end an open element of their kind, and inline or small ones whose end tag closes nothing outside of FENCE.
ENDS_ITS_KIND = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
INLINE, FENCE = frozenset("p b i a span li em strong".split()), frozenset("article main td table".split())
#: Words in a class, id or role that mark what is not the article.
BAD_NAME = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|contentinfo|cookies?|disqus|footer|masthead|menu|nav|navbar|navigation|newsletter|notice|pagination|popup|promo\w*|related|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])"
)
GOOD_NAME = re.compile(r"(?i)(?:^|[\s_-])(?:article|articlebody|entry-content|post-body|post-content|main)(?:$|[\s_-])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: One attribute after white space: its name and, if quoted, the quote or else the value.
ATTRIBUTE = re.compile(r"""[\s/]*+(?:(>)|(=?[^\s/>=]*+)(?:\s*+=\s*+(?:(["'])|([^\s>]*+)))?+)""")
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,}+)|([xX])([0-9a-fA-F]{8,}+));?")
WORD = re.compile(r"[^\W\d_]+")
GOOD, BAD, OPEN = 1, 0, -1
#: Blocks of fewer characters are short; densities of links and stop words that decide.
SHORT, MOST_LINKS, FEW_STOPS, MANY_STOPS = 70, 0.33, 0.04, 0.10


def decoded(text: str) -> str:
    """Character references decoded, with numbers of any length."""

    def short(m: re.Match) -> str:
        digits = (m[1] or m[3]).lstrip("0")
        return "\ufffd" if len(digits) > 7 else f"&#{m[2] or ''}{digits or 0};"

    return html.unescape(LONG_REFERENCE.sub(short, text) if "&#" in text else text)


def tokens(page: str):
    """Yields (text, None, None) and ("", name, attributes); attributes is None for an end tag, else a dictionary of the first value of each name.

    One pass from left to right: no place of the page is looked at again. Markup that the page's end cuts off is
    dropped; a quote that is never closed is part of its value.
    """
    last, quotes = page.rfind(">"), {q: page.rfind(q) for q in "\"'"}
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield page[at:], None, None
            return
        if lt > at:
            yield page[at:lt], None, None
        ahead = page[lt + 1 : lt + 3]
        ending = ahead[:1] == "/"
        m = NAME.match(page, lt + 1 + ending)
        if m is None or not m[0][0].isascii():
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                at = n if end < 0 else end + 3
            elif ahead[:1] in ("!", "?") and ahead or ending and len(ahead) > 1:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                yield "<", None, None
                at = lt + 1
            continue
        if lt > last:
            return
        name, at, found = m[0].lower(), m.end(), {}
        while True:
            m = ATTRIBUTE.match(page, at)
            at = m.end()
            if m[1]:
                break
            if at >= n:
                return
            value = m[4]
            if m[3]:
                if at > quotes[m[3]]:  # never closed
                    value = page[at : (m := re.compile(r"[^\s>]*+").match(page, at)).end()]
                    at = m.end()
                    continue
                end = page.index(m[3], at)
                value, at = page[at:end], end + 1
            if m[2]:
                found.setdefault(m[2].lower(), value or "")
        yield "", name, None if ending else found
        if not ending and name in RAW:
            m = CLOSING[name].search(page, at)
            at = m.start() if m else n


def blocks(page: str) -> list[tuple[str, float, bool, bool]]:
    """(text, share of it within links, stands in a container that is not the article, stands in the article) of each block with text."""
    found: list[tuple[str, float, bool, bool]] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, bad, good
    places: dict[str, list[int]] = {}  # of open elements, by name; those of blocks and fences once more
    bad = good = links = 0

    def close() -> None:
        nonlocal linked
        if text:
            whole = " ".join(decoded("".join(text)).split())
            if whole:
                found.append((whole, min(1.0, linked / len(whole)), bad > 0, good > 0))
            text.clear()
        linked = 0

    def kinds(name: str) -> list[str]:
        return [name, *["#block"] * (name in BLOCK and name != "p"), *["#fence"] * (name in FENCE)]

    def last(name: str) -> int:
        return places[name][-1] if places.get(name) else -1

    def leave(k: int) -> None:
        nonlocal bad, good, links
        while len(stack) > k:
            name, b, g = stack.pop()
            for kind in kinds(name):
                places[kind].pop()
            bad, good, links = bad - b, good - g, links - (name == "a")

    for chars, name, attributes in tokens(page):
        if name is None:
            text.append(chars)
            if links:
                linked += len(chars.strip())
            continue
        if name in BLOCK:
            close()
        elif name == "br":
            text.append(" ")
        if name in VOID or name in RAW:
            continue
        k = last(name)
        if attributes is None:
            if k >= 0 and not (name in INLINE and last("#fence") > k):  # a stray end tag closes nothing outside
                leave(k)
            continue
        if name in ENDS_ITS_KIND:
            if k >= 0 and k >= last("#block"):
                leave(k)
        elif name in BLOCK and last("p") > last("#block"):
            leave(last("p"))
        names = " ".join(filter(None, map(attributes.get, ("class", "id", "role"))))
        is_bad = name in ASIDE or name == "header" and not good or bool(names and name not in ("body", "html", "article", "main") and BAD_NAME.search(names))
        is_good = name in ("article", "main") or bool(names and not is_bad and GOOD_NAME.search(names))
        for kind in kinds(name):
            places.setdefault(kind, []).append(len(stack))
        stack.append((name, is_bad, is_good))
        bad, good, links = bad + is_bad, good + is_good, links + (name == "a")
    close()
    return found


def first_pass(text: str, links: float, in_bad: bool, in_good: bool) -> int:
    if in_bad or links > MOST_LINKS and not in_good:
        return BAD
    if len(text) < SHORT or links > MOST_LINKS:
        return OPEN
    found = WORD.findall(text.lower())
    density = sum(map(STOP_WORDS.__contains__, found)) / max(1, len(found))
    if density >= MANY_STOPS:
        return GOOD
    return BAD if density < FEW_STOPS and not in_good else OPEN


def main_text(page: str | None) -> str:
    """Null, empty or without an article: the empty string."""
    if not page:
        return ""
    found = blocks(page)
    labels = [first_pass(*b) for b in found]
    n = len(found)
    before: list[tuple[int, int] | None] = [None] * n  # nearest decided neighbour: (distance in blocks, label)
    after: list[tuple[int, int] | None] = [None] * n
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        held, inside = None, None
        for i in order:
            if found[i][3] and found[i][2]:
                continue  # what stands apart in the article tells nothing of the article's text
            if found[i][3] != inside:  # the edge of the article ends the search
                held, inside = None, found[i][3]
            side[i] = held and (abs(i - held[0]), held[1])
            if labels[i] != OPEN:
                held = i, labels[i]
    out = []
    for i, (text, _, _, in_good) in enumerate(found):
        label = labels[i]
        if label == OPEN:
            edge = (n + 1, GOOD if in_good else BAD)
            a, b = before[i] or edge, after[i] or edge
            label = a[1] if a[1] == b[1] else GOOD if in_good else min(a, b)[1] if a[0] != b[0] else BAD
        if label == GOOD:
            out.append(text)
    return "\n".join(out)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Returns (id, url, text, n_chars) for each row; other columns are not carried and repeated rows stay repeated.

    n_chars counts code points. A null or empty page has an empty text; a null url or id stays null. A page of any length
    is read whole, in time linear in it. An open block between decided ones at equal distance is no text outside of the
    article. An empty table gives no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["id", "url", "text", "n_chars"])

    picked = df.select(df[id_col].alias("id"), df[url_col].cast("string").alias("url"), df[html_col].alias("html"))
    return picked.mapInArrow(run, f"id {kind}, url string, text string, n_chars bigint").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)

"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each at the end of a path of elements from the root, written as
tags with their first class. Per path the text length, punctuation and link text of all its blocks are summed;
their ratios to the number of blocks are fused into one value. The values, taken in page
order, are smoothed over neighbouring blocks, nearer paths counting more, and paths whose blocks reach the
standard deviation of the page carry content. The content node is the article (or main)
element with most text on such paths; without one, the innermost element that holds nearly all of it. All
blocks of the content node are the text, short ones too, but for the parts that markup names as something else:
menus, headers, footers, sidebars, notices, adverts, forms, shared links, reader comments.

Unclosed tags are closed as HTML5 does for paragraphs, list items, table cells and formatting; a page may
end anywhere. Each page is read once, in time linear in its length; no row leaves its task.

Defined results: a NULL or empty page, and one without text, give an empty text; a page of plain text is
its own text; repeated rows give repeated rows; NULL ids and urls are passed on; an empty table gives no
rows; other columns are ignored. White space is what str.split() cuts at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# HTML elements by what they do to the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol"
    " optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style title textarea iframe noembed noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("head html meta title link base script style noscript template".split())
# What a start tag closes, and what keeps it from looking further out. A block also closes an open p.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"body"}),
}
# Elements, roles and words in classes and ids of what is not the article.
NEVER_TEXT = frozenset(
    "head script style noscript template svg math canvas object audio video select button datalist"
    " textarea iframe title noembed noframes xmp option".split()
)
ASIDE_TAGS = frozenset("nav footer aside dialog menu search".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored sponsors promo"
    " promotion promos banner banners nav navbar navigation menu menus breadcrumb breadcrumbs crumbs pager"
    " pagination toolbar topbar sidebar sidebars aside widget widgets footer copyright colophon comment comments"
    " commentlist disqus respond reply replies responses discussion cookie cookies consent gdpr notice notices"
    " alert alerts popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations teaser teasers trending form forms".split()
)
HEADER_WORDS = frozenset("header masthead".split())
# `has-sidebar` says something about the element, not what it is.
ABOUT_WORDS = frozenset("has with without no not is hide show".split())
# Headings of parts that follow an article, in the languages of the pages.
ASIDE_HEADING = re.compile(
    r"(\d+\s+)?(comments?|replies|responses|leave a (reply|comment)|post a comment|discussion|related( articles| posts"
    r"| stories| links)?|read (more|next)|more (stories|articles|from .*)|you (may|might) also like|share this.*"
    r"|advertisement|kommentare?|kommentar schreiben|antworten|ähnliche (artikel|beiträge)|verwandte artikel"
    r"|commentaires?|laisser un commentaire|réponses|articles (liés|similaires|connexes)|à lire aussi"
    r"|comentarios?|dej[ae] un comentario|respuestas|artículos relacionados|relacionados)\s*(\(\d+\))?\s*:?"
)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MARKS = re.compile(r"[.,;:!?…。，！？、؟۔।]")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in RAW_TEXT}
# Content holds nearly all selected text: the walk to the content node goes on while one child does.
NEARLY_ALL = 0.9
LINK_PART = 0.5
# Weights of a block's own value and of its neighbours' up to two blocks away.
KERNEL = {0: 1.0, 1: 0.6, 2: 0.15}


@dataclass
class Page:
    """The elements of a page in order of their start, and its blocks of text."""

    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: ["root"])
    # Not the article, by its markup: "" (it may be), "sure", or "unless" it holds the article.
    marks: list[str] = field(default_factory=lambda: [""])
    mains: list[bool] = field(default_factory=lambda: [False])
    paths: list[int] = field(default_factory=lambda: [0])
    # A path is a number; its parent and depth tell how near two paths are.
    path_parents: list[int] = field(default_factory=lambda: [-1])
    path_depths: list[int] = field(default_factory=lambda: [0])
    # Blocks: (element, text, characters of link text).
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _named(names: str) -> str:
    """What the words of classes and ids say: "aside", "header" or nothing."""
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in ABOUT_WORDS:
            if not ASIDE_WORDS.isdisjoint(words):
                return "aside"
            if not HEADER_WORDS.isdisjoint(words):
                return "header"
    return ""


def _mark(tag: str, given: dict[str, str], in_main: bool) -> str:
    if tag in ASIDE_TAGS or given.get("role", "").lower() in ASIDE_ROLES:
        return "sure"
    style = given.get("style", "").replace(" ", "").lower()
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style:
        return "sure"
    if tag in ("html", "body", "main", "article"):
        # A layout's names; an article that is a comment says so.
        return "sure" if tag == "article" and in_main and _named(given.get("class", "")) == "aside" else ""
    if tag == "form":
        return "unless"
    named = _named(f"{given.get('class', '')} {given.get('id', '')}") if given else ""
    if named == "aside":
        return "unless"
    # A header inside the article is the article's own.
    return "unless" if (tag == "header" or named == "header") and not in_main else ""


def read_page(source: str) -> Page:
    """Elements and blocks of a page, whatever is left open or cut off."""
    page = Page()
    known_paths: dict[tuple[int, str], int] = {}
    # Open elements: (tag, element, whether its text counts, whether it is a block, in article or main).
    stack = [("root", 0, True, True, False)]
    pieces: list[str] = []
    linked, link_depth = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            page.blocks.append((stack[-1][1], text, linked))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if stack[-1][2] and text:
            text = html.unescape(text)
            pieces.append(text)
            if link_depth:
                linked += len(text.strip())

    def cut(length: int) -> None:
        """Close all elements beyond the first `length`."""
        nonlocal link_depth
        if any(block for _, _, _, block, _ in stack[length:]):
            flush()
        del stack[length:]
        if length < link_depth:
            link_depth = 0

    def opened(tag: str, text: str) -> None:
        block = tag in BLOCKS
        if block:
            flush()
            at = len(stack) - 1
            while not stack[at][3]:
                at -= 1
            if stack[at][0] == "p":
                cut(at)
            elif stack[at][0] == "head" and tag not in HEAD_ONLY:
                cut(at)
        if tag in CLOSES:
            closes, stops = CLOSES[tag]
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in closes:
                    cut(at)
                    break
                if stack[at][0] in stops or (tag in ("li", "dd", "dt") and stack[at][0] in ("table", "td", "th")):
                    break
        _, parent, counts, _, in_main = stack[-1]
        given = _attributes(text) if _TELLING.search(text) else {}
        main = tag in ("article", "main") or given.get("role") == "main" or given.get("itemprop") == "articleBody"
        mark = _mark(tag, given, in_main)
        element = parent
        # Formatting does not lengthen a path.
        if block or mark:
            label = f"{tag}.{given['class'].split()[0]}" if given.get("class", "").strip() else tag
            above = page.paths[parent]
            path = known_paths.setdefault((above, label), len(page.path_parents))
            if path == len(page.path_parents):
                page.path_parents.append(above)
                page.path_depths.append(page.path_depths[above] + 1)
            element = len(page.parents)
            page.parents.append(parent)
            page.tags.append(tag)
            page.marks.append(mark)
            page.mains.append(main)
            page.paths.append(path)
        stack.append((tag, element, counts and tag not in NEVER_TEXT, block, in_main or main))

    def closed(tag: str) -> None:
        block = tag in BLOCKS
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] == tag:
                cut(at)
                return
            # Formatting ends with the block it is in.
            if stack[at][3] and not block:
                return
            if stack[at][0] in ("td", "th") and tag not in ("tr", "table", "tbody", "thead", "tfoot"):
                return

    position, size = 0, len(source)
    while position < size:
        start = source.find("<", position)
        if start < 0:
            add(source[position:])
            break
        after = source[start + 1 : start + 2]
        if after in ("!", "?"):
            add(source[position:start])
            comment = source.startswith("<!--", start)
            end = source.find("-->", start + 4) if comment else source.find(">", start)
            position = size if end < 0 else end + (3 if comment else 1)
            continue
        if not (after.isascii() and after.isalpha()) and after != "/":
            add(source[position : start + 1])
            position = start + 1
            continue
        add(source[position:start])
        found = _TAG.match(source, start)
        if found is None:
            # `</` before anything but a name is a comment; a tag that never ends takes the rest along.
            end = source.find(">", start) if after == "/" else -1
            position = size if end < 0 else end + 1
            continue
        position = found.end()
        tag = found[2].lower()
        if found[1]:
            if tag == "a":
                link_depth = 0
            elif tag == "br":
                add(" ")
            closed(tag)
        elif tag in VOID:
            if tag == "hr":
                flush()
            else:
                add(" " if tag == "br" else "")
        elif tag in RAW_TEXT:
            end = _RAW_END[tag].search(source, position)
            position = size if end is None else end.start()
            opened(tag, "")
        else:
            opened(tag, found[3])
            if tag == "a":
                link_depth = len(stack)
    flush()
    return page


def _path_values(page: Page, blocks: list[tuple[int, str, int]]) -> np.ndarray:
    """Per block: the fused ratios of its path, over all blocks given."""
    paths = np.array([page.paths[element] for element, _, _ in blocks])
    lengths = np.array([len(text) for _, text, _ in blocks], float)
    marks = np.array([len(_MARKS.findall(text)) for _, text, _ in blocks], float)
    links = np.array([linked for _, _, linked in blocks], float)
    _, own, counts = np.unique(paths, return_inverse=True, return_counts=True)
    total = np.bincount(own, lengths)
    text_ratio = total / counts
    mark_ratio = np.bincount(own, marks) / counts
    unlinked = 1 - np.minimum(1, np.bincount(own, links) / total)
    return (text_ratio * (1 + mark_ratio) * unlinked)[own]


def _nearness(page: Page, one: int, other: int) -> float:
    """1 for the same path, less for each step from one path to the other."""
    steps = 0
    while one != other:
        if page.path_depths[one] < page.path_depths[other]:
            one, other = other, one
        one = page.path_parents[one]
        steps += 1
        if steps > 8:
            return 0.0
    return 1 / (1 + steps)


def _smoothed(page: Page, blocks: list[tuple[int, str, int]], values: np.ndarray) -> np.ndarray:
    paths = [page.paths[element] for element, _, _ in blocks]
    smooth = np.empty_like(values)
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - 2), min(len(values), i + 3)):
            share = KERNEL[abs(i - j)] * (1.0 if paths[i] == paths[j] else _nearness(page, paths[i], paths[j]))
            total += share * values[j]
            weight += share
        smooth[i] = total / weight
    return smooth


def _up(page: Page, own: np.ndarray) -> np.ndarray:
    """Sums over each element's subtree; elements come after their parents."""
    sums = own.copy()
    for element in range(len(sums) - 1, 0, -1):
        sums[page.parents[element]] += sums[element]
    return sums


def _article_parts(page: Page) -> np.ndarray:
    """Per element: whether its text may belong to the article."""
    holds = _up(page, np.array([float(m or t == "h1") for m, t in zip(page.mains, page.tags)]))
    holds_main = _up(page, np.array([float(m) for m in page.mains]))
    out = np.zeros(len(page.tags), bool)
    after: dict[int, int] = {}
    for element, text, _ in page.blocks:
        if page.tags[element] in HEADINGS and ASIDE_HEADING.fullmatch(text.lower()):
            parent = page.parents[element]
            if page.tags[parent] in ("section", "div", "ul", "aside") and not holds[parent]:
                out[parent] = True
            else:
                after.setdefault(parent, element)
    for element in range(1, len(out)):
        parent, mark = page.parents[element], page.marks[element]
        keeps = holds_main if page.tags[element] == "header" else holds
        own = mark == "sure" or (mark == "unless" and not keeps[element])
        out[element] |= out[parent] or own or (parent in after and element >= after[parent])
    return ~out


def _content_node(page: Page, weights: np.ndarray, texts: np.ndarray, allowed: np.ndarray) -> int:
    mains = [e for e, main in enumerate(page.mains) if main and allowed[e] and texts[e]]
    for tag in ("article", None):
        found = [e for e in mains if tag is None or page.tags[e] == tag]
        if found:
            return max(found, key=lambda e: (weights[e], texts[e], -e))
    node, children = 0, {}
    for element in range(1, len(page.parents)):
        children.setdefault(page.parents[element], []).append(element)
    while node in children:
        heaviest = max(children[node], key=lambda e: weights[e])
        if page.tags[heaviest] in ("p", "li", "td", "pre") or weights[heaviest] < NEARLY_ALL * weights[node]:
            break
        node = heaviest
    return node


def main_text(source: str | None) -> str:
    """The article of a page, one line per block."""
    if not source:
        return ""
    page = read_page(source)
    allowed = _article_parts(page)
    blocks = [block for block in page.blocks if allowed[block[0]]]
    if not blocks:
        return ""
    values = _smoothed(page, blocks, _path_values(page, blocks))
    content = values >= values.std()
    own_weight, own_text = np.zeros(len(page.tags)), np.zeros(len(page.tags))
    for (element, text, _), selected in zip(blocks, content):
        own_text[element] += len(text)
        own_weight[element] += len(text) * selected
    node = _content_node(page, _up(page, own_weight), _up(page, own_text), allowed)

    inside = np.zeros(len(page.tags), bool)
    inside[node] = True
    for element in range(node + 1, len(inside)):
        inside[element] = inside[page.parents[element]]
        # An article within the article is a comment or a teaser.
        if page.tags[node] == page.tags[element] == "article":
            inside[element] = False
    chosen = [i for i, (element, _, _) in enumerate(blocks) if inside[element]]
    if not page.mains[node]:
        selected = [i for i in chosen if content[i]]
        first, last = (selected[0], selected[-1]) if selected else (0, -1)
        if first and page.tags[blocks[first - 1][0]] in HEADINGS:
            first -= 1
        unlinked = lambda i: blocks[i][2] <= LINK_PART * len(blocks[i][1])
        title = [i for i in range(first) if page.tags[blocks[i][0]] == "h1"][-1:]
        chosen = title + [i for i in chosen if first <= i <= last and (content[i] or unlinked(i))]
        chosen = sorted({*chosen, first} if selected else chosen)
    return "\n".join(blocks[i][1] for i in chosen)


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Per page: its id, url, main text and the text's length in code points."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py()) for source in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            columns.append(pa.array([len(text) for text in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, [id_column, url_column, "text", "n_chars"])

    schema = f"`{id_column}` {kinds[id_column]}, `{url_column}` {kinds[url_column]}, text string, n_chars long"
    return pages.select(id_column, url_column, html_column).mapInArrow(run, schema)

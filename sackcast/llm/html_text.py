"""Operator 9: main text of web pages by two-pass block rules.

Pass 1 classifies each block by link density, length and stop-word density, and
by the elements around it (menus, footers, forms, adverts and the like are
boilerplate; an article's prose is good). Class, id or role marks around the
least marked article or main that holds prose belong to the layout and don't
count in it; marks of an element within it, or of one around further articles
(comments, teasers), do. Pass 2 lets ambiguous short blocks inherit the label of
their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import pieces

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.S | re.I)
_LABEL = re.compile(r"""(?:\b|_)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form menu button select dialog head svg canvas object audio video label input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that mark an element as boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal newsletter subscribe sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead toolbar "
    "comment comments disqus respond reply replies share sharing social related recommended widget search login signup pagination "
    "pager complementary contentinfo form".split())

#: Frequent words of the four languages; fixed values.
STOP_WORDS = frozenset(
    "the of and to in is that for it as was with on be by at this are or from an not have but a they his which you "
    "le la les de des du un une et en est que qui pour dans sur pas par au avec ce il elle ne se plus ou "
    "der die das und ist nicht ein eine zu den von mit sich auf für dem im auch als an es werden aus bei "
    "el los las y una por con para del no su lo como más o si ja al".split())

SHORT, LONG = 70, 200
MOST_LINKS, FEW_STOPS, MANY_STOPS = 0.33, 0.12, 0.25


#: Kinds of boilerplate: by its element or hidden, by a mark only.
HARD, MARKED = 2, 1


def _boilerplate(name: str, attrs: str, inside: bool) -> int:
    """HARD, MARKED or 0."""
    if name in DROPPED or name == "header" and not inside:
        return HARD
    marked = 0
    for match in _LABEL.finditer(attrs):
        key, value = match.group(1).lower(), (match.group(2) or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return HARD
        if key in ("class", "id", "role") and name not in ("html", "body", "article", "main") and not MARKS.isdisjoint(re.split(r"[^a-z0-9]+", value)):
            marked = MARKED
    return marked


class Block:
    __slots__ = ("text", "links", "heading", "inside", "bad", "marks", "frame")

    def __init__(self, text: str, links: int, heading: bool, inside: bool, bad: bool, marks: int = 0, frame: int | None = None):
        self.text, self.links, self.heading, self.inside, self.bad = text, links, heading, inside, bad
        self.marks, self.frame = marks, frame


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order: text with references decoded and white space collapsed."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    words: list[tuple[str, bool]] = []
    state = {"bad": 0, "marks": 0, "inside": 0, "link": 0, "heading": 0}
    frames: list[int] = []  # marks around each article or main that isn't in an article
    opened: list[tuple[int, int | None]] = []  # place in the stack and frame (None: it keeps the outer one) of the open ones

    def flush() -> None:
        text = " ".join(html.unescape("".join(x for x, _ in words)).split())
        if text:
            links = len(" ".join(html.unescape("".join(x for x, link in words if link)).split()))
            out.append(Block(text, links, state["heading"] > 0, state["inside"] > 0, state["bad"] > 0,
                             state["marks"], next((f for _, f in reversed(opened) if f is not None), None)))
        words.clear()

    def shift(name: str, bad: int, by: int) -> None:
        state["bad"] += by * (bad == HARD)
        state["marks"] += by * (bad == MARKED)
        state["inside"] += by * (name in ("article", "main"))
        state["link"] += by * (name == "a")
        state["heading"] += by * (name in HEADINGS)

    def pop_to(k: int) -> None:
        while len(stack) > k:
            shift(*stack.pop(), -1)
            if opened and opened[-1][0] == len(stack):
                opened.pop()

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            words.append((page[at:token.start()], state["link"] > 0))
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            words.append((" ", False))
        if token["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
            continue
        if name in VOID or token["attrs"].rstrip().endswith("/"):
            continue
        if name in BLOCKS:  # an open paragraph ends here, with the inline elements in it
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or name == "li" and stack[k][0] == "li":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        bad = _boilerplate(name, token["attrs"], state["inside"] > 0)
        if name in ("article", "main"):
            own = not any(stack[k][0] == "article" for k, _ in opened)
            opened.append((len(stack), len(frames) if own else None))
            if own:
                frames.append(state["marks"])
        stack.append((name, bad))
        shift(name, bad, 1)
    if at < len(page):
        words.append((page[at:], state["link"] > 0))
    flush()
    prose = {b.frame for b in out if b.frame is not None and not b.bad and not b.heading and b.marks == frames[b.frame]
             and len(b.text) >= SHORT and b.links <= MOST_LINKS * len(b.text)}
    least = min((frames[f] for f in prose or range(len(frames))), default=0)
    for b in out:
        b.bad = b.bad or b.marks > (least if b.frame is not None and frames[b.frame] == least else 0)
    return out


def _first_label(block: Block) -> bool | None:
    """True good, False bad, None ambiguous."""
    if block.bad:
        return False
    if block.links > MOST_LINKS * len(block.text):
        return False
    if block.heading or len(block.text) < SHORT:
        return None
    if block.inside:
        return True
    tokens = [w.strip(".,;:!?%&$#*|()\"'").lower() for w in block.text.split()]
    stops = sum(w in STOP_WORDS for w in tokens) / len(tokens)
    if stops >= MANY_STOPS or stops >= FEW_STOPS and len(block.text) >= LONG:
        return True
    return None if stops >= FEW_STOPS else False


def labels_of(blocks: list[Block]) -> list[bool]:
    first = [_first_label(b) for b in blocks]
    n = len(blocks)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for near, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last = None
        for i in order:
            near[i] = last
            if first[i] is not None:
                last = (i, bool(first[i]))
    out = []
    for i, block in enumerate(blocks):
        if first[i] is not None:
            out.append(bool(first[i]))
            continue
        # the edge of an article counts as good, other neighbours outside it don't count
        sides = [x for x in (before[i], after[i]) if x and (not block.inside or blocks[x[0]].inside and not blocks[x[0]].bad)]
        if block.inside and not sides:
            out.append(True)
        elif block.heading and not block.inside:
            out.append(bool(after[i] and after[i][1]))
        elif not sides:
            out.append(False)
        else:
            least = min(abs(x[0] - i) for x in sides)
            near = {x[1] for x in sides if abs(x[0] - i) == least}
            out.append(near == {True} or block.inside and True in near)
    return out


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, good in zip(blocks, labels_of(blocks)) if good)


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every row of ``pages``.

    Null or empty html gives an empty text; repeated rows each give their row;
    an empty table gives none; further columns are not read.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            texts, counts = [], []
            for page in piece.column("html").to_pylist():
                blocks = blocks_of(page or "")
                good = [b.text for b, yes in zip(blocks, labels_of(blocks)) if yes]
                texts.append("\n".join(good))
                counts.append(len(good))
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64()), pa.array(counts, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"])
    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", f"`{html_column}` as html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")

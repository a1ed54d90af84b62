"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of their DOM.

A page becomes the sequence of its blocks: runs of text between the bounds of block
elements. A block has features of its ancestors (tags, words of their class, id and
role) and of its text; a chain over two labels, main text and the rest, is trained on
labelled pages by the gradient of its likelihood and decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.carried import Carried

# Elements of HTML by how they are read.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul video audio".split()
)
SILENT = frozenset("script style title noscript template textarea iframe noembed noframes object svg math xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOXES = frozenset("article aside body details dialog div fieldset footer form header main menu nav ol search section table ul".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "head", "button", "option", "optgroup"}

# A quote opens a string only where a value begins.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    context: tuple[str, ...]
    linked: int
    main: bool = False


class _Open:
    __slots__ = ("context", "tag")

    def __init__(self, tag: str, attributes: str, above: tuple[str, ...]):
        self.tag, self.context = tag, above
        names = [w for m in ATTRIBUTE.finditer(attributes) for w in WORD.findall(m[2].lower())[:8]]
        if tag in BLOCKS or names:
            own = [f"in:{tag}", *[f"named:{w}" for w in names]]
            if tag in BOXES:  # the innermost of these speaks for itself
                above = tuple(f for f in above if not f.startswith("box"))
                own += [f"box:{tag}", *[f"boxnamed:{w}" for w in names]]
            self.context = tuple(dict.fromkeys((*above, *own)))


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks of a page in order.

    Reads any text: unknown ends are ignored, open elements end with the page, and a
    comment or tag without an end reaches to the end of the page, as browsers have it.
    """
    html = html or ""
    out: list[Block] = []
    stack: list[_Open] = []
    text: list[str] = []
    linked = links = 0
    root: tuple[str, ...] = ()

    def flush(context: tuple[str, ...]) -> None:
        nonlocal linked
        if text:
            joined = SPACE.sub(" ", "".join(text)).strip()
            if joined:
                out.append(Block(joined, context, linked))
            text.clear()
        linked = 0

    at, n = 0, len(html)
    while at < n:
        low = html.find("<", at)
        part = html[at : low if low >= 0 else n]
        if part:  # a reference ends with its run of text
            text.append(entities.unescape(part))
            linked += len(part) if links else 0
        if low < 0:
            break
        follows = html[low + 1 : low + 2]
        if html.startswith("<!--", low):
            at = html.find("-->", low + 4)
            at = at + 3 if at >= 0 else n
            continue
        if follows in ("!", "?") and follows:
            at = html.find(">", low)
            at = at + 1 if at >= 0 else n
            continue
        if not (follows.isascii() and follows.isalpha()) and follows != "/":
            text.append("<")
            at = low + 1
            continue
        m = TAG.match(html, low)
        if m is None:
            if follows == "/" and low + 2 < n and not html[low + 2].isalpha():
                at = html.find(">", low)
                at = at + 1 if at >= 0 else n
                continue
            break
        at, closing, tag = m.end(), bool(m[1]), m[2].lower()
        context = stack[-1].context if stack else root
        if tag in SILENT and not closing:
            if tag != "title":
                text.append(" ")
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(html, at)
            if not m[3].endswith("/"):
                at = html.find(">", end.end()) + 1 if end else n
                at = at or n
            continue
        if tag in BLOCKS:
            flush(context)
        elif tag == "br":
            text.append(" ")
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    links -= sum(x.tag == "a" for x in stack[i:])
                    del stack[i:]
                    break
        elif tag not in VOID:
            ends = "p" if tag in ENDS_PARAGRAPH else None
            if ends or tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag == ends or stack[i].tag == tag != "div" and tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
                        links -= sum(x.tag == "a" for x in stack[i:])
                        del stack[i:]
                        break
                    if stack[i].tag in ("ul", "ol", "table", "div", "article", "section", "body", "td"):
                        break
            if not m[3].endswith("/"):
                stack.append(_Open(tag, m[3], stack[-1].context if stack else root))
                links += tag == "a"
    flush(stack[-1].context if stack else root)
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Features of each block: ancestors, text, place in the page."""
    out = []
    for i, block in enumerate(page):
        text, n = block.text, len(block.text)
        own = ["bias", *block.context, f"length:{min(n, 4000).bit_length()}", f"links:{min(3, 4 * block.linked // max(n, 1))}"]
        own.append("end:" + ("stop" if text[-1] in ".!?…:;" else "letter" if text[-1].isalpha() else "other"))
        own.append(f"commas:{min(3, text.count(','))}")
        own.append(f"words:{min(text.count(' ') + 1, 64).bit_length()}")
        if "©" in text or "(c)" in text:
            own.append("copyright")
        if i == 0:
            own.append("first")
        if i == len(page) - 1:
            own.append("last")
        out.append(own)
    return out


@dataclass
class Field(Carried):
    """Weights of features by label (rest, main), and of label after label."""

    emit: dict[str, tuple[float, float]]
    move: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, page: list[Block]) -> list[bool]:
        """The likeliest labels by Viterbi; between equal ways the rest wins."""
        if not page:
            return []
        (rr, rm), (mr, mm) = self.move
        rest = main = 0.0
        came: list[tuple[bool, bool]] = []
        for i, own in enumerate(features(page)):
            known = [self.emit[f] for f in own if f in self.emit]
            e0, e1 = sum(w[0] for w in known), sum(w[1] for w in known)
            if i:
                to_rest, to_main = main + mr > rest + rr, main + mm > rest + rm
                rest, main = (main + mr if to_rest else rest + rr) + e0, (main + mm if to_main else rest + rm) + e1
                came.append((to_rest, to_main))
            else:
                rest, main = e0, e1
        now = main > rest
        labels = [now]
        for step in reversed(came):
            now = step[now]
            labels.append(now)
        return labels[::-1]


def _log_add(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(pages: list[list[Block]], steps: int = 120, rate: float = 0.15, decay: float = 2e-4) -> Field:
    """A field trained on labelled pages by Adam on the mean log-likelihood with a quadratic penalty."""
    pages = [p for p in pages if p]
    names: dict[str, int] = {}
    rows = [[[names.setdefault(f, len(names)) for f in own] for own in features(p)] for p in pages]
    if not pages:
        return Field({}, ((0.0, 0.0), (0.0, 0.0)))
    longest = max(map(len, rows))
    x = np.zeros((len(rows), longest, len(names)), dtype=np.float32)
    gold = np.zeros((len(rows), longest), dtype=np.int64)
    mask = np.zeros((len(rows), longest), dtype=bool)
    for i, (row, page) in enumerate(zip(rows, pages, strict=True)):
        for t, own in enumerate(row):
            x[i, t, own] = 1
            gold[i, t], mask[i, t] = page[t].main, True
    flat = x.reshape(-1, len(names))
    onehot = np.eye(2)[gold] * mask[..., None]
    pair = mask[:, 1:, None, None] * (np.eye(2)[gold[:, :-1], :, None] * np.eye(2)[gold[:, 1:], None, :])
    w = np.zeros(len(names) * 2 + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        move = w[-4:].reshape(2, 2)
        emit = (flat @ w[:-4].reshape(-1, 2).astype(np.float32)).reshape(len(rows), longest, 2).astype(np.float64)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for t in range(1, longest):
            new = _log_add(forward[:, t - 1, :, None] + move, 1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _log_add((emit[:, t + 1] + backward[:, t + 1])[:, None, :] + move, 2)
            backward[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        total = _log_add(forward[:, -1], 1)[:, None, None]
        single = np.exp(forward + backward - total) * mask[..., None]
        double = np.exp(forward[:, :-1, :, None] + move + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[..., None])
        double *= mask[:, 1:, None, None]
        grad = np.concatenate([(flat.T @ (onehot - single).reshape(-1, 2).astype(np.float32)).ravel(), (pair - double).sum((0, 1)).ravel()])
        grad = grad / len(rows) - decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    emit = w[:-4].reshape(-1, 2)
    return Field({f: (float(emit[i, 0]), float(emit[i, 1])) for f, i in names.items()}, tuple(map(tuple, w[-4:].reshape(2, 2).tolist())))


# Frames in which a labelled page's blocks are set again, so that the field learns more than one way to build a page.
MAIN_FRAMES = [
    "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main">{}</div>',
    '<div class="post-body entry">{}</div>', '<section class="story text">{}</section>', '<div role="main">{}</div>',
    '<main><article class="post">{}</article></main>', "<div>{}</div>",
]
BEFORE_FRAMES = [
    "<nav><ul>{links}</ul></nav>", "<header><h2>{short}</h2><p>{prose}</p></header>", '<div class="menu">{links}</div>',
    '<div class="cookie notice banner"><p>{prose}</p></div>', '<div class="ad advert">{prose}</div>',
    '<ul class="breadcrumbs">{links}</ul>', '<div id="header">{short}</div>', '<form><label>{short}</label><input><button>{short}</button></form>',
    '<div role="navigation">{links}</div>', '<div class="alert notice" role="alert">{prose}</div>', "<aside><p>{prose}</p></aside>",
]
INSIDE_FRAMES = [
    '<aside class="related">{links}</aside>', '<div class="ad">{prose}</div>', "<form><p>{prose}</p><button>{short}</button></form>",
    '<div class="share social">{links}</div>', '<div class="advertisement promo"><p>{prose}</p></div>',
    '<section class="comments"><div class="comment"><p>{prose}</p></div></section>', "<nav>{links}</nav>",
]
AFTER_FRAMES = [
    "<footer>&copy; {short} {prose}</footer>", '<section class="comments"><h3>{short}</h3><div class="comment"><p>{prose}</p></div><div class="comment"><p>{prose}</p></div></section>',
    '<div id="comments"><ol><li class="comment reply"><p>{prose}</p></li></ol></div>', '<aside class="sidebar"><h3>{short}</h3><ul>{links}</ul><p>{prose}</p></aside>',
    '<div id="sidebar" class="widget">{prose}</div>', '<div class="newsletter subscribe"><form><p>{prose}</p></form></div>',
    '<div class="related"><ul>{links}</ul></div>', '<div id="footer">{prose}</div>', '<div class="copyright legal">{prose}</div>',
    '<aside>{prose}</aside>', '<div class="disqus responses"><p>{prose}</p></div>', "<form><p>{prose}</p><button>{short}</button></form>",
]
FILLER = [
    "Home", "About us", "Contact", "Log in", "Search", "Subscribe", "Privacy policy", "Terms of use", "Share", "Next", "Menu", "Archive",
]


# Blocks of a page that teach.
MOST_BLOCKS = 2000
PLAIN_PAGE = (
    "<html><body><nav><a href='/'>Home</a></nav><article><h1>A page without teachers</h1>"
    "<p>This text stands for the articles of a site that marks none. It has sentences of some length, with commas and full stops.</p>"
    "<p>Another paragraph follows the first one. It says no more than that prose comes in blocks.</p>"
    "<ul><li>A short point of a list.</li></ul></article><footer>&copy; All rights reserved.</footer></body></html>"
)


def labelled_pages(pages: list[str], variants: int = 6, seed: int = 3, element: str = "article") -> list[list[Block]]:
    """Training sequences from pages whose ``element`` tells the main text, of each the first MOST_BLOCKS blocks.

    Each page counts as it is, and ``variants`` times with its blocks set in other
    frames: main blocks in a main frame, other pages' prose and links around and inside.
    """
    rng = np.random.default_rng(seed)
    out: list[list[Block]] = []
    parsed = []
    for page in pages:
        found = blocks(page)[:MOST_BLOCKS]
        for b in found:
            b.main = f"in:{element}" in b.context and not any(f"in:{t}" in b.context for t in ("nav", "aside", "form", "footer", "header"))
        if any(b.main for b in found):
            parsed.append(found)
            out.append(found)
    prose = [b.text for p in parsed for b in p if b.main] or ["Text."]
    pick = lambda items: items[int(rng.integers(len(items)))]
    esc = lambda s: entities.escape(s.replace("\x01", " "))

    def frame(template: str) -> str:
        links = "".join(f'<li><a href="/x">{esc(pick([*FILLER, *pick(prose).split()[:3]]))}</a></li>' for _ in range(int(rng.integers(2, 7))))
        while "{prose}" in template:
            template = template.replace("{prose}", "\x02" + esc(pick(prose)[: int(rng.choice([60, 150, 400, 2000]))]).replace("{", "("), 1)
        short = pick([*FILLER, " ".join(pick(prose).split()[:4])])
        return template.replace("{links}", links).replace("{short}", esc(short)).replace("\x02", "")

    for found in parsed:
        own = [b for b in found if b.main]
        for _ in range(variants):
            inner = []
            for i, b in enumerate(own):
                tag = "h1" if i == 0 and "in:h1" in b.context else pick(["p", "p", "p", "p", "li", "blockquote", "h2" if len(b.text) < 80 else "p", "div"])
                inner.append(f"<{tag}>\x01{esc(b.text)}</{tag}>")
                if rng.random() < 0.1:  # a paragraph may be one word
                    inner.append(f"<p>\x01{esc(' '.join(b.text.split()[: int(rng.integers(1, 4))]))}</p>")
                if rng.random() < 0.15:
                    inner.append(frame(pick(INSIDE_FRAMES)))
            before = "".join(frame(pick(BEFORE_FRAMES)) for _ in range(int(rng.integers(0, 4))))
            after = "".join(frame(pick(AFTER_FRAMES)) for _ in range(int(rng.integers(0, 4))))
            page = blocks(f"<html><body>{before}{pick(MAIN_FRAMES).replace('{}', ''.join(inner))}{after}</body></html>")
            for b in page:
                b.main = b.text.startswith("\x01")
                b.text = b.text.removeprefix("\x01")
            out.append([b for b in page if b.text])
    return out


def train(pages: DataFrame, train_pages: int = 80, variants: int = 6, train_chars: int = 200_000) -> Field:
    """A field from at most ``train_pages`` different pages, chosen by a hash of their text, of each the first ``train_chars`` characters.

    Pages with an article element teach; where no page has one, those with a main
    element do. Where there is neither, the field is learned from the frames alone,
    around a built-in article (PLAIN_PAGE).
    """
    for element in ("article", "main"):
        usable = pages.filter(f"html ILIKE '%<{element}%'")
        placed = usable.select(F.substring("html", 1, train_chars).alias("html"), F.xxhash64("html").alias("place"))
        # Hashes are ranked first, so that no task sends pages that are not among the chosen.
        last = placed.select("place").distinct().orderBy("place").limit(train_pages).agg(F.max("place")).first()[0]
        if last is None:
            continue
        sample = placed.filter(F.col("place") <= last).groupBy("place").agg(F.min("html").alias("html"))
        labelled = labelled_pages([r.html for r in sample.collect()], variants, element=element)
        if labelled:
            return fit(labelled)
    return fit(labelled_pages([PLAIN_PAGE], 10 * variants))


def main_text(html: str | None, model: Field) -> str:
    """Main blocks of a page, one a line."""
    page = blocks(html)
    return "\n".join(b.text for b, main in zip(page, model.decode(page), strict=True) if main)


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    text joins the main blocks of the whole page by line feeds: character references are
    decoded, white space inside a block is one space, br counts as white space. A null
    or empty page, or one without main text, has an empty text. Repeated rows and rows
    without ids are rows like others; other columns are not looked at.
    """
    known = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def read(htmls):
        import pandas as pd

        return pd.Series([main_text(h, known.value) for h in htmls], dtype=object)

    texts = pages.select("page_id", "url", read("html").alias("text"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

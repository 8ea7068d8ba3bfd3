"""Main text of web pages: a linear-chain CRF over the leaf blocks of a page.

* Blocks: the markup is read tag by tag into leaf blocks, the runs of text
  between block-level tags, each with its open ancestors.  Scripts, styles,
  comments and other raw elements are no text.  Character references are
  decoded, white space becomes one space.
* Features: the tags of the ancestors, the words of their class, id and role
  attributes, and the block's text (length, link and punctuation shares, ...).
* Model: two labels, main and other; a weight for each feature and label, and
  for each pair of neighbouring labels.  Trained by stochastic gradients on
  the log-likelihood (forward-backward) and decoded by Viterbi.
* Labelled pages: a bounded sample of pages whose markup names the article
  (``article``, ``main``) is labelled by it; menus, asides, forms, footers,
  comments, adverts and notices inside it are other.  As real pages name their
  parts in many ways, each is rewritten: the article and the parts around it
  move into other elements, classes and ids, or into elements without names, and
  asides, notices, forms and comments are added with texts of other pages.  The
  labels are known by construction.  Pages built of fixed bodies are always
  among them, so tables without such markup have a model, too.

A null or empty page, or one without text, has the text "" and 0 characters.
Repeated rows get equal results.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tideline.llm.common import slices

PAGES = 300  # pages that are labelled
VARIANTS = 4  # rewritten copies of each
EPOCHS = 6
RATE = 0.3
RIDGE = 1e-4
EDGE_BLOCKS = 150  # first and last blocks that are kept of a labelled page
EDGE_CHARS = 1000  # first and last characters that are kept of its blocks
BUILT = 40  # built bodies that are always labelled

# Elements of HTML by their role in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea select title".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins del kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br img wbr button input".split())
CLOSED_BY = {  # an open element that the start of another closes
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
PART_TAGS = frozenset("nav aside form footer".split())  # no text of an article, also inside one
COMMENT_NAMES = frozenset("comment comments disqus".split())
PART_NAMES = COMMENT_NAMES | frozenset("ad ads advert adverts advertisement advertising sponsored promo notice cookie cookies alert consent newsletter popup subscribe nav navbar navigation breadcrumb breadcrumbs menu sidebar related complementary contentinfo".split())
OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
MARK = re.compile(r'data-label="(\w+)"')
NAME = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


class Frame:
    """An open element and what its ancestors add up to; the work for one does not
    grow with its depth.

    ``inside`` tells whether the element belongs to the text of an article: it
    lies in ``article`` or ``main`` and in no part of another kind (``dead``).
    """

    __slots__ = ("tag", "own", "above", "hidden", "mark", "inside", "dead", "tags", "names")

    def __init__(self, tag: str, own: tuple[str, ...], above: Frame | None, hidden: bool, mark: str | None, known: Known | None):
        self.tag, self.own, self.above = tag, own, above
        self.hidden = hidden or (above is not None and above.hidden)
        self.mark = mark or (above.mark if above else None)
        self.inside, self.dead = (above.inside, above.dead) if above else (False, False)
        if tag in PART_TAGS and (self.inside or tag != "form"):  # a form may hold a whole page
            self.dead = True
        elif tag in ("article", "main"):
            self.inside = True
            self.dead |= not COMMENT_NAMES.isdisjoint(own)
        elif tag not in ("html", "body"):
            self.dead |= not (PART_NAMES if self.inside else COMMENT_NAMES).isdisjoint(own)
        self.tags = self.names = None
        if known is not None:
            none: frozenset[str] = frozenset()
            self.tags, self.names = (above.tags, above.names) if above else (none, none)
            if tag in known.tags and tag not in self.tags:
                self.tags |= {tag}
            new = [n for n in own if n in known.names and n not in self.names]
            if new:
                self.names |= frozenset(new)

    def listed(self, done: dict[int, tuple[frozenset[str], frozenset[str]]]) -> tuple[frozenset[str], frozenset[str]]:
        """All tags and names from here up; ``done`` has those of other blocks."""
        tags, names, frame = set(), set(), self
        while frame is not None and id(frame) not in done:
            tags.add(frame.tag)
            names.update(frame.own)
            frame = frame.above
        more = done[id(frame)] if frame is not None else (frozenset(), frozenset())
        done[id(self)] = out = (more[0] | tags, more[1] | names)
        return out


@dataclass(frozen=True)
class Known:
    """The tags and names that a model has weights for; ancestors' others need not
    be kept."""

    tags: frozenset[str]
    names: frozenset[str]


class Block:
    """``mark`` is the value of the innermost ``data-label`` of a training page."""

    __slots__ = ("text", "leaf", "tags", "names", "links", "hidden", "mark", "inside")

    def __init__(self, text, leaf, tags, names, links, hidden, mark, inside):
        self.text, self.leaf, self.tags, self.names = text, leaf, tags, names
        self.links, self.hidden, self.mark, self.inside = links, hidden, mark, inside


class _Scanner:
    """Ends of tags, each character looked at a bounded number of times: what is
    once found missing in the rest of the page is not searched for again."""

    def __init__(self, page: str):
        self.page, self.missing = page, set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Where the ``>`` of a tag is, quoted ones left out; a quote that nothing
        closes is a character like others.  -1 without one."""
        while True:
            if ">" in self.missing:
                return -1
            m = STOP.search(self.page, at)
            if not m or m[0] == ">":
                return self.find(">", at) if not m else m.start()
            close = self.find(m[0], m.end())
            at = m.end() if close < 0 else close + 1


def blocks(page: str | None, known: Known | None = None, marks: bool = False, keep: int | None = None) -> list[Block]:
    """Leaf blocks in page order.  Without ``known`` all tags and names of the
    ancestors are listed, of the first and last ``keep`` blocks."""
    page = page or ""
    found: list[tuple[str, Frame | None, float]] = []
    stack: list[Frame] = []
    held: dict[str, int] = {}
    text: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal links
        if text:
            said = SPACE.sub(" ", htmllib.unescape("".join(text))).strip()
            if said:
                found.append((said, stack[-1] if stack else None, min(1.0, links / len(said))))
            text.clear()
        links = 0

    def say(piece: str) -> None:
        nonlocal links
        text.append(piece)
        if linked:
            links += len(piece)

    def pop() -> None:
        held[stack.pop().tag] -= 1

    scan, at, n = _Scanner(page), 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start != at:
            say(page[at:] if start < 0 else page[at:start])
        if start < 0:
            break
        if page.startswith("<!--", start):
            end = scan.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        m = OPEN.match(page, start)
        if not m:
            end = scan.find(">", start) if page.startswith(("<!", "<?"), start) else -1
            if end < 0:
                say("<")
            at = start + 1 if end < 0 else end + 1
            continue
        end = scan.tag_end(m.end())
        if end < 0:
            say(page[start:])
            break
        at, tag, rest = end + 1, m[2].lower(), page[m.end() : end]
        if m[1]:
            if tag in INLINE:
                linked -= tag == "a" and linked > 0
                continue
            flush()
            if held.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
                linked = 0
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                at = close.end() if close else n
            if tag not in INLINE:
                flush()
            continue
        if tag in INLINE:
            if tag == "br":
                say(" ")
            elif tag == "a":
                linked += 1
            continue
        flush()
        linked = 0
        while stack and tag in CLOSED_BY.get(stack[-1].tag, ()):
            pop()
        if tag in VOID:
            continue
        names, hidden, mark = [], False, None
        if len(rest) > 3:
            for a in ATTRIBUTE.finditer(rest):
                key, value = a[1].lower(), (a[2] or "").strip("\"'").lower()
                if key in ("class", "id", "role"):
                    names += NAME.findall(value)
                elif key == "style":
                    hidden |= "display:none" in value.replace(" ", "")
                else:
                    hidden |= value != "false"
            if marks and (own := MARK.search(rest)):
                mark = own[1]
        stack.append(Frame(tag, tuple(names), stack[-1] if stack else None, hidden, mark, known))
        held[tag] = held.get(tag, 0) + 1
    flush()
    out = []
    listed: dict[int, tuple[frozenset[str], frozenset[str]]] = {}
    for said, frame, share in found if keep is None else _edges(found, keep):
        none: frozenset[str] = frozenset()
        if frame is None:
            out.append(Block(said, None, none, none, share, False, None, False))
            continue
        tags, names = (frame.tags, frame.names) if known is not None else frame.listed(listed)
        out.append(Block(said, frame.tag, tags, names, share, frame.hidden, frame.mark, frame.inside and not frame.dead))
    return out


def _bucket(x: float, *steps: float) -> int:
    return sum(x >= s for s in steps)


def features(own: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(own):
        words = b.text.count(" ") + 1
        stops = sum(b.text.count(c) for c in ".,;!?")
        f = ["bias", f"w{_bucket(words, 2, 4, 8, 15, 30, 60)}", f"l{_bucket(b.links, 0.05, 0.3, 0.7, 0.95)}", f"s{_bucket(stops / words, 0.01, 0.05, 0.15, 0.4)}"]
        f.append(f"e{b.text[-1] in '.!?:'}")
        f += [f"t:{t}" for t in b.tags]
        if b.leaf:
            f.append(f"leaf:{b.leaf}")
            f.append(f"leaf:{b.leaf}:w{_bucket(words, 4, 15)}")
        f += [f"n:{n}" for n in b.names]
        if b.hidden:
            f.append("hidden")
        if i == 0:
            f.append("first")
        if i == len(own) - 1:
            f.append("last")
        if "©" in b.text or "all rights" in b.text.lower():
            f.append("rights")
        out.append(f)
    return out


def _scores(x: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    return np.array([weights[f].sum(axis=0) for f in x])


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def marginals(scores: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of each label, and of each pair of neighbours, summed."""
    n = len(scores)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + _log_sum(ahead[i - 1][:, None] + step, 0)
    for i in range(n - 2, -1, -1):
        back[i] = _log_sum(step + (scores[i + 1] + back[i + 1])[None, :], 1)
    total = _log_sum(ahead[-1], 0)
    pairs = np.zeros((2, 2))
    for i in range(n - 1):
        pairs += np.exp(ahead[i][:, None] + step + (scores[i + 1] + back[i + 1])[None, :] - total)
    return np.exp(ahead + back - total), pairs


def viterbi(scores: np.ndarray, step: np.ndarray) -> list[int]:
    (a, b), (c, d) = step.tolist()
    rows = scores.tolist()
    p, q = rows[0]
    back = []
    for x, y in rows[1:]:
        to_0, to_1 = (p + a, q + c), (p + b, q + d)
        back.append((to_0[1] > to_0[0], to_1[1] > to_1[0]))
        p, q = x + max(to_0), y + max(to_1)
    now = int(q > p)
    out = [now]
    for choice in reversed(back):
        now = int(choice[now])
        out.append(now)
    return out[::-1]


class Tagger:
    def __init__(self, names: dict[str, int], weights: np.ndarray, step: np.ndarray):
        if not names:
            raise ValueError("no labelled pages: there is no model of the main text")
        self.names, self.weights, self.step = names, weights, step
        of = lambda kind: frozenset(n[2:] for n in names if n.startswith(kind))
        self.known = Known(of("t:"), of("n:"))

    def main_text(self, page: str | None) -> str:
        own = blocks(page, self.known)
        if not own:
            return ""
        x = [np.array([self.names[f] for f in row if f in self.names], dtype=np.int64) for row in features(own)]
        labels = viterbi(_scores(x, self.weights), self.step)
        return "\n".join(b.text for b, label in zip(own, labels) if label)


def train_on(pages: list[tuple[list[Block], list[int]]], seed: int = 1) -> Tagger:
    names: dict[str, int] = {}
    data = []
    for own, labels in pages:
        if own:
            data.append(([np.array([names.setdefault(f, len(names)) for f in row]) for row in features(own)], np.array(labels)))
    weights, step = np.zeros((max(1, len(names)), 2)), np.zeros((2, 2))
    squares, step_squares = np.full(weights.shape, 1e-6), np.full((2, 2), 1e-6)
    rng = random.Random(seed)
    for _ in range(EPOCHS):
        rng.shuffle(data)
        for x, labels in data:
            chance, pairs = marginals(_scores(x, weights), step)
            chance[np.arange(len(labels)), labels] -= 1
            for f, g in zip(x, chance):
                grad = g + RIDGE * weights[f]
                squares[f] += grad**2
                weights[f] -= RATE * grad / np.sqrt(squares[f])
            np.subtract.at(pairs, (labels[:-1], labels[1:]), 1)
            step_squares += pairs**2
            step -= RATE * pairs / np.sqrt(step_squares)
    return Tagger(names, weights, step)


# -- labelled pages ----------------------------------------------------------

# How pages name their parts.
MAIN = ['article', 'main', 'div class="post-content"', 'div class="entry-content"', 'div id="content"', 'section class="article-body"', 'div class="story"', 'div role="main"', 'div class="text"', 'td']
OTHER = {
    "menu": ['nav', 'div class="menu"', 'ul class="nav navbar"', 'div id="navigation"', 'div class="breadcrumb"', 'div role="navigation"'],
    "header": ['header', 'div id="header"', 'div class="site-header"', 'div class="masthead"', 'div role="banner"'],
    "footer": ['footer', 'div id="footer"', 'div class="site-footer"', 'div class="copyright"', 'div role="contentinfo"'],
    "sidebar": ['aside', 'div class="sidebar"', 'div id="sidebar"', 'div class="widget related"', 'div role="complementary"', 'section class="related-posts"'],
    "notice": ['div class="notice"', 'div id="cookie-banner"', 'div class="alert"', 'div class="cookie-consent"', 'div class="newsletter popup"', 'div role="alert"'],
    "advert": ['div class="ad"', 'div class="advert"', 'div class="ads banner"', 'div class="sponsored promo"', 'div id="ad-top"', 'aside class="ad"'],
    "form": ['form', 'form class="search"', 'form id="subscribe"', 'form class="comment-form"'],
    "comments": ['div class="comments"', 'section id="comments"', 'div class="comment-list"', 'ol class="comments"', 'div id="disqus"', 'div class="comment"'],
}


def rewrite(body: list[Block], texts: list[str], rng: random.Random) -> str:
    """A page around the blocks of an article, with other parts whose texts
    come from ``texts``.  ``data-label`` says which element holds the article.
    Some pages are built of ``div`` without names."""
    bare = rng.random() < 0.15

    def say(words: int) -> str:
        own = rng.choice(texts).split(" ")
        at = rng.randrange(max(1, len(own) - words))
        return " ".join(own[at : at + words])

    def wrap(how: str, inner: str, label: str) -> str:
        return f'<{how} data-label="{label}">{inner}</{how.split(" ")[0]}>'

    def part(kind: str) -> str:
        if kind == "menu":
            inner = "".join(f"<li><a href=/>{say(rng.randint(1, 2))}</a></li>" for _ in range(rng.randint(2, 7)))
        elif kind == "form":
            inner = f"<p>{say(rng.randint(2, 12))}</p><label>{say(2)}</label><input name=q><button>{say(1)}</button>"
        elif kind == "comments":
            inner = "".join(f"<div><b>{say(1)}</b><p>{say(rng.randint(4, 40))}</p></div>" for _ in range(rng.randint(1, 4)))
        elif kind == "sidebar":
            inner = f"<h3>{say(3)}</h3>" + "".join(f"<p>{say(rng.randint(3, 30))}</p>" if rng.random() < 0.5 else f"<a href=/>{say(4)}</a><br>" for _ in range(rng.randint(1, 4)))
        elif kind == "footer":
            inner = ("&copy; " if rng.random() < 0.7 else "") + say(rng.randint(4, 14))
        else:
            inner = say(rng.randint(3, 25)) if rng.random() < 0.6 else f"<p>{say(rng.randint(3, 25))}</p>"
        how = rng.choice(OTHER[kind])
        return wrap("div" if bare else how, inner, "other")

    head = [part(k) for k in ("header", "menu", "notice", "advert") if rng.random() < 0.6]
    tail = [part(k) for k in ("comments", "sidebar", "advert", "form", "footer") if rng.random() < 0.6]
    rng.shuffle(head)
    inner = []
    for b in body:
        tag = b.leaf if b.leaf in ("h1", "h2", "h3", "li", "blockquote", "pre") else "p"
        inner.append(f"<{tag}>{htmllib.escape(b.text)}</{tag}>" if rng.random() < 0.9 else f"<{tag}>{htmllib.escape(b.text)}")
        if rng.random() < 0.04:
            inner.append(part(rng.choice(["advert", "notice", "sidebar"])))
    inner += [part(k) for k in ("form", "comments", "menu", "footer") if rng.random() < 0.1]
    if rng.random() < 0.2:
        tail.insert(0, part("sidebar"))
    how = rng.choice(MAIN)
    article = wrap("div" if bare else how, "".join(inner), "main")
    middle = [article, *tail]
    wrapper = rng.choice(["%s", "<div>%s</div>", '<div class="container">%s</div>', '<div id="page"><div class="wrapper">%s</div></div>'])
    return "<html><body>" + wrapper % "".join([*head, *middle]) + "</body></html>"


def built(n: int = BUILT, seed: int = 7) -> list[list[Block]]:
    """Bodies of articles of a fixed form: a title, then paragraphs and some
    lists, headings and quotes; a few are long."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def say(n: int) -> str:
        return " ".join(rng.choice(words) for _ in range(n))

    def sentence() -> str:
        return say(rng.randint(3, 9)).capitalize() + (", " + say(rng.randint(2, 9)) if rng.random() < 0.6 else "") + rng.choice("....?!")

    out = []
    for _ in range(n):
        body = [("h1", say(rng.randint(2, 9)).capitalize())]
        for _ in range(rng.randint(1, 12) if rng.random() < 0.9 else rng.randint(40, 2 * EDGE_BLOCKS)):
            kind = rng.choice(["p"] * 8 + ["h2", "li", "blockquote"])
            body.append((kind, say(rng.randint(1, 7)).capitalize() if kind == "h2" else " ".join(sentence() for _ in range(rng.randint(1, 2 if kind == "li" else 7)))))
        out.append([Block(text, tag, frozenset([tag]), frozenset(), 0.0, False, None, True) for tag, text in body])
    return out


def labelled(pages: list[str | list[Block]], seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """The pages, given as blocks or as markup, that name an article, with their
    labels, and rewritten pages of their bodies and of the built ones."""
    rng = random.Random(seed)
    out, own = [], []
    for page in pages:
        found = blocks(page) if isinstance(page, str) else page
        labels = [int(b.inside) for b in found]
        if any(labels):
            out.append((found, labels))
            own.append([b for b, label in zip(found, labels) if label])
    own += built()
    texts = [b.text for body in own for b in body if " " in b.text]
    for body in own:
        for _ in range(VARIANTS):
            cut = body[: rng.randint(1, len(body))]
            found = blocks(rewrite(cut, texts, rng), marks=True)
            out.append((found, [int(b.mark == "main") for b in found]))
    return out


def _edges(x, n: int):
    return x if len(x) <= 2 * n else x[:n] + x[-n:]


BLOCK = "array<struct<text:string,leaf:string,tags:array<string>,names:array<string>,links:double,hidden:boolean,inside:boolean>>"


def _parser(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as blocks; the middle of a long page or block is left out."""
    kind = pa.list_(pa.struct([("text", pa.string()), ("leaf", pa.string()), ("tags", pa.list_(pa.string())), ("names", pa.list_(pa.string())), ("links", pa.float64()), ("hidden", pa.bool_()), ("inside", pa.bool_())]))
    for part in slices(parts):
        pages = []
        for page in part.column("html"):
            own = blocks(page.as_py(), keep=EDGE_BLOCKS)
            pages.append([{"text": _edges(b.text, EDGE_CHARS), "leaf": b.leaf, "tags": sorted(b.tags), "names": sorted(b.names), "links": b.links, "hidden": b.hidden, "inside": b.inside} for b in own])
        yield pa.RecordBatch.from_arrays([part.column("h"), pa.array(pages, kind)], names=["h", "blocks"])


def train(pages: DataFrame, rows: int = PAGES) -> Tagger:
    """A tagger trained on at most ``rows`` different pages, the first by a hash,
    of any length, and on built ones."""
    hashed = pages.select("html", F.xxhash64("html").alias("h"))
    named = hashed.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    first = [r["h"] for r in named.select("h").distinct().orderBy("h").limit(rows).collect()]  # a bounded sample
    sample = hashed.filter(F.col("h").isin(first)).groupBy("h").agg(F.first("html").alias("html"))
    found = sorted(sample.mapInArrow(_parser, f"h long, blocks {BLOCK}").collect(), key=lambda r: r["h"]) if first else []
    return train_on(labelled([[Block(b["text"], b["leaf"], frozenset(b["tags"]), frozenset(b["names"]), b["links"], b["hidden"], None, b["inside"]) for b in r["blocks"]] for r in found]))


def extract(pages: DataFrame, tagger: Tagger) -> DataFrame:
    """``pages`` with ``__tl_text``."""
    names = [*pages.columns, "__tl_text"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts = [tagger.main_text(h.as_py()) for h in part.column("html")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=names)

    return pages.mapInArrow(run, StructType([*pages.schema.fields, StructField("__tl_text", StringType())]))

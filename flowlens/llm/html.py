"""Main text of pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each
with the path of open elements (tag names, ``class``, ``id`` and ``role``
words).  A bidirectional LSTM in numpy reads one vector per block (hashed tag
path, hashed words, a few counts), so each block is classified in the light of
the whole page; blocks labelled as article text are joined in page order.

Training: there are no labels for pages, so the labeller is trained on page
templates filled with the text of :data:`SAMPLE_PAGES` pages (least id
digests, at most :data:`SAMPLE_CHARS` characters of each): layouts, container
names and inner structure are drawn at random, and the template knows which
blocks are the article.  The sample is the only bounded part: every page and
every block is labelled.

Character references are decoded, white space inside a block becomes one
space, ``script``, ``style``, ``textarea`` and ``title`` and comments are no text.
Text in ``select``, ``noscript``, ``template``, ``iframe``, ``object``, ``svg``
and ``math`` is labelled like any other; left open, these end with the element
around them, and ``select``, ``svg`` and ``math`` at the next block-level tag.

Edge cases: null and empty pages have no blocks and an empty text; unclosed,
misnested and unknown tags are tolerated; very long pages are read in full;
repeated rows are extracted row by row; other columns are not read; an empty
table gives no rows (and an untrained labeller is never asked).
"""

from __future__ import annotations

import html as _html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, chunks

SAMPLE_PAGES = 200
SAMPLE_CHARS = 20_000
TRAIN_PAGES = 1_200
EPOCHS = 8
PATH_DIM, WORD_DIM, COUNTS, HIDDEN = 512, 128, 6, 16
WORD_WEIGHT = 0.5
SHARD_BYTES = 4 << 20

# HTML element classes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title"}
#: Text in these is a block of its own, though they may stand in a paragraph.
APART = {"select", "noscript", "template", "iframe"}
#: A block-level tag ends these if open, but not from inside the second set.
FOREIGN, FOREIGN_BARRIER = {"select", "svg", "math"}, {"foreignobject", "annotation-xml", "desc"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd", "details",
         "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
         "h5", "h6", "head", "header", "hr", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "option",
         "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: An opening tag ends these open elements, up to the nearest of the barriers.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"ul", "ol", "dl", "table", "menu", "select"}
INLINE_PARENTS = {"p", "b", "i", "em", "strong", "a", "span", "u", "small", "font", "code"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)",
                    re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def blocks_of(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """Leaf blocks: path (tag and attribute words, outermost first), text,
    and characters of the text inside links."""
    out: list = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = 0
    path: tuple[str, ...] = ()

    def flush():
        nonlocal held, linked
        if held:
            text = _SPACE.sub(" ", _html.unescape("".join(held))).strip()
            if text:
                out.append((path, text, linked))
        held, linked = [], 0

    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        text = m.group(4)
        if text == "<" and (page[pos:pos + 1].isalpha() or page[pos:pos + 1] == "/"):
            end = page.find(">", pos)  # a tag with unpaired quotes, or one that never closes
            if end < 0:
                break
            pos = end + 1
            continue
        if text is not None:
            if not held:
                path = tuple(w for _, words in stack for w in words)
            held.append(text)
            if any(t == "a" for t, _ in stack[-3:]):
                linked += len(text)
            continue
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK or tag in APART:
            flush()
        if m.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        attrs = m.group(3)
        if tag in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and tag != "option":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in FOREIGN_BARRIER:
                    break
                if stack[i][0] in FOREIGN:
                    del stack[i:]
                    break
        if tag in ENDS:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in BARRIER:
                    break
                if stack[i][0] in ENDS[tag]:
                    del stack[i:]
                    break
        elif tag in BLOCK:  # ends an open paragraph and inline elements left open in it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE_PARENTS:
                    break
        if attrs.endswith("/") and tag not in BLOCK:
            continue
        words = [tag]
        for a in _ATTR.finditer(attrs):
            value = (a.group(2) or a.group(3) or a.group(4) or "").lower()
            words += ["." + w for w in _NAME.findall(value)]
        stack.append((tag, tuple(words)))
    flush()
    return out


def _h(s: str, dim: int) -> int:
    return zlib.crc32(s.encode()) % dim


def features(blocks: list) -> tuple[list[list[int]], np.ndarray]:
    """Per block: rows of the input matrix its path and words select, and counts."""
    ids, counts = [], np.zeros((len(blocks), COUNTS), np.float32)
    for i, (path, text, linked) in enumerate(blocks):
        own = {_h(w, PATH_DIM) for w in path if w not in ("html", "body")}
        if path:
            own.add(_h("leaf " + path[-1], PATH_DIM))
        words = text.split(" ")
        ids.append(sorted(own) + sorted({PATH_DIM + _h(w.lower().strip(".,:;!?()"), WORD_DIM) for w in words}))
        counts[i] = (np.log1p(len(words)) / 5, linked / max(len(text), 1), text[-1] in ".!?", len(words) < 4,
                     i / max(len(blocks), 1), 1.0)
    return ids, counts


def _weighted(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Selected rows, flat, and their weights: path words 1, the words of a
    block together :data:`WORD_WEIGHT`."""
    flat = np.fromiter((j for x in ids for j in x), np.int64)
    block = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    word = flat >= PATH_DIM
    words = np.bincount(block[word], minlength=len(ids))
    return flat, np.where(word, WORD_WEIGHT / np.maximum(words[block], 1), 1.0).astype(np.float32)


class Labeller:
    """A bidirectional LSTM over blocks, with a logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = PATH_DIM + WORD_DIM + COUNTS, HIDDEN
        self.p = {}
        for side in "fb":
            self.p["x" + side] = (r.standard_normal((d, 4 * h)) * 0.1).astype(np.float32)
            self.p["h" + side] = (r.standard_normal((h, 4 * h)) * 0.2).astype(np.float32)
            self.p["c" + side] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)
        self.p["o"] = (r.standard_normal(2 * h + 1) * 0.1).astype(np.float32)

    def inputs(self, ids: list[list[int]], counts: np.ndarray) -> dict[str, np.ndarray]:
        """Pre-activations of all blocks: the sum of the selected rows."""
        flat, weight = _weighted(ids)
        start = np.concatenate([[0], np.cumsum([len(x) for x in ids])[:-1]]).astype(np.int64)
        out = {}
        for side in "fb":
            w = self.p["x" + side]
            out[side] = (np.add.reduceat(w[flat] * weight[:, None], start, axis=0) + counts @ w[-COUNTS:]
                         + self.p["c" + side])
        return out

    @staticmethod
    def _gates(z, c):
        h = HIDDEN
        i, f, o = (1 / (1 + np.exp(-z[:, k * h:(k + 1) * h])) for k in (0, 1, 2))
        g = np.tanh(z[:, 3 * h:])
        c = f * c + i * g
        return i, f, o, g, c, np.tanh(c)

    def run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states over (time, page) pre-activations; masked steps hold."""
        steps, pages = mask.shape
        hs = np.zeros((steps, pages, HIDDEN), np.float32)
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            i, f, o, g, c2, tc = self._gates(x[t] + h @ self.p["h" + side], c)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, c2, tc, m))
            h, c = np.where(m, o * tc, h), np.where(m, c2, c)
            hs[t] = h
        return hs

    def scores(self, pages: list[tuple[list, np.ndarray]]) -> list[np.ndarray]:
        """Log-odds of article text for the blocks of each page."""
        out: list = [np.zeros(0, np.float32)] * len(pages)
        order = [k for k in sorted(range(len(pages)), key=lambda k: len(pages[k][0])) if pages[k][0]]
        for at in range(0, len(order), 256):
            some = order[at:at + 256]
            x = self.inputs([b for k in some for b in pages[k][0]], np.concatenate([pages[k][1] for k in some]))
            size = np.array([len(pages[k][0]) for k in some])
            page = np.repeat(np.arange(len(some)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            mask = np.arange(size.max())[:, None] < size
            hidden = []
            for side in "fb":
                z = np.zeros((size.max(), len(some), 4 * HIDDEN), np.float32)
                z[step, page] = x[side]
                hidden.append(self.run(z, mask, side)[step, page])
            s = np.concatenate([*hidden, np.ones((len(step), 1), np.float32)], axis=1) @ self.p["o"]
            for k, part in zip(some, np.split(s, np.cumsum(size)[:-1])):
                out[k] = part
        return out

    def train(self, pages: list[tuple[list, np.ndarray]], labels: list[np.ndarray], epochs: int = EPOCHS,
              rate: float = 0.01, seed: int = 1) -> None:
        """Adam on the logistic loss, back-propagated through time."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        var = {k: np.zeros_like(v) for k, v in self.p.items()}
        turn, h = 0, HIDDEN
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), 32):
                some = [k for k in order[at:at + 32] if pages[k][0]]
                if not some:
                    continue
                # Words are dropped in most blocks: the path must do as well.
                ids = [[j for j in b if j < PATH_DIM or keep] for k in some for b in pages[k][0]
                       for keep in [rng.random() < 0.3]]
                counts = np.concatenate([pages[k][1] for k in some])
                y = np.concatenate([labels[k] for k in some]).astype(np.float32)
                x = self.inputs(ids, counts)
                size = np.array([len(pages[k][0]) for k in some])
                page = np.repeat(np.arange(len(some)), size)
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                mask = np.arange(size.max())[:, None] < size
                kept, hidden = {"f": [], "b": []}, {}
                for side in "fb":
                    z = np.zeros((size.max(), len(some), 4 * h), np.float32)
                    z[step, page] = x[side]
                    hidden[side] = self.run(z, mask, side, kept[side])
                top = np.concatenate([hidden["f"][step, page], hidden["b"][step, page],
                                      np.ones((len(step), 1), np.float32)], axis=1)
                err = (1 / (1 + np.exp(-(top @ self.p["o"]))) - y) / len(some)
                grad = {"o": err @ top}
                back = np.outer(err, self.p["o"][:-1])
                flat, weight = _weighted(ids)
                owner = np.repeat(np.arange(len(ids)), [len(b) for b in ids])
                for side, part in (("f", back[:, :h]), ("b", back[:, h:])):
                    dh_in = np.zeros((size.max(), len(some), h), np.float32)
                    dh_in[step, page] = part
                    dz_all = np.zeros((size.max(), len(some), 4 * h), np.float32)
                    w = self.p["h" + side]
                    gw = np.zeros_like(w)
                    dh, dc = np.zeros((len(some), h), np.float32), np.zeros((len(some), h), np.float32)
                    for t, h0, c0, i, f, o, g, _c2, tc, m in reversed(kept[side]):
                        dh = dh + dh_in[t]
                        d_h, d_c = np.where(m, dh, 0), np.where(m, dc, 0)
                        d_c = d_c + d_h * o * (1 - tc * tc)
                        dz = np.concatenate([d_c * g * i * (1 - i), d_c * c0 * f * (1 - f), d_h * tc * o * (1 - o),
                                             d_c * i * (1 - g * g)], axis=1)
                        dz_all[t] = dz
                        gw += h0.T @ dz
                        dh, dc = np.where(m, dz @ w.T, dh), np.where(m, d_c * f, dc)
                    dzs = dz_all[step, page]
                    gx = np.zeros_like(self.p["x" + side])
                    np.add.at(gx, flat, dzs[owner] * weight[:, None])
                    gx[-COUNTS:] += counts.T @ dzs
                    grad |= {"x" + side: gx, "h" + side: gw, "c" + side: dzs.sum(axis=0)}
                turn += 1
                for k, g in grad.items():
                    g = np.clip(g, -5, 5)
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    var[k] = 0.99 * var[k] + 0.01 * g * g
                    self.p[k] -= (rate * (mean[k] / (1 - 0.9 ** turn)) / (
                        np.sqrt(var[k] / (1 - 0.99 ** turn)) + 1e-6)).astype(np.float32)


# ------------------------------------------------------------ page templates

# Names that page authors give to containers.
GOOD = ["article", "main", "content", "post", "entry", "story", "body", "text", "post-content", "entry-content",
        "article-body", "main-content", "page-content"]
BAD = {"menu": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "links", "tabs"],
       "header": ["header", "masthead", "topbar", "banner", "site-header", "logo"],
       "footer": ["footer", "site-footer", "copyright", "bottom", "legal"],
       "side": ["sidebar", "aside", "widget", "related", "recommended", "trending", "toc", "rail"],
       "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "popup", "modal", "gdpr", "toast"],
       "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion"],
       "form": ["form", "search", "newsletter", "subscribe", "signup", "login", "contact-form"],
       "comments": ["comments", "comment", "replies", "discussion", "comment-list", "responses", "disqus"],
       "share": ["share", "social", "tags", "meta", "pagination", "pager"]}
TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"],
        "side": ["aside", "div", "section"], "notice": ["div", "section", "aside"], "ad": ["div", "aside", "section"],
        "form": ["form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul"]}


def _template(rng: np.random.Generator, texts: list[str]) -> list[tuple[str, bool]]:
    """Pieces of a page: markup, and whether its text is the article's."""
    def some(a, b):
        n = int(rng.integers(a, b))
        return [_html.escape(texts[int(rng.integers(len(texts)))]) for _ in range(n)]

    def few(text):
        words = text.split(" ")
        return " ".join(words[:int(rng.integers(1, 7))])

    def pick(x):
        return x[int(rng.integers(len(x)))]

    def name(words):
        w = pick(words)
        return "" if rng.random() < 0.25 else f' {pick(["class", "id", "class"])}="{w}{pick(["", "", "-1", " box"])}"'

    def bad(kind):
        tag = pick(TAGS[kind])
        attr = name(BAD[kind])
        if not attr and (tag in ("div", "section", "ul", "ol") or kind in ("notice", "ad")):
            attr = f' class="{pick(BAD[kind])}"'
        out = [(f"<{tag}{attr}>", False)]
        if kind == "menu" or kind == "share":
            inner = [f'<li><a href="/{i}">{few(t)}</a></li>' for i, t in enumerate(some(2, 8))]
            out.append((("<ul>" + "".join(inner) + "</ul>") if tag != "ul" else "".join(inner), False))
        elif kind == "form":
            out.append((f"<label>{few(some(1, 2)[0])}</label><input name=q><button>{few(some(1, 2)[0])}</button>"
                        f"<p>{some(1, 2)[0]}</p>", False))
            if rng.random() < 0.4:
                out.append(("<select>" + "".join(f"<option>{few(t)}" for t in some(1, 6)) + "</select>", False))
        elif kind == "comments":
            item = pick(["div", "li", "article"])
            out += [(f'<{item} class="{pick(["comment", "reply", "comment-body"])}"><p>{t}</p></{item}>', False)
                    for t in some(1, 5)]
        else:
            plain = rng.random() < 0.5
            out += [(t if plain and i == 0 else f'<{pick(["p", "p", "div", "h3", "h4"])}>{t}', False)
                    for i, t in enumerate(some(1, 4))]
        return [*out, (f"</{tag}>", False)]

    page = [("<html><body>", False)]
    for kind in ("menu", "header", "notice", "ad"):
        if rng.random() < 0.6:
            page += bad(kind)
    if rng.random() < 0.2:
        page.append((f"<{(t := pick(['noscript', 'template', 'select', 'iframe']))}>{few(some(1, 2)[0])}</{t}>", False))
    if rng.random() < 0.1:  # never closed
        page.append((f"<{pick(['object', 'svg', 'select', 'noscript', 'template'])}>", False))
    if rng.random() < 0.3:
        page += bad("side")
    tag = pick(["article", "article", "main", "div", "section"])
    attr = name(GOOD)
    if tag in ("div", "section") and not attr:
        attr = f' class="{pick(GOOD)}"'
    wrap = rng.random() < 0.3
    page.append(("<main>" if wrap else "", False))
    page.append((f"<{tag}{attr}>", True))
    head = few(some(1, 2)[0]) if rng.random() < 0.6 else some(1, 2)[0]
    page.append((pick(["<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>"]).format(head), True))
    for t in some(0, 9) if rng.random() < 0.9 else some(10, 40):
        roll = rng.random()
        if roll < 0.7:
            page.append((f"<p>{t}</p>", True))
        elif roll < 0.78:
            page.append((f"<p><b>{t}<br>", True))
        elif roll < 0.84:
            page.append((f"<h2>{few(t)}</h2>", True))
        elif roll < 0.9:
            page.append((f"<ul><li>{t}</li><li>{few(t)}</li></ul>", True))
        elif roll < 0.92:
            page.append((f"<blockquote>{t}</blockquote>", True))
        elif roll < 0.94:
            page.append((f"<object><p>{t}</p></object>", True))
        elif roll < 0.95:
            page.append((f"<noscript>{few(t)}</noscript>", False))
        else:
            page += bad(pick(["ad", "share", "side", "form", "notice"]))
    if rng.random() < 0.25:
        page += bad("comments")
    page.append((f"</{tag}>" + ("</main>" if wrap else ""), False))
    for kind in ("side", "comments", "form", "share", "ad", "notice"):
        if rng.random() < 0.25:
            page += bad(kind)
    if rng.random() < 0.8:
        page += bad("footer")
    return page


def training_set(texts: list[str], n: int, seed: int = 3) -> tuple[list, list]:
    """Blocks and labels of ``n`` generated pages."""
    rng = np.random.default_rng(seed)
    pages, labels = [], []
    for _ in range(n):
        parts = _template(rng, texts)
        # The label travels with the text as a mark that the cutter keeps.
        marked = "".join(re.sub(r">([^<]+)", lambda m, g=good: f">{chr(1) if g else chr(2)}{m.group(1)}",
                                p if p.startswith("<") else "<span>" + p + "</span>") if p else "" for p, good in parts)
        blocks = blocks_of(marked)
        labels.append(np.array([t.lstrip()[0] == chr(1) for _, t, _ in blocks]))
        pages.append([(p, re.sub("[\x01\x02]", "", t) or "x", k) for p, t, k in blocks])
    return pages, labels


def trained(sample: list[str]) -> Labeller:
    """A labeller for templates filled with the texts of sample pages."""
    texts = [t for page in sample for _, t, _ in blocks_of(page[:SAMPLE_CHARS])] or ["text"]
    pages, labels = training_set(texts, TRAIN_PAGES)
    model = Labeller()
    model.train([features(b) for b in pages], labels)
    return model


def _extract(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in chunks(batches, SHARD_BYTES):
            pages = [blocks_of(p) if p else [] for p in tab["html"].to_pylist()]
            scores = model.value.scores([features(b) for b in pages])
            out = [" ".join(t for (_, t, _), s in zip(b, sc.tolist()) if s > 0) for b, sc in zip(pages, scores)]
            done = tab.drop_columns(["html"]).append_column("text", pa.array(out, pa.string()))
            done = done.append_column("n_chars", pa.array([len(t) for t in out], pa.int64()))
            yield from done.to_batches()
    return run


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    spark = pages.sparkSession
    arrow_batches(spark)
    ids = [r[0] for r in pages.select("page_id").where("page_id is not null").distinct()
           .orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES).collect()]
    sample = [r[0] for r in pages.where(F.col("page_id").isin(ids) & F.col("html").isNotNull())
              .select(F.substring("html", 1, SAMPLE_CHARS).alias("h")).orderBy(F.xxhash64("h"), "h")
              .limit(2 * SAMPLE_PAGES).collect()]
    model = spark.sparkContext.broadcast(trained(sample))  # some 700 kB, by the constants above
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract(model), f"page_id {kinds['page_id']}, url string, text string, n_chars bigint")

"""Main text of web pages: a bidirectional LSTM over the blocks of a page, in numpy."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import replace
from html import escape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import Block, blocks_of

#: Buckets and sizes of the path and word vectors, size of each direction's state.
PATHS, PATH_SIZE, WORDS, WORD_SIZE, STATE = 1024, 16, 1024, 6, 12
NUMBERS = 5
#: Pages learned from, the most blocks of a stretch of one, and the most characters of a page learned from as it stands.
SAMPLE, MOST_BLOCKS, MOST_CHARS = 400, 60, 60_000

# Names by which the teacher knows parts of a page.
#: Elements and class names that hold the article.
MAIN_TAGS = ("article", "main")
MAIN_NAMES = "content post entry story article body text main prose".split()
#: Elements and class names that hold something else, wherever they stand.
OTHER_TAGS = ("nav", "footer", "aside", "form", "header", "menu", "dialog", "search")
OTHER_NAMES = """ad ads advert advertisement banner sponsored sponsor promo promotion nav navbar navigation menu breadcrumb
breadcrumbs header masthead topbar footer bottom copyright sidebar aside widget related recommended trending popular tags
share social follow comment comments reply replies disqus discussion respond cookie cookies consent gdpr notice alert popup
modal overlay newsletter subscribe signup login search form pagination pager skip toolbar disclaimer legal""".split()

_MAIN, _OTHER = frozenset(MAIN_NAMES), frozenset(OTHER_NAMES)
#: Elements that say what a part of a page is.
SECTIONS = frozenset((*MAIN_TAGS, *OTHER_TAGS, "section"))


def taught(block: Block) -> int:
    """The teacher's label of a block: 1 in an article and in nothing that is not the article's text.

    Headings of an article count as its text, also within its own header.
    """
    inside = heading = False
    for tag, names in block.path:
        heading |= tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        inside |= tag in MAIN_TAGS
    for tag, names in block.path:
        if tag in OTHER_TAGS and not (tag == "header" and inside and heading):
            return 0
        if not _OTHER.isdisjoint(names):
            return 0
        inside |= not _MAIN.isdisjoint(names)
    return int(inside)


def hidden(blocks: list[Block]) -> list[Block]:
    """The blocks as a page without class names and sectioning elements would have them: all of these are ``div``."""

    def plain(path: tuple) -> tuple:
        return tuple(dict.fromkeys(("div" if tag in SECTIONS else tag, ()) for tag, _ in path))

    return [replace(b, path=plain(b.path), inner="div" if b.inner in SECTIONS else b.inner) for b in blocks]


class WordBuckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % WORDS
        return value


class PathBuckets(dict):
    """Buckets of the names in a block's whole path and of its innermost tag, kept by a hash of these."""

    def of(self, block: Block) -> np.ndarray:
        key = hash((block.path, block.inner))
        if key not in self:
            if len(self) > 1 << 14:
                self.clear()
            parts = {f"{tag}" for tag, _ in block.path} | {f".{n}" for _, names in block.path for n in names}
            parts |= {f"{tag}.{n}" for tag, names in block.path for n in names}
            if block.path:
                parts.add(f"/{block.inner}")
            hashes = sorted({xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) % PATHS for p in parts})
            self[key] = np.array(hashes or [0], np.int64)
        return self[key]


def numbers_of(blocks: list[Block]) -> np.ndarray:
    """Size, words, share of links, ending and place of every block of a page."""
    size = np.array([len(b.text) for b in blocks], np.float32)
    count = np.array([len(b.text.split()) for b in blocks], np.float32)
    links = np.array([b.links for b in blocks], np.float32)
    place = np.arange(len(blocks), dtype=np.float32) / max(len(blocks), 1)
    ends = np.array([b.text[-1] in ".!?…\"”)" for b in blocks], np.float32)
    return np.stack([np.log1p(size) / 5, np.log1p(count) / 4, np.minimum(links / size, 1), ends, place], 1)


class Described:
    """What the network reads of the blocks of one page, or of a stretch of them with the numbers they have in the page."""

    def __init__(self, blocks: list[Block], paths: PathBuckets, words: WordBuckets, numbers: np.ndarray | None = None):
        self.paths = [paths.of(b) for b in blocks]
        split = [b.text.split() for b in blocks]
        self.words = [np.fromiter(map(words.__getitem__, w), np.int64, len(w)) for w in split]
        self.numbers = numbers_of(blocks) if numbers is None else numbers


class Direction:
    """One direction of the LSTM; weights of the input, forget, output and candidate gates side by side."""

    def __init__(self, draw: np.random.Generator, inputs: int):
        self.w = draw.normal(0, 0.2, (inputs + STATE, 4 * STATE)).astype(np.float32)
        self.b = np.zeros(4 * STATE, np.float32)
        self.b[STATE : 2 * STATE] = 1

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States for inputs of shape (steps, pages, size); masked steps pass the state on."""
        steps, n, _ = x.shape
        h = np.zeros((n, STATE), np.float32)
        c = np.zeros((n, STATE), np.float32)
        out, cache = np.empty((steps, n, STATE), np.float32), []
        given = x @ self.w[: x.shape[2]] + self.b
        for t in range(steps):
            z = given[t] + h @ self.w[x.shape[2] :]
            gates = 1 / (1 + np.exp(-z[:, : 3 * STATE]))
            i, f, o = gates[:, :STATE], gates[:, STATE : 2 * STATE], gates[:, 2 * STATE :]
            g = np.tanh(z[:, 3 * STATE :])
            new = f * c + i * g
            squashed = np.tanh(new)
            m = mask[t][:, None]
            if keep:
                cache.append((h, c, i, f, o, g, squashed, m))
            c = np.where(m, new, c)
            h = np.where(m, o * squashed, h)
            out[t] = h
        return out, cache

    def backward(self, x: np.ndarray, cache: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of inputs, weights and biases."""
        dw, db = np.zeros_like(self.w), np.zeros_like(self.b)
        dx = np.empty_like(x)
        dh = np.zeros_like(dout[0])
        dc = np.zeros_like(dout[0])
        size = x.shape[2]
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, squashed, m = cache[t]
            dh = dh + dout[t]
            here, past = np.where(m, dh, 0), np.where(m, 0, dh)
            dnew = np.where(m, dc, 0) + here * o * (1 - squashed**2)
            dz = np.concatenate(
                (dnew * g * i * (1 - i), dnew * c * f * (1 - f), here * squashed * o * (1 - o), dnew * i * (1 - g**2)), 1
            )
            dw[:size] += x[t].T @ dz
            dw[size:] += h.T @ dz
            db += dz.sum(axis=0)
            dx[t] = dz @ self.w[:size].T
            dh = past + dz @ self.w[size:].T
            dc = np.where(m, dnew * f, dc)
        return dx, dw, db


class BlockLabeller:
    """A bidirectional LSTM over the blocks of a page that tells article text from the rest.

    A block is read as the mean vector of its path's names, the mean vector of its hashed
    words and a few numbers; both directions' states decide on every block, so each sees
    the whole page.
    """

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.path = draw.normal(0, 0.3, (PATHS, PATH_SIZE)).astype(np.float32)
        self.word = draw.normal(0, 0.1, (WORDS, WORD_SIZE)).astype(np.float32)
        inputs = PATH_SIZE + WORD_SIZE + NUMBERS
        self.ways = (Direction(draw, inputs), Direction(draw, inputs))
        self.out = draw.normal(0, 0.2, 2 * STATE).astype(np.float32)
        self.last = np.zeros(1, np.float32)
        self.fitted = False

    def _params(self) -> dict[str, np.ndarray]:
        a, b = self.ways
        return {
            "path": self.path, "word": self.word, "w0": a.w, "b0": a.b, "w1": b.w, "b1": b.b, "out": self.out, "last": self.last,
        }

    def _inputs(self, pages: list[Described]) -> tuple[np.ndarray, np.ndarray, tuple]:
        steps = max(len(p.paths) for p in pages)
        mask = np.zeros((steps, len(pages)), bool)
        x = np.zeros((steps, len(pages), PATH_SIZE + WORD_SIZE + NUMBERS), np.float32)
        at = [(t, i) for i, p in enumerate(pages) for t in range(len(p.paths))]
        t, i = (np.array(v) for v in zip(*at))
        mask[t, i] = True
        path = [v for p in pages for v in p.paths]
        word = [v for p in pages for v in p.words]
        sizes = [np.array([len(v) for v in group]) for group in (path, word)]
        flat = [np.concatenate(group) for group in (path, word)]
        for table, size, values, a, b in (
            (self.path, sizes[0], flat[0], 0, PATH_SIZE),
            (self.word, sizes[1], flat[1], PATH_SIZE, PATH_SIZE + WORD_SIZE),
        ):
            begin = np.concatenate(([0], np.cumsum(size)[:-1]))
            x[t, i, a:b] = np.add.reduceat(table[values], begin) / size[:, None]
        x[t, i, PATH_SIZE + WORD_SIZE :] = np.concatenate([p.numbers for p in pages])
        return x, mask, (t, i, sizes, flat)

    def _run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple:
        on, kept_on = self.ways[0].forward(x, mask, keep)
        back, kept_back = self.ways[1].forward(x[::-1], mask[::-1], keep)
        states = np.concatenate((on, back[::-1]), 2)
        return states, kept_on, kept_back, states @ self.out + self.last

    def labels(self, pages: list[Described], together: int = 128) -> list[np.ndarray]:
        """For every block of every page whether it is article text; pages of like length are read side by side."""
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i].paths)) if pages[i].paths]
        for at in range(0, len(order), together):
            some = order[at : at + together]
            x, mask, _ = self._inputs([pages[i] for i in some])
            z = self._run(x, mask)[3]
            for column, i in enumerate(some):
                found[i] = z[: len(pages[i].paths), column] > 0
        return found

    def fit(self, pages: list[Described], labels: list[np.ndarray], rounds: int = 12, rate: float = 0.01) -> BlockLabeller:
        """Adam on the log loss of every block, in batches of 24 pages in a fixed random order."""
        draw = np.random.default_rng(3)
        params = self._params()
        first = {k: np.zeros_like(v) for k, v in params.items()}
        second = {k: np.zeros_like(v) for k, v in params.items()}
        step = 0
        for turn in range(rounds):
            order = draw.permutation(len(pages))
            for at in range(0, len(order), 24):
                some = order[at : at + 24]
                grads = self._gradients([pages[i] for i in some], [labels[i] for i in some])
                step += 1
                for name, value in params.items():
                    g = grads[name] + 1e-4 * value
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    scale = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                    value -= (rate * min(1, 2 - 2 * turn / rounds) * first[name] / (1 - 0.9**step) / scale).astype(np.float32)
        self.fitted = len(pages) > 0
        return self

    def _gradients(self, pages: list[Described], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        x, mask, (t, i, sizes, flat) = self._inputs(pages)
        states, on, back, z = self._run(x, mask, keep=True)
        target = np.zeros_like(z)
        target[t, i] = np.concatenate(labels)
        dz = ((1 / (1 + np.exp(-z)) - target) * mask / mask.sum()).astype(np.float32)
        dstates = dz[:, :, None] * self.out
        dx, dw0, db0 = self.ways[0].backward(x, on, dstates[:, :, :STATE])
        dx1, dw1, db1 = self.ways[1].backward(x[::-1], back, dstates[::-1, :, STATE:])
        dx = (dx + dx1[::-1])[t, i]
        out = {"w0": dw0, "b0": db0, "w1": dw1, "b1": db1, "last": dz.sum(keepdims=True).reshape(1)}
        out["out"] = np.einsum("tpk,tp->k", states, dz)
        for name, table, size, values, a, b in (
            ("path", self.path, sizes[0], flat[0], 0, PATH_SIZE),
            ("word", self.word, sizes[1], flat[1], PATH_SIZE, PATH_SIZE + WORD_SIZE),
        ):
            each = np.repeat(dx[:, a:b] / size[:, None], size, axis=0)
            out[name] = np.stack([np.bincount(values, each[:, k], len(table)) for k in range(b - a)], 1)
        return out


def restyled(html: str, donor: list[str], draw: np.random.Generator) -> str:
    """The page in another template: its article, menu, advert and footer under other tags and names, and more around them.

    Sidebars, notices, forms and reader comments are filled with sentences of another page.
    """
    pick = lambda *options: options[int(draw.integers(len(options)))]
    said = lambda n: " ".join(pick(*donor) for _ in range(int(draw.integers(1, n + 1))))

    def wrapped(kind: str, inner: str) -> str:
        tags, names = {
            "main": (("article", "main", "div", "section", "div"), ("content", "post", "entry", "story", "post-body", "article-body", "main-content", "entry-content", "article")),
            "nav": (("nav", "div", "ul", "header"), ("menu", "navbar", "navigation", "breadcrumbs", "top-nav")),
            "footer": (("footer", "div"), ("footer", "site-footer", "copyright", "legal")),
            "ad": (("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner")),
            "side": (("aside", "div"), ("sidebar", "related", "widget", "trending", "share", "tags")),
            "notice": (("div", "section", "dialog", "p"), ("cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "newsletter")),
            "form": (("form", "div"), ("search", "signup", "subscribe", "login", "comment-form")),
            "comments": (("section", "div", "ol"), ("comments", "comment-list", "replies", "discussion")),
            "header": (("header", "div"), ("header", "masthead", "topbar", "site-header")),
        }[kind]
        tag = pick(*tags)
        plain = kind not in ("ad", "notice") and tag not in ("div", "section", "p", "ul", "ol")
        named = f' {pick("class", "class", "class", "id")}="{pick(*names)}"' if not plain or draw.random() < 0.4 else ""
        return f"<{tag}{named}>{inner}</{tag}>"

    article = re.search(r"<(article|main)\b[^>]*>(.*)</\1>", html, re.DOTALL)
    if not article:
        return html
    inner = article.group(2)
    comments = "".join(f"<{(t := pick('div', 'li', 'p'))}{pick('', ' class=comment')}><p>{said(3)}</p></{t}>" for _ in range(int(draw.integers(1, 5))))
    links = "".join(f'<li><a href="#">{pick(*donor)[:20]}</a></li>' for _ in range(int(draw.integers(2, 7))))
    if draw.random() < 0.4:  # an advert or a notice between paragraphs
        cuts = [m.end() for m in re.finditer("</p>", inner)]
        if cuts:
            at = pick(*cuts)
            inner = inner[:at] + wrapped(pick("ad", "notice", "side"), pick("", "<p>") + said(2)) + inner[at:]
    if draw.random() < 0.3:
        inner += wrapped("comments", comments)
        comments = ""
    main = wrapped("main", inner)
    if not any(taught(b) for b in blocks_of(main)):
        main = f"<article>{inner}</article>"
    before = [wrapped("nav", f"<ul>{links}</ul>"), wrapped("header", f"<p>{said(1)}</p>"), wrapped("ad", said(2)), wrapped("notice", f"<p>{said(2)}</p>")]
    after = [wrapped("side", f"<h3>{said(1)}</h3><ul>{links}</ul>"), wrapped("ad", said(2)), wrapped("form", f"<label>{pick(*donor)}</label> {said(1)}"), wrapped("notice", f"<p>{said(2)}</p>")]
    if comments:
        after.append(wrapped("comments", f"<h3>{said(1)}</h3>" + comments))
    before = [x for x in before if draw.random() < 0.5]
    after = [x for x in after if draw.random() < 0.5]
    draw.shuffle(after)
    body = "".join([*before, main, *after, wrapped("footer", f"&copy; {said(2)}")])
    return f"<html><head><title>x</title></head><body>{body}</body></html>"


def stretches(count: int, at: int) -> list[int]:
    """Where stretches of ``MOST_BLOCKS`` of so many blocks begin: the first, the last and one by ``at``."""
    return sorted({0, at % (count - MOST_BLOCKS + 1), count - MOST_BLOCKS}) if count > MOST_BLOCKS else [0]


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with blocks, each text once a task: short ones as they stand, of long ones stretches of blocks.

    The numbers of a stretch's blocks are those in the page; of a block's text the first
    ``MOST_CHARS / MOST_BLOCKS`` characters are sent.
    """
    seen: set[int] = set()
    for whole in batches:
        for begin in range(0, whole.num_rows, 64):
            rows = []
            for row in whole.slice(begin, 64).to_pylist():
                if row["at"] in seen:
                    continue
                seen.add(row["at"])
                blocks = blocks_of(row["html"])
                if not blocks:
                    continue
                if len(row["html"]) <= MOST_CHARS:
                    rows.append((row["at"], row["html"], None))
                    continue
                numbers = numbers_of(blocks)
                parts = []
                for x in stretches(len(blocks), row["at"]):
                    some = [(b.text[: MOST_CHARS // MOST_BLOCKS], b.path, b.links, b.inner) for b in blocks[x : x + MOST_BLOCKS]]
                    parts.append((some, numbers[x : x + MOST_BLOCKS].tolist()))
                rows.append((row["at"], None, json.dumps(parts)))
            at, html, parts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(html, pa.string()), pa.array(parts, pa.string())], names=["at", "html", "parts"]
            )


def learned(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> BlockLabeller:
    """A labeller fitted to ``sample`` distinct pages at most, those that hash lowest, as a teacher labels their blocks.

    The tables name no true labels, so the teacher goes by the elements and class names
    that web pages commonly use, each page as it is and in two other templates. What the
    teacher goes by is hidden from the network in two more copies, so that it also learns
    an article by its words, sizes, links and what stands around it. Only
    pages without any block are not drawn. Of more than ``MOST_BLOCKS`` blocks, the first,
    the last and one other stretch of that many are learned from; of a page of more than
    ``MOST_CHARS`` characters, the other templates hold the article blocks of these. If no
    page has a block, the labeller is not fitted.
    """
    given = pages.select(F.col(html_col).cast("string").alias("html")).where(F.length("html") > 0)
    given = given.withColumn("at", F.xxhash64("html"))
    # Of many pages, one in so many is looked at: about eight times the sample, or more if too few of them have blocks.
    one_in = max(1, given.agg(F.approx_count_distinct("at")).first()[0] // (8 * sample))
    while True:
        drawn = given.where(F.pmod(F.xxhash64("html", F.lit(1)), F.lit(one_in)) == 0)
        usable = drawn.mapInArrow(_usable, "at long, html string, parts string").distinct()
        rows = usable.orderBy("at").limit(sample).collect()
        if len(rows) >= sample or one_in == 1:
            break
        one_in = max(1, one_in // 8)
    return fitted(rows)


def fitted(rows: list) -> BlockLabeller:
    """A labeller fitted to these pages, each with ``at``, and ``html`` or ``parts`` (see ``_usable``)."""
    draw = np.random.default_rng(9)
    whole: list[str] = []
    paths, words = PathBuckets(), WordBuckets()
    described: list[Described] = []
    labels: list[np.ndarray] = []

    def learn(blocks: list[Block], numbers: np.ndarray, bare: bool) -> None:
        label = np.array([taught(b) for b in blocks], np.float32)
        for shown in (blocks, hidden(blocks)) if bare else (blocks,):
            described.append(Described(shown, paths, words, numbers))
            labels.append(label)

    parts: list[list[tuple[list[Block], np.ndarray]]] = []
    for row in rows:
        some = []
        for blocks, numbers in json.loads(row["parts"] or "[]"):
            read = [
                Block(text, tuple((tag, tuple(names)) for tag, names in path), links, inner=inner) for text, path, links, inner in blocks
            ]
            some.append((read, np.array(numbers, np.float32)))
        article = [b for blocks, _ in some for b in blocks if taught(b)]
        whole.append(row["html"] or f"<article>{''.join(f'<p>{escape(b.text)}</p>' for b in article)}</article>")
        parts.append(some)
    sentences = [[b.text for b in blocks_of(html) if len(b.text) < 400] or ["x"] for html in whole]
    for i, html in enumerate(whole):
        for blocks, numbers in parts[i]:
            learn(blocks, numbers, True)
        donor = sentences[(i + 1) % len(whole)]
        styles = [html] if not parts[i] else []
        if not parts[i] or html != "<article></article>":
            styles += [restyled(html, donor, draw), restyled(html, donor, draw)]
        for style, blocks in enumerate(map(blocks_of, styles)):
            numbers = numbers_of(blocks) if blocks else None
            for x in stretches(len(blocks), rows[i]["at"]) if blocks else ():
                learn(blocks[x : x + MOST_BLOCKS], numbers[x : x + MOST_BLOCKS], style < 2)
    return BlockLabeller().fit(described, labels)


def main_texts(pages: DataFrame, labeller: BlockLabeller, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the article text of every page in place of ``html_col``, and ``n_chars``, its code points.

    Blocks that the labeller takes for article text, in order, joined by newlines; an
    empty string where it takes none, and for null and empty pages. A labeller that was
    not fitted, since nothing could be learned, leaves it to the teacher. Columns named
    ``text_col`` or ``n_chars`` are replaced, all others stay. Rows stay where they are.
    """
    pages = pages.drop(*(c for c in (text_col, "n_chars") if c != html_col))
    kept = [c for c in pages.columns if c != html_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, words = PathBuckets(), WordBuckets()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                blocks = [blocks_of(html) for html in batch.column(html_col).to_pylist()]
                if labeller.fitted:
                    found = labeller.labels([Described(b, paths, words) for b in blocks])
                else:
                    found = [[taught(b) for b in bs] for bs in blocks]
                texts = ["\n".join(b.text for b, yes in zip(bs, f) if yes) for bs, f in zip(blocks, found)]
                columns = [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, text_col, "n_chars"])

    kinds = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept)
    return pages.mapInArrow(run, f"{kinds}`{text_col}` string, n_chars long")

"""Main-text extraction: a bidirectional LSTM labels every leaf block of a page.

A block is read as the sum of vectors for the names on its tag path, the mean of vectors for
its words (both hashed), and a few measures. The LSTM, in NumPy, goes over the blocks of a page
in both directions, so that each label rests on the whole page.

It is trained on a bounded sample of the pages. Where a sampled page says by its elements what
is the article, its blocks are labelled by that; since pages differ in how they say it, the
same blocks are also set into other layouts, with sidebars, notices, forms and comments made of
words of the page.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspark.llm.arrow import parts, rows_of, texts, to_batch
from riskspark.llm.blocks import Block, split_blocks, token_names

#: Pages that training may read at most.
TRAIN_PAGES = 240
#: Times that a page's own layout counts, and other layouts made of each page.
OWN_LAYOUT = 4
LAYOUTS = 4
STEPS = 600
BATCH = 24
HIDDEN = 24
WIDTH = 16
PATH_SLOTS, WORD_SLOTS = 1024, 1024
MEASURES = 8
SEED = 42
#: Block steps of one batch of pages at prediction.
BATCH_STEPS = 20_000

# Names that mark the article, or what does not belong to it.
MAIN = frozenset(("article", "main", "r:main", "r:article", "c:article", "c:post", "c:entry",
                  "c:content", "c:story", "i:content", "i:main", "i:article"))
OTHER = frozenset(("nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "c:nav",
                   "c:menu", "c:navbar", "c:header", "c:footer", "c:sidebar", "c:ad", "c:ads",
                   "c:advert", "c:banner", "c:promo", "c:sponsored", "c:cookie", "c:consent",
                   "c:notice", "c:popup", "c:comments", "c:comment", "c:related", "c:share",
                   "c:breadcrumb", "c:copyright", "c:newsletter", "c:widget", "i:comments",
                   "i:sidebar", "i:footer", "i:header", "i:menu", "r:navigation", "r:banner",
                   "r:contentinfo", "r:complementary", "r:search"))


def slot(name: str, slots: int) -> int:
    return zlib.crc32(name.encode()) % slots


def features(blocks: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Path slots, word slots and measures of each block of a page."""
    paths, words = [], []
    measures = np.zeros((len(blocks), MEASURES), np.float32)
    for i, block in enumerate(blocks):
        paths.append([slot(n, PATH_SLOTS) for n in block.path] or [0])
        own = block.text.split()
        words.append([slot(w.lower(), WORD_SLOTS) for w in own])
        n = len(block.text)
        measures[i] = (np.log1p(len(own)) / 5, np.log1p(n) / 7, block.linked,
                       sum(c in ".!?…" for c in block.text) / max(1, len(own)),
                       block.text[-1] in ".!?…", i / len(blocks), len(block.path) / 16, 1)
    return paths, words, measures


def own_label(block: Block) -> int | None:
    """1 for article, 0 for other, by the innermost name that says so; None if none does.

    Only whole names count, not the parts of compound ones. A header inside an article is the
    article's own.
    """
    label = None
    for name in block.path:
        if name in OTHER:
            label = 1 if name == "header" and label == 1 else 0
        elif name in MAIN and label != 0:
            label = 1
    return label


def _class(token: str) -> tuple[str, ...]:
    return token_names("c", token)


# Compound class names that tell of a page's state, not of what stands inside.
STATES = ("has-sidebar", "no-sidebar", "sidebar-left", "comments-open", "comment-free", "header-fixed",
          "footer-sticky", "with-ads", "menu-open", "has-banner", "logged-in", "single-post")


def layouts(blocks: list[Block], labels: list[int], rng: np.random.Generator,
            how_many: int) -> Iterator[tuple[list[Block], list[int]]]:
    """The article of a page set into other page layouts."""
    main = [b for b, y in zip(blocks, labels, strict=True) if y == 1]
    other = [b for b, y in zip(blocks, labels, strict=True) if y == 0]
    bag = " ".join(b.text for b in blocks).split()
    if not main or len(bag) < 8:
        return

    def pick(*choices):
        return choices[rng.integers(len(choices))]

    def some(low: int, high: int) -> str:
        n = int(rng.integers(low, high + 1))
        at = int(rng.integers(0, max(1, len(bag) - n)))
        return " ".join(bag[at:at + n])

    def group(path: tuple, inner: tuple, count: int, low: int, high: int, linked: float):
        return [Block(some(low, high), (*path, *inner), linked) for _ in range(count)]

    for _ in range(how_many):
        state = _class(pick(*STATES))
        root = ("html", "body", *pick((), ("div",), ("div", "c:page"), ("div", "i:wrapper"), ("div", *state)))
        out: list[tuple[Block, int]] = []

        def add(made: list[Block], chance: float = 1.0, out=out) -> None:
            if rng.random() < chance:
                out.extend((b, 0) for b in made)

        menu = pick(("nav",), ("header", "nav"), ("div", "c:menu"), ("div", "i:menu"),
                    ("header", "c:header"), ("ul", "c:navbar"), ("nav", *_class("main-nav")), ("div", *_class("site-header")), ("div", "r:navigation"),
                    ("div", *_class("top-bar")))
        add(group((*root, *menu), pick(("ul", "li", "a"), ("a",), ("ul", "li")),
                  int(rng.integers(3, 9)), 1, 2, 1.0), 0.9)
        add(group((*root, *pick(("header",), ("div", "c:header"), ("div", "c:logo"))),
                  pick((), ("p",), ("span",)), 1, 1, 6, 0.0), 0.4)
        notice = pick(("div", "c:cookie"), ("div", "c:notice"), ("div", *_class("cookie-notice")), ("div", "c:consent"),
                      ("aside", "c:banner"), ("div", "c:popup"), ("div", "r:dialog"),
                      ("div", "c:alert"), ("div", "c:gdpr"))
        add(group((*root, *notice), pick((), ("p",)), 1, 5, 25, 0.0), 0.4)
        advert = pick(("div", "c:ad"), ("div", "c:ads"), ("div", "c:advert"), ("aside",),
                      ("div", "c:sponsored"), ("div", "c:promo"), ("div", *_class("ad-slot")), ("ins", "c:adsbygoogle"))
        ad = group((*root, *advert), pick((), ("p",), ("a",)), int(rng.integers(1, 3)), 3, 20,
                   float(rng.random() < 0.4))
        add([*[Block(b.text, (*root, *advert), b.linked) for b in other[-2:-1]], *ad], 0.6)
        side = pick(("aside",), ("div", "c:sidebar"), ("div", "i:sidebar"), ("section", "c:related"),
                    ("div", "c:widget"), ("div", "r:complementary"), ("div", *_class("sidebar-widget")))
        sidebar = group((*root, *side), pick(("ul", "li", "a"), ("p",), ("h", ), ("div",)),
                        int(rng.integers(2, 7)), 2, 15, float(rng.random() < 0.6))
        first = rng.random() < 0.3
        add(sidebar, 0.6 * first)
        body = pick(("article",), ("main",), ("main", "article"), ("div", "c:content"),
                    ("div", "c:post"), ("div", "i:content"), ("div", *_class("entry-content")), ("div", *_class("post-content")),
                    ("article", *state), ("main", *state), ("article", "c:post", *state),
                    ("section", *_class("article-body")), ("div", "i:main"), ("div", "c:story"),
                    ("div",), ("div", "r:main"), ("td",))
        mids = group((*root, *body, *pick(advert, ("div", "c:share"), ("form",), ("figure", "aside"))),
                     pick((), ("p",)), 1, 2, 12, float(rng.random() < 0.5))
        middle = int(rng.integers(1, len(main) + 1)) if rng.random() < 0.4 else -1
        inner = pick(("p",), ("div",), ("div", "p"))
        for i, b in enumerate(main):
            kept = tuple(n for n in b.path if n not in MAIN)[-2:]
            own = kept if i == 0 or rng.random() < 0.5 else inner
            out.append((Block(b.text, (*root, *body, *own), b.linked), 1))
            if i + 1 == middle:
                add(mids)
        form = pick(("form",), ("form", "c:newsletter"), ("div", "c:subscribe", "form"),
                    ("div", "r:search", "form"))
        add(group((*root, *form), pick(("label",), ("p",), ("div",)), int(rng.integers(1, 4)), 1, 8,
                  0.0), 0.4)
        said = pick(("div", "c:comments"), ("section", "i:comments"), ("div", "c:comment"),
                    ("ol", *_class("comment-list")), ("div", "i:disqus"), ("section", "c:replies"))
        inside = rng.random() < 0.3
        add(group((*root, *(body if inside else ()), *said),
                  pick(("div", "c:comment", "p"), ("li", "p"), ("p",), ("article", "p")),
                  int(rng.integers(1, 7)), 3, 40, 0.0), 0.5)
        add(sidebar, 0.6 * (not first))
        foot = pick(("footer",), ("div", "c:footer"), ("div", "i:footer"), ("div", *_class("site-footer")), ("div", "c:copyright"),
                    ("div", "r:contentinfo"))
        last = other[-1:] if rng.random() < 0.6 else []
        add([*[Block(b.text, (*root, *foot), b.linked) for b in last],
             *group((*root, *foot), pick((), ("p",), ("ul", "li", "a")), int(rng.integers(1, 5)), 1, 8,
                    float(rng.random() < 0.5))], 0.9)
        yield [b for b, _ in out], [y for _, y in out]


def _pad(pages: list, dropped: np.random.Generator | None = None):
    """Padded arrays of some pages: path bags, word bags, measures, mask."""
    longest = max(len(p[2]) for p in pages)
    shape = (longest, len(pages))
    measures = np.zeros((*shape, MEASURES), np.float32)
    mask = np.zeros(shape, np.float32)
    path_at, path_ids, word_at, word_ids = [], [], [], []
    for j, (paths, words, own) in enumerate(pages):
        measures[:len(own), j] = own
        mask[:len(own), j] = 1
        for i, (p, w) in enumerate(zip(paths, words, strict=True)):
            path_at += [i * len(pages) + j] * len(p)
            path_ids += p
            word_at += [i * len(pages) + j] * len(w)
            word_ids += w
    bags = [np.array(x, np.int64) for x in (path_at, path_ids, word_at, word_ids)]
    if dropped is not None:  # leave out some names and many words, to lean on no single one
        for k, share in ((0, 0.15), (2, 0.5)):
            keep = dropped.random(len(bags[k])) >= share
            bags[k], bags[k + 1] = bags[k][keep], bags[k + 1][keep]
    return shape, bags, measures, mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """The network: parameters by name, forward pass, and gradients for training."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        wide = 2 * WIDTH + MEASURES

        def start(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.trained = False
        self.p = {"path": start(PATH_SLOTS, WIDTH, scale=0.3), "word": start(WORD_SLOTS, WIDTH, scale=0.1),
                  "out": start(2 * HIDDEN, scale=0.2), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p["x" + side] = start(wide, 4 * HIDDEN, scale=0.25)
            self.p["h" + side] = start(HIDDEN, 4 * HIDDEN, scale=0.2)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1  # remember at first
            self.p["b" + side] = bias

    def _inputs(self, shape, bags, measures):
        steps = shape[0] * shape[1]
        out = []
        for k, name in ((0, "path"), (2, "word")):
            total = np.zeros((steps, WIDTH), np.float32)
            np.add.at(total, bags[k], self.p[name][bags[k + 1]])
            count = np.bincount(bags[k], minlength=steps).astype(np.float32)
            weight = 1 / np.sqrt(np.maximum(count, 1)) if k == 0 else 1 / np.maximum(count, 1)
            out.append((total * weight[:, None], weight))
        x = np.concatenate([out[0][0].reshape(*shape, WIDTH), out[1][0].reshape(*shape, WIDTH),
                            measures], 2)
        return x, (out[0][1], out[1][1])

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        """Hidden states of one direction; padding holds the state as it is."""
        steps, pages = mask.shape
        gates_in = x @ self.p["x" + side] + self.p["b" + side]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        states = np.zeros((steps, pages, HIDDEN), np.float32)
        saved = []
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            gates = gates_in[t] + h @ self.p["h" + side]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                saved.append((t, h, c, i, f, o, g, squashed, m))
            h, c = m * o * squashed + (1 - m) * h, m * new + (1 - m) * c
            states[t] = h
        return states, saved

    def logits(self, padded, keep: bool = False):
        shape, bags, measures, mask = padded
        x, weights = self._inputs(shape, bags, measures)
        forward, saved_f = self._run(x, mask, "f", keep)
        backward, saved_b = self._run(x, mask, "b", keep)
        both = np.concatenate([forward, backward], 2)
        return both @ self.p["out"] + self.p["bias"], (x, weights, both, saved_f, saved_b)

    def gradients(self, padded, target: np.ndarray):
        shape, bags, _, mask = padded
        logit, (x, weights, both, *saved) = self.logits(padded, True)
        error = (_sigmoid(logit) - target) * mask / max(1.0, float(mask.sum()))
        grads = {"out": np.einsum("tb,tbh->h", error, both), "bias": np.array([error.sum()])}
        d_both = error[:, :, None] * self.p["out"]
        d_x = np.zeros_like(x)
        for side, own, d_states in zip("fb", saved, (d_both[:, :, :HIDDEN], d_both[:, :, HIDDEN:]),
                                       strict=True):
            d_h, d_c = np.zeros(d_states.shape[1:], np.float32), np.zeros(d_states.shape[1:], np.float32)
            g_x, g_h = np.zeros_like(self.p["x" + side]), np.zeros_like(self.p["h" + side])
            g_b = np.zeros_like(self.p["b" + side])
            for t, h, c, i, f, o, g, squashed, m in reversed(own):
                d_h = d_h + d_states[t]
                live = d_h * m
                d_new = d_c * m + live * o * (1 - squashed ** 2)
                d_gates = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f),
                                          live * squashed * o * (1 - o), d_new * i * (1 - g ** 2)], 1)
                g_x += x[t].T @ d_gates
                g_h += h.T @ d_gates
                g_b += d_gates.sum(0)
                d_x[t] += d_gates @ self.p["x" + side].T
                d_h = d_h * (1 - m) + d_gates @ self.p["h" + side].T
                d_c = d_c * (1 - m) + d_new * f
            grads |= {"x" + side: g_x, "h" + side: g_h, "b" + side: g_b}
        flat = d_x.reshape(-1, x.shape[2])
        for k, name, first in ((0, "path", 0), (2, "word", WIDTH)):
            table = np.zeros_like(self.p[name])
            part = flat[:, first:first + WIDTH] * weights[k // 2][:, None]
            np.add.at(table, bags[k + 1], part[bags[k]])
            grads[name] = table
        return grads

    def train(self, pages: list, targets: list[list[int]], steps: int = STEPS, seed: int = SEED) -> None:
        """Adam on batches of whole pages of similar length."""
        self.trained = True
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = np.argsort([len(t) for t in targets], kind="stable")
        chunks = [order[at:at + BATCH] for at in range(0, len(order), BATCH)]
        for step in range(1, steps + 1):
            chosen = chunks[rng.integers(len(chunks))]
            padded = _pad([pages[j] for j in chosen], rng)
            target = np.zeros(padded[0], np.float32)
            for j, k in enumerate(chosen):
                target[:len(targets[k]), j] = targets[k]
            rate = 0.01 * min(1.0, step / 20) * (0.1 if step > 0.8 * steps else 1)
            for name, grad in self.gradients(padded, target).items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad * grad
                move = first[name] / (1 - 0.9 ** step) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)
                self.p[name] = (self.p[name] - rate * move).astype(np.float32)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page belongs to the main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [int(j) for j in np.argsort([len(p) for p in pages], kind="stable") if pages[j]]
        while order:
            take = max(1, min(len(order), BATCH_STEPS // len(pages[order[min(len(order), 256) - 1]])))
            now, order = order[:take], order[take:]
            logit = self.logits(_pad([features(pages[j]) for j in now]))[0]
            for k, j in enumerate(now):
                out[j] = logit[:len(pages[j]), k] > 0
        return out


def train_labeller(pages: DataFrame, page_id: str = "page_id", column: str = "html",
                   train_pages: int = TRAIN_PAGES, seed: int = SEED) -> Labeller:
    """A labeller from at most ``train_pages`` pages, taken by hash of the id.

    Pages without a block that their elements call article teach nothing; without any teaching
    page the network is left to what made-up layouts of its own words can not give: it is not
    trained, and ``extract`` then falls back on the elements' own words.
    """
    # About the wanted number by hash, so that no more than those come to the driver.
    share = min(1.0, 1.25 * train_pages / max(1, rows_of(pages)))
    turn = F.pmod(F.xxhash64(page_id, F.lit(seed)), F.lit(1 << 30))
    rows = (pages.where(F.col(column).isNotNull())
            .select(turn.alias("turn"), F.col(page_id).cast("string").alias("id"),
                    F.col(column).alias("html"))
            .where(F.col("turn") < int(share * (1 << 30)))
            .orderBy("turn", "id", "html").limit(train_pages).collect())
    rng = np.random.default_rng(seed)
    examples, targets = [], []
    for row in rows:
        blocks = split_blocks(row.html)
        known = [(b, y) for b in blocks if (y := own_label(b)) is not None]
        if not any(y for _, y in known):
            continue
        own, labels = [b for b, _ in known], [y for _, y in known]
        for made, wanted in [*[(own, labels)] * OWN_LAYOUT, *layouts(own, labels, rng, LAYOUTS)]:
            examples.append(features(made))
            targets.append(wanted)
    model = Labeller(seed)
    if examples:
        model.train(examples, targets)
    return model


def extract(pages: DataFrame, model: Labeller | None = None, page_id: str = "page_id",
            url: str = "url", column: str = "html") -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars.

    Blocks labelled article are joined by a newline in page order. A null or empty page, and a
    page without text, has the empty text. Rows that repeat an id are pages of their own;
    columns beside the three are not read.
    """
    model = model or train_labeller(pages, page_id, column)
    schema = StructType([pages.schema[page_id], pages.schema[url], StructField("text", StringType()),
                         StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            split = [split_blocks(page) for page in texts(batch, column)]
            labels = model.label(split) if model.trained else [
                [own_label(b) != 0 for b in blocks] for blocks in split]
            found = ["\n".join(b.text for b, yes in zip(blocks, own, strict=True) if yes)
                     for blocks, own in zip(split, labels, strict=True)]
            yield to_batch({page_id: batch.column(page_id), url: batch.column(url), "text": found,
                            "n_chars": list(map(len, found))}, schema)

    return pages.select(page_id, url, column).mapInArrow(run, schema)

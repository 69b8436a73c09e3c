"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Every block is read as a vector of its tag path and a vector of its
hashed words; a bidirectional LSTM in numpy passes over the whole sequence and says of each block,
knowing those before and after it, whether it belongs to the article. It is trained on pages of
the table whose own markup tells (an ``article`` or ``main`` element) and on pages written here from a
grammar of layouts that hide it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.common import bounded_sample
from ledgerspark.llm.html_blocks import Block, blocks
from ledgerspark.llm.shingles import word_hashes

PATHS, WORDS, NUMBERS = 96, 32, 4
WIDTH = PATHS + WORDS + NUMBERS
HIDDEN = 16
MAX_TRAINED_BLOCKS = 200
OUTSIDE = frozenset(
    "head title nav header footer aside form button select .nav .menu .ad .ads .advert .sidebar .footer .header "
    ".cookie .notice .banner .comments .comment .related .share .promo .newsletter .breadcrumb".split()
)

_paths: dict[tuple[str, ...], np.ndarray] = {}


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """A vector of hashed signs for the names and marks of a path, the innermost name once more."""
    known = _paths.get(path)
    if known is None:
        known = np.zeros(PATHS, dtype=np.float32)
        names = [n for n in path if n[0] != "."]
        for token in {*path, f"last {names[-1] if names else ''}", f"depth {min(len(names), 9)}"}:
            for salt in (0, 1):
                h = zlib.crc32(f"{salt}{token}".encode())
                known[h % PATHS] += 1.0 if h & 1 << 20 else -1.0
        if len(_paths) > 50_000:
            _paths.clear()
        _paths[path] = known
    return known


def page_vectors(page: list[Block]) -> np.ndarray:
    """A row for each block: tag path, hashed words and four numbers about its form."""
    if not page:
        return np.zeros((0, WIDTH), dtype=np.float32)
    counts = np.array([b.text.count(" ") + 1 for b in page])
    hashed = word_hashes("\n".join(b.text for b in page))
    owner = np.repeat(np.arange(len(page)), counts)
    if len(owner) != len(hashed):  # a separator that the two splits see differently
        hashed = np.concatenate([word_hashes(b.text.replace("\n", " ")) for b in page])
        owner = np.repeat(np.arange(len(page)), [len(word_hashes(b.text)) for b in page])
    words = np.bincount(owner * WORDS + (hashed % np.uint64(WORDS)).astype(np.int64), minlength=len(page) * WORDS)
    words = np.log1p(words.reshape(len(page), WORDS)) / 4
    sizes = np.array([len(b.text) for b in page], dtype=float)
    numbers = np.stack(
        [
            np.log1p(counts) / 5,
            np.log1p(sizes) / 8,
            np.array([b.links for b in page]) / sizes,
            np.array([b.text[-1] in ".!?:;\"'" for b in page], dtype=float),
        ],
        axis=1,
    )
    return np.hstack([np.stack([path_vector(b.path) for b in page]), words, numbers]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _pass(x, mask, w, u, b, order, keep):
    """One direction of the LSTM over (steps, pages, width); ``keep`` stores what the gradient needs."""
    steps, pages, _ = x.shape
    h = c = np.zeros((pages, HIDDEN), dtype=np.float32)
    out, held = np.zeros((steps, pages, HIDDEN), dtype=np.float32), {}
    given = x @ w + b
    for t in order:
        z = given[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        new = f * c + i * g
        rise = np.tanh(new)
        m = mask[t][:, None]
        if keep:
            held[t] = (h, c, i, f, o, g, rise, m)
        c, h = m * new + (1 - m) * c, m * o * rise + (1 - m) * h
        out[t] = h
    return out, held


def _back(x, held, grown, u, order):
    """Gradients of one direction's weights from those of its outputs."""
    dw, du, db = np.zeros((x.shape[2], 4 * HIDDEN)), np.zeros_like(u, dtype=float), np.zeros(4 * HIDDEN)
    dh = dc = 0
    for t in reversed(list(order)):
        h, c, i, f, o, g, rise, m = held[t]
        dh = dh + grown[t]
        dnew = m * (dc + dh * o * (1 - rise * rise))
        dz = np.hstack(
            [dnew * g * i * (1 - i), dnew * c * f * (1 - f), m * dh * rise * o * (1 - o), dnew * i * (1 - g * g)]
        )
        dw += x[t].T @ dz
        du += h.T @ dz
        db += dz.sum(axis=0)
        dc = dnew * f + (1 - m) * dc
        dh = dz @ u.T + (1 - m) * dh
    return dw, du, db


@dataclass(frozen=True)
class BlockLabeller:
    """Weights of both directions and of the output."""

    weights: dict[str, np.ndarray]

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        p, steps = self.weights, x.shape[0]
        ahead, held1 = _pass(x, mask, p["w1"], p["u1"], p["b1"], range(steps), keep)
        back, held2 = _pass(x, mask, p["w2"], p["u2"], p["b2"], range(steps - 1, -1, -1), keep)
        both = np.concatenate([ahead, back], axis=2)
        return both @ p["v"] + p["d"][0], (both, held1, held2)

    def label(self, pages: list[np.ndarray], chunk: int = 1 << 14) -> list[np.ndarray]:
        """Which blocks of each page are text of the article."""
        out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= chunk:
                end += 1
            own = [pages[i] for i in order[at:end]]
            x, mask = padded(own)
            logits, _ = self.logits(x, mask)
            for k, i in enumerate(order[at:end]):
                out[i] = logits[: len(pages[i]), k] > 0
            at = end
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), WIDTH), dtype=np.float32)
    mask = np.zeros((steps, len(pages)), dtype=np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k] = page
        mask[: len(page), k] = 1
    return x, mask


def fit_labeller(pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = 30, batch: int = 48, seed: int = 8):
    """Train by Adam on the cross entropy of all blocks, in batches of pages of like length."""
    rng = np.random.default_rng(seed)
    p = {
        "w1": rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)), "u1": rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)),
        "b1": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN),
        "w2": rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)), "u2": rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)),
        "b2": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN),
        "v": rng.normal(0, 0.3, 2 * HIDDEN), "d": np.zeros(1),
    }
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    parts = [order[i : i + batch] for i in range(0, len(order), batch)]
    for turn in range(rounds):
        rate = 0.02 if turn < rounds * 2 // 3 else 0.005
        for k in rng.permutation(len(parts)):
            own = parts[k]
            x, mask = padded([pages[i] for i in own])
            y = np.zeros(mask.shape)
            for j, i in enumerate(own):
                y[: len(labels[i]), j] = labels[i]
            model = BlockLabeller({n: w.astype(np.float32) for n, w in p.items()})
            logits, (both, held1, held2) = model.logits(x, mask, keep=True)
            error = (_sigmoid(logits) - y) * mask / mask.sum()
            spread = error[:, :, None] * p["v"]
            steps = range(len(x))
            grown = dict(zip(("w1", "u1", "b1"), _back(x, held1, spread[:, :, :HIDDEN], p["u1"], steps), strict=True))
            grown |= zip(("w2", "u2", "b2"), _back(x, held2, spread[:, :, HIDDEN:], p["u2"], steps[::-1]), strict=True)
            grown |= {"v": np.einsum("tb,tbh->h", error, both), "d": np.array([error.sum()])}
            step += 1
            for n, g in grown.items():
                g = np.clip(g, -1, 1) + 1e-5 * p[n]
                m[n], v[n] = 0.9 * m[n] + 0.1 * g, 0.99 * v[n] + 0.01 * g * g
                p[n] = p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-8)
    return BlockLabeller({n: w.astype(np.float32) for n, w in p.items()})


def marked_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a page whose markup names its article; None if it does not."""
    inside = np.array([bool({"article", "main"} & set(b.path)) for b in page], dtype=bool)
    if not inside.any():
        return None
    return inside & np.array([not OUTSIDE & set(b.path) for b in page], dtype=bool)


def written_page(rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page of a random layout and the labels of its blocks."""
    pieces: list[str] = []
    labels: list[bool] = []

    def some(low: int, high: int) -> str:
        letters = list("abcdefghijklmnopqrstuvwxyzäéñ")
        return " ".join(
            "".join(rng.choice(letters, rng.integers(1, 11))) for _ in range(rng.integers(low, high))
        ).capitalize()

    def one(*options: str) -> str:
        return str(rng.choice(options))

    def put(text: str, label: bool) -> None:
        pieces.append(text)
        labels.append(label)

    def menu(tag: str, mark: str) -> None:
        pieces.append(f'<{tag} class="{mark}"><ul>')
        for _ in range(rng.integers(2, 9)):
            put(f'<li><a href="/x">{some(1, 4)}</a></li>', False)
        pieces.append(f"</ul></{tag}>")

    def box(tag: str, mark: str, count: int) -> None:
        pieces.append(f'<{tag} class="{mark}">')
        for _ in range(count):
            put(f"<p>{some(2, 25)}.</p>" if rng.random() < 0.7 else f"<h3>{some(1, 5)}</h3>", False)
        pieces.append(f"</{tag}>")

    pieces.append("<html><head>")
    put(f"<title>{some(2, 9)}</title>", False)
    pieces.append("</head><body>")
    if rng.random() < 0.6:
        pieces.append("<header>" if rng.random() < 0.5 else '<div class="header">')
        put(f"<a href='/'>{some(1, 4)}</a>", False)
        pieces.append("</header>" if "<header>" in pieces[-2] else "</div>")
    if rng.random() < 0.8:
        menu(one("nav", "div"), one("menu", "nav", "topnav menu", "breadcrumb"))
    if rng.random() < 0.5:
        box("div", one("ad", "advert", "cookie notice", "banner", "promo"), 1)
    if rng.random() < 0.3:
        box("aside", one("sidebar", "related", "widget"), int(rng.integers(1, 4)))
    if rng.random() < 0.9:
        tag, mark = one("article", "main", "div", "section"), one("content", "post", "article body", "entry text", "")
        if tag in ("div", "section") and not mark:
            mark = "content"
        pieces.append(f'<{tag} class="{mark}">' if mark else f"<{tag}>")
        if rng.random() < 0.8:
            put(f"<h1>{some(2, 9)}</h1>", True)
        for _ in range(rng.integers(1, 14)):
            kind = rng.random()
            if kind < 0.75:
                put(f"<p>{some(1, 60)}.</p>", True)
            elif kind < 0.82:
                put(f"<h2>{some(1, 6)}</h2>", True)
            elif kind < 0.88:
                put(f"<p><b>{some(1, 12)}.<br></p>", True)
            elif kind < 0.93:
                pieces.append("<ul>")
                for _ in range(rng.integers(1, 4)):
                    put(f"<li>{some(2, 20)}.</li>", True)
                pieces.append("</ul>")
            elif kind < 0.96:
                put(f"<blockquote>{some(3, 30)}.</blockquote>", True)
            else:
                box("div", one("ad", "advert", "share", "promo"), 1)
        pieces.append(f"</{tag}>")
    if rng.random() < 0.4:
        pieces.append('<div class="comments">' if rng.random() < 0.5 else '<section id="comments">')
        for _ in range(rng.integers(1, 6)):
            put(f'<div class="comment"><p>{some(2, 40)}.</p></div>', False)
        pieces.append("</div>" if "div" in pieces[-2] else "</section>")
    if rng.random() < 0.3:
        pieces.append("<form>")
        put(f"<label>{some(1, 4)}</label>", False)
        pieces.append("</form>")
    if rng.random() < 0.3:
        box(one("aside", "div"), one("sidebar", "related", "newsletter"), int(rng.integers(1, 5)))
    if rng.random() < 0.8:
        pieces.append(one("<footer>", '<div class="footer">'))
        put(f"&copy; {some(1, 12)}", False)
    return "".join(pieces), labels


def written_examples(count: int, seed: int = 88) -> tuple[list[np.ndarray], list[np.ndarray]]:
    rng, pages, labels = np.random.default_rng(seed), [], []
    for _ in range(count):
        page, own = written_page(rng)
        found = blocks(page)
        if len(found) == len(own) and found:
            pages.append(page_vectors(found))
            labels.append(np.array(own))
    return pages, labels


def fit_on_pages(
    pages: DataFrame, html_col: str = "html", url_col: str = "url", max_pages: int = 400, written: int = 400
) -> BlockLabeller:
    """Train on the marked ones of ``max_pages`` pages of the table and ``written`` pages of the grammar.

    Of a longer training page a run of ``MAX_TRAINED_BLOCKS`` blocks is learnt from. The driver gets vectors and labels, not pages.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch["html"]:
                found = blocks(page)
                labels = marked_labels(found)
                if labels is not None:
                    at = len(found) % max(1, len(found) - MAX_TRAINED_BLOCKS + 1)
                    kept = slice(at, at + MAX_TRAINED_BLOCKS) if len(found) > MAX_TRAINED_BLOCKS else slice(None)
                    row = (page_vectors(found)[kept].tobytes(), labels[kept].tobytes())
                    yield pd.DataFrame([row], columns=["x", "y"])

    rows = pages.select(F.col(html_col).alias("html"), F.col(url_col).alias("url")).filter("html is not null")
    sample = bounded_sample(rows, ["url", "html"], max_pages, seed=8)
    held = sorted(map(tuple, sample.select("html").mapInPandas(run, "x binary, y binary").collect()))
    vectors, labels = written_examples(written)
    vectors += [np.frombuffer(x, np.float32).reshape(-1, WIDTH) for x, _ in held]
    labels += [np.frombuffer(y, bool) for _, y in held]
    return fit_labeller(vectors, labels)


def extract_text(
    pages: DataFrame, model: BlockLabeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id, url, text, n_chars`` of every page, from its whole html; null html is empty and has an empty text.

    Text blocks are joined by one line feed. Null ids and urls and repeated rows are kept as they are, further
    columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                found = [blocks(page) for page in part["html"]]
                labels = shared.value.label([page_vectors(b) for b in found])
                texts = [
                    "\n".join(b.text for b, ok in zip(own, keep, strict=True) if ok)
                    for own, keep in zip(found, labels, strict=True)
                ]
                yield pd.DataFrame(
                    {"id": part["id"], "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]}
                )

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html")
    )
    schema = f"id {kind}, url string, text string, n_chars bigint"
    return rows.mapInPandas(run, schema).withColumnsRenamed({"id": id_col, "url": url_col})

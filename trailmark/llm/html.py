"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the document tree.

A page is cut into leaf blocks: runs of text between block-level tags. Each block is labelled content or not. A block's
features are its ancestors' tags and the words of their class and id attributes, and properties of its text; a chain
over the blocks of a page adds weights for neighbouring labels. The weights are learned by maximum likelihood (forward
and backward sums in numpy) from labelled pages; a page is decoded by Viterbi.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: element names of HTML
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    # formulas
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# their text is never shown as part of the page
HIDDEN = frozenset(
    "head script style noscript template svg iframe object select option button textarea canvas audio video annotation "
    "annotation-xml".split()
)
# what follows their start tag is no markup up to their end tag
RAW = frozenset("script style noscript template svg textarea iframe".split())
# any other start tag, or text, ends a head whose end tag is left out
IN_HEAD = frozenset("base link meta title script style noscript template".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
# ---

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
_IN_TAG = re.compile("[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # features of the ancestors, outermost first
    text: str
    linked: int  # characters inside links


def _ancestor(tag: str, attributes: str) -> str:
    """The tag and the words of its class, id and role, as one text."""
    names = []
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            names += _NAME.findall((m[2] or m[3] or m[4] or "").lower())
    return " ".join([tag, *names])


class _TagEnds:
    """Where tags end: at the first `>` outside quotes. No part of the page is searched more than twice."""

    def __init__(self, page: str):
        self.page = page
        self.known: dict[int, int] = {}  # by place of a `>` or quote met outside quotes
        self.searched = range(-1, -1)  # from here on the next such place is the end of the range

    def _next(self, at: int) -> int:
        found = _IN_TAG.search(self.page, at)
        return found.start() if found else len(self.page)

    def after(self, at: int) -> int:
        """The place after the tag whose name ends at `at`; -1 if it has no end."""
        if at not in self.searched and at != self.searched.stop:
            self.searched = range(at, self._next(at))
        at = self.searched.stop
        end, met = -1, []
        while at < len(self.page):
            if at in self.known:
                end = self.known[at]
                break
            met.append(at)
            if self.page[at] == ">":
                end = at + 1
                break
            close = self.page.find(self.page[at], at + 1)
            if close < 0:
                break
            at = self._next(close + 1)
        self.known.update(dict.fromkeys(met, end))
        return end


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Tags as (`/` or nothing, name, attributes) and texts as (text, nothing, nothing), without comments, declarations
    and raw elements. A tag without an end is text, an element or comment without one ends with the page."""
    ends, at, n, declared = _TagEnds(page), 0, len(page), True
    while at < n:
        start = page.find("<", at)
        if start != at:
            start = n if start < 0 else start
            yield page[at:start], "", ""
            at = start
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        tag = _TAG.match(page, at)
        if tag:
            end = ends.after(tag.end())
            if end >= 0:
                name, attributes = tag[2].lower(), page[tag.end() : end - 1]
                if name in RAW and not tag[1] and not (name == "svg" and attributes.endswith("/")):
                    close = _RAW_END[name].search(page, end)
                    at = close.end() if close else n
                    continue
                yield tag[1], name, attributes
                at = end
                continue
        elif declared and page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            if end >= 0:
                at = end + 1
                continue
            declared = False
        yield "<", "", ""
        at += 1


def leaf_blocks(page: str) -> list[Block]:
    """Texts between block-level tags in page order, white space made single spaces, references decoded."""
    blocks: list[Block] = []
    stack: list[tuple[str, str]] = []  # open block-level and hidden elements: tag, features
    is_open: Counter[str] = Counter()
    hidden = 0  # open elements whose text is not shown
    text: list[str] = []
    linked = 0
    link = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                shown = [x for name, x in stack if name not in HIDDEN] if hidden else [x for _, x in stack]
                blocks.append(Block(tuple(shown), joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    def pop(tag: str) -> None:
        nonlocal hidden
        while stack:
            name, _ = stack.pop()
            is_open[name] -= 1
            hidden -= name in HIDDEN
            if name == tag:
                return

    for first, tag, attributes in _tokens(page):
        if not tag:
            if hidden and stack[-1][0] == "head" and first.strip():
                pop("head")
            if not hidden:
                text.append(first)
                if link:
                    linked += len(first)
            continue
        if not first and tag not in IN_HEAD and stack and stack[-1][0] == "head":
            pop("head")
        if tag in INLINE:
            if tag == "a":
                link = 0 if first else 1
            elif tag == "br":
                text.append(" ")
            continue
        inside = tag in HIDDEN and tag != "head"  # a hidden element lies inside its block
        if not inside:
            flush()
        if first:
            if is_open[tag]:
                pop(tag)
                link = link if inside else 0
            continue
        if not inside:
            link = 0
            if stack and stack[-1][0] == "p" and tag in CLOSES_P:
                pop("p")
            if stack and tag == "li" and stack[-1][0] == "li":
                pop("li")
        if tag == "body":
            while stack and stack[-1][0] != "html":
                pop(stack[-1][0])
        if tag not in VOID and not attributes.endswith("/"):
            stack.append((tag, _ancestor(tag, attributes)))
            is_open[tag] += 1
            hidden += tag in HIDDEN
    flush()
    return blocks


def path_features(path: tuple[str, ...]) -> list[str]:
    found = {f"in:{w}" for x in path for w in x.split()}
    if path:
        found |= {f"at:{w}" for w in path[-1].split()}
    return sorted(found)


def text_features(block: Block) -> list[str]:
    n = len(block.text)
    share = block.linked / n
    out = [
        "size:" + ("1" if n < 10 else "2" if n < 25 else "3" if n < 60 else "4" if n < 150 else "5"),
        "link:" + ("0" if share == 0 else "1" if share < 0.5 else "2" if share < 0.95 else "3"),
    ]
    if block.text[-1] in ".!?:…":
        out.append("sentence")
    if "©" in block.text:
        out.append("copyright")
    if "|" in block.text or "·" in block.text:
        out.append("separators")
    return out


class Crf:
    """Weights of two labels; label 1 is content."""

    def __init__(self, weights: dict[str, np.ndarray], chain: np.ndarray, start: np.ndarray):
        self.weights, self.chain, self.start = weights, chain, start
        self._paths: dict[tuple[str, ...], np.ndarray] = {}

    def _sum(self, names: list[str]) -> np.ndarray:
        known = [self.weights[x] for x in names if x in self.weights]
        return np.sum(known, axis=0) if known else np.zeros(2)

    def scores(self, blocks: list[Block]) -> np.ndarray:
        if len(self._paths) > 20_000:
            self._paths.clear()
        out = np.empty((len(blocks), 2))
        for k, b in enumerate(blocks):
            base = self._paths.get(b.path)
            if base is None:
                base = self._paths[b.path] = self._sum(path_features(b.path))
            key = (b"text", *text_features(b))
            extra = self._paths.get(key)
            if extra is None:
                extra = self._paths[key] = self._sum(list(key[1:]))
            out[k] = base + extra
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most probable labels (Viterbi); on a tie the block is no content."""
        if not blocks:
            return []
        c = self.chain.tolist()
        scores = self.scores(blocks).tolist()
        a, b = scores[0][0] + self.start[0], scores[0][1] + self.start[1]
        back = []
        for x, y in scores[1:]:
            from0, from1 = int(b + c[1][0] > a + c[0][0]), int(b + c[1][1] > a + c[0][1])
            back.append((from0, from1))
            a, b = x + (b + c[1][0] if from0 else a + c[0][0]), y + (b + c[1][1] if from1 else a + c[0][1])
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 150, rate: float = 0.2, penalty: float = 1e-5) -> Crf:
    """Maximum likelihood with a penalty on squared weights, by Adam; all pages at once, padded to the longest."""
    names: dict[str, int] = {}
    rows = []
    for blocks, _ in pages:
        rows.append([[names.setdefault(f, len(names)) for f in path_features(b.path) + text_features(b)] for b in blocks])
    n, t, f = len(pages), max(len(x) for x, _ in pages), len(names)
    x = np.zeros((n * t, f), np.float32)
    for i, page in enumerate(rows):
        for j, found in enumerate(page):
            x[i * t + j, found] = 1
    size = np.array([len(b) for b, _ in pages])
    real = np.arange(t) < size[:, None]
    gold = np.zeros((n, t), int)
    for i, (_, labels) in enumerate(pages):
        gold[i, : len(labels)] = labels
    one = np.eye(2)[gold] * real[:, :, None]
    pairs = real[:, 1:]
    seen_chain = np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
    theta = np.zeros(2 * f + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = float(size.sum())
    for k in range(1, rounds + 1):
        w, chain, start = theta[: 2 * f].reshape(f, 2), theta[2 * f : 2 * f + 4].reshape(2, 2), theta[2 * f + 4 :]
        s = (x @ w).reshape(n, t, 2)
        s[:, 0] += start
        alpha, beta = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        alpha[:, 0] = s[:, 0]
        for j in range(1, t):
            step = np.logaddexp.reduce(alpha[:, j - 1, :, None] + chain, axis=1) + s[:, j]
            alpha[:, j] = np.where(real[:, j, None], step, alpha[:, j - 1])
        for j in range(t - 2, -1, -1):
            step = np.logaddexp.reduce(chain + (s[:, j + 1] + beta[:, j + 1])[:, None, :], axis=2)
            beta[:, j] = np.where(real[:, j + 1, None], step, 0)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        p = np.exp(alpha + beta - z[:, None, None]) * real[:, :, None]
        both = alpha[:, :-1, :, None] + chain + (s + beta)[:, 1:, None, :] - z[:, None, None, None]
        both = np.exp(np.minimum(both, 0)) * pairs[:, :, None, None]
        grad = np.concatenate(
            [
                (x.T @ (p - one).reshape(n * t, 2)).ravel(),
                (both.sum((0, 1)) - seen_chain).ravel(),
                (p[:, 0] - one[:, 0]).sum(0),
            ]
        )
        grad = grad / total + penalty * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    w = theta[: 2 * f].reshape(f, 2)
    return Crf({x: w[i] for x, i in names.items()}, theta[2 * f : 2 * f + 4].reshape(2, 2), theta[2 * f + 4 :])


def extract(page: str | None, model: Crf) -> str:
    blocks = leaf_blocks(page or "")
    return "\n".join(b.text for b, label in zip(blocks, model.decode(blocks)) if label)


def main_text(pages: DataFrame, model: Crf) -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages` (page_id, url, html).

    A null or empty page has an empty text; repeated rows are treated alike; other columns are ignored. The model has a
    fixed size. Nothing is shuffled.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [extract(x.as_py(), model) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages: a recurrent labeller of text blocks.

A page becomes the sequence of its leaf blocks (text between block-level tags). Each block is a
vector: hashed tags, classes and ids of its path, hashed words, and a few figures (length, link
share, place). A bidirectional LSTM in numpy reads the sequence both ways and labels every block
main text or not, with the whole page as context. Its weights (labeller.npz) come from
html_training.py.
"""

import io
import pkgutil
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The block-level, void and never-shown elements of HTML.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td textarea tfoot th thead tr ul".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
HIDDEN = frozenset("head iframe math noembed noframes noscript object script style svg template title".split())
#: Elements that an opening tag closes, and where the search for them stops.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "option": {"select"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

PATH, WORDS, FIGURES = 128, 64, 10
SIZE = PATH + WORDS + FIGURES
_NAME = re.compile(r"[a-z]+|[0-9]+")


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


_END = re.compile(r"</(" + "|".join(sorted(HIDDEN)) + r")\b", re.I)


class _Reader(HTMLParser):
    """Blocks of a page. An element that is never shown hides what it holds if it is closed somewhere;
    one without an end counts as empty, so that it cannot hide the rest of the page."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.ends = Counter(m.group(1).lower() for m in _END.finditer(page))
        self.within: Counter[str] = Counter()
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = 0
        self.path: tuple[str, ...] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.path or (), text, min(self.linked, len(text))))
        self.parts, self.linked, self.path = [], 0, None

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.open.append((tag, names))
        self.links += tag == "a"
        if tag in HIDDEN:
            self.hidden += 1
            self.within[tag] += 1

    def pop(self) -> None:
        tag, _ = self.open.pop()
        self.links -= tag == "a"
        if tag in HIDDEN:
            self.hidden -= 1
            self.within[tag] -= 1

    def close_to(self, tags: set[str], stop: frozenset[str] | set[str]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                while len(self.open) > k:
                    self.pop()
                return
            if self.open[k][0] in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK or tag == "body":
            self.flush()
            if "head" in [t for t, _ in self.open[:3]]:
                self.close_to({"head"}, set())
            self.close_to({"p"}, {"div", "article", "section", "td", "th", "li", "table", "button", "body"})
        if tag in CLOSES:
            self.close_to(CLOSES[tag], SCOPE[tag])
        if tag in VOID:
            if tag == "br":
                self.flush()
            elif tag in ("img", "input"):
                self.parts.append(" ")
            return
        if tag in HIDDEN and tag != "head" and self.ends[tag] <= self.within[tag]:
            return
        names = [tag]
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += [f".{n}" for n in _NAME.findall(value.lower()[:200])]
        self.push(tag, tuple(names))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.ends[tag] -= tag in HIDDEN
        if tag in BLOCK:
            self.flush()
        if any(t == tag for t, _ in self.open):
            self.close_to({tag}, set())

    def handle_data(self, data):
        if self.hidden:
            return
        if self.path is None and not data.isspace():
            self.path = tuple(n for _, names in self.open for n in names)
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a whole page in page order, references decoded and white space made single."""
    reader = _Reader(page or "")
    reader.feed(page or "")
    reader.close()
    reader.flush()
    return reader.blocks


class _Places(dict):
    """Two places and signs of a token among `size`, packed in an integer; remembered."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        self[token] = out = h % self.size | (h >> 8) % self.size << 10 | (h >> 30) << 20
        return out

    def sums(self, rows: list[set[str]]) -> np.ndarray:
        """Signed counts, a row a set of tokens."""
        code = np.array([self[t] for r in rows for t in r], np.int64)
        row = np.repeat(np.arange(len(rows)) * self.size, [len(r) for r in rows])
        n = len(rows) * self.size
        first = np.bincount(row + (code & 1023), 2.0 * (code >> 21 & 1) - 1, n)
        return (first + np.bincount(row + (code >> 10 & 1023), 2.0 * (code >> 20 & 1) - 1, n)).reshape(len(rows), self.size)


_paths, _words = _Places(PATH), _Places(WORDS)


def features(blocks: list[Block]) -> np.ndarray:
    """A row of SIZE numbers per block."""
    x = np.zeros((len(blocks), SIZE), np.float32)
    if not blocks:
        return x
    words = [set(b.text.lower().split()) for b in blocks]
    x[:, :PATH] = _paths.sums([set(b.path) for b in blocks])
    x[:, PATH : PATH + WORDS] = _words.sums(words) / np.sqrt([[len(w)] for w in words])
    size = np.array([len(b.text) for b in blocks])
    marks = [sum(map(b.text.count, ".,;:!?")) for b in blocks]
    x[:, PATH + WORDS :] = np.stack(
        [
            np.log1p(size) / 6,
            np.array([b.linked for b in blocks]) / size,
            np.log1p([len(w) for w in words]) / 4,
            np.array(marks) / size * 10,
            [b.text[-1] in ".!?…\"”" for b in blocks],
            (np.cumsum(size) - size) / size.sum(),
            size / size.sum(),
            np.array([len(b.path) for b in blocks]) / 10,
            [b.path[-1:] == ("a",) for b in blocks],
            np.ones(len(blocks)),
        ],
        axis=1,
    )
    return x


class Labeller:
    """Bidirectional LSTM with one output per step. Weights: for each direction wx, wh, b (gates
    input, forget, output, candidate), and the readout v, c."""

    NAMES = ("wx0", "wh0", "b0", "wx1", "wh1", "b1", "v", "c")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: np.asarray(weights[k], np.float32) for k in self.NAMES}

    @classmethod
    def load(cls) -> "Labeller":
        with np.load(io.BytesIO(pkgutil.get_data(__package__, "labeller.npz"))) as file:
            return cls({k: file[k] for k in cls.NAMES})

    def states(self, x: np.ndarray, mask: np.ndarray, way: int) -> tuple[np.ndarray, list]:
        """x: (steps, pages, SIZE); mask: (steps, pages, 1). Hidden states, and what training needs."""
        wx, wh, b = (self.w[f"{n}{way}"] for n in ("wx", "wh", "b"))
        size = wh.shape[0]
        steps, pages = x.shape[:2]
        inputs = x.reshape(-1, x.shape[2]) @ wx + b
        inputs = inputs.reshape(steps, pages, -1)
        h, c = np.zeros((pages, size), np.float32), np.zeros((pages, size), np.float32)
        out, tape = np.zeros((steps, pages, size), np.float32), []
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            z = inputs[t] + h @ wh
            gates = 1 / (1 + np.exp(-z[:, : 3 * size]))
            i, f, o, g = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :], np.tanh(z[:, 3 * size :])
            c_new = f * c + i * g
            squashed = np.tanh(c_new)
            tape.append((t, h, c, i, f, o, g, squashed))
            c = c_new * mask[t]
            h = o * squashed * mask[t]
            out[t] = h
        return out, tape

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        ahead, _ = self.states(x, mask, 0)
        back, _ = self.states(x, mask, 1)
        return np.concatenate([ahead, back], axis=2) @ self.w["v"] + self.w["c"]

    def keep(self, pages: list[list[Block]], at_once: int = 20_000) -> list[np.ndarray]:
        """For every page, which blocks are main text. Pages of like length are read side by side."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            width = len(pages[order[-1]])
            some = order[-max(1, at_once // width) :]
            del order[len(order) - len(some) :]
            x = np.zeros((width, len(some), SIZE), np.float32)
            mask = np.zeros((width, len(some), 1), np.float32)
            for k, i in enumerate(some):
                x[: len(pages[i]), k] = features(pages[i])
                mask[: len(pages[i]), k] = 1
            score = self.logits(x, mask)[:, :, 0]
            for k, i in enumerate(some):
                out[i] = score[: len(pages[i]), k] > 0
        return out


def extract(labeller: Labeller, pages: list[str | None]) -> list[str]:
    """Main text of every page: kept blocks in page order, joined by one space."""
    out: list[str] = []
    for start in range(0, len(pages), 256):
        blocks = [blocks_of(p) for p in pages[start : start + 256]]
        out += [" ".join(b.text for b, k in zip(bs, keep) if k) for bs, keep in zip(blocks, labeller.keep(blocks))]
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", labeller: Labeller | None = None) -> DataFrame:
    """(id_col, url_col, text, n_chars) per input row; text is empty if a page has none.

    Null and empty html give an empty text; long pages are read whole, block by block. Repeated rows
    get equal answers; the id and url go along as they are, nulls too; an empty table stays empty.
    Other columns are not read, whatever their names.
    """
    labeller = labeller or Labeller.load()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series(extract(labeller, list(some)), dtype=object)

    rows = pages.select(F.col(id_col), F.col(url_col), text(F.col(html_col)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))

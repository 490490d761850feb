"""Main-text extraction with a recurrent block labeller.

A page is read once into its leaf blocks: runs of text between block-level
tags, each with the path of open tags and their class and id words. Every
block becomes a vector: its path's words hashed to flags, its text's words
hashed to a small signed histogram, and a few measures (length, link share,
punctuation). A bidirectional LSTM in numpy reads the page's whole sequence,
so each block is judged in the context of all others.

The model is trained here, on a bounded sample of pages: the ``TRAIN_PAGES``
first in a hash order, of at most ``TRAIN_CHARS`` characters, each to its
``TRAIN_BLOCKS``-th block (every block of every page is labelled). Labels are weak:
words that name parts of pages (WORDS below) decide a block by its path. So
that the model does not hang on one site's markup, each sampled page is also
seen with its parts renamed, with parts of other kinds inserted whose text
comes from the sample, and with some paths hidden.

Null or empty html gives an empty text; a page without main blocks too;
repeated rows get equal texts; unclosed tags, comments, scripts and quotes are
read as a browser would, in time linear in the page; a block's path holds its
``PATH_DEPTH`` innermost elements. Other columns of the input are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskloom.llm.common import U64, buffers, python_stage, slices, word_hashes
from riskloom.session import table_path

TRAIN_PAGES = 240
TRAIN_CHARS = 60_000
TRAIN_BLOCKS = 120  # blocks of a sampled page that are trained on
PATH_DEPTH = 64  # innermost open elements that make a block's path
STEPS, BATCH, RATE = 200, 32, 0.02
HIDDEN = 12
PATH_FLAGS, WORD_FLAGS, MEASURES = 1024, 16, 7

#: Words of tags, classes and ids that say what a part of a page is.
WORDS = {
    True: "article main content post entry story articlebody maincontent",
    False: (
        "nav menu navbar navigation header masthead topbar footer aside sidebar rail ad ads advert advertisement promo sponsor "
        "sponsored banner cookie notice consent alert popup modal form search login signup newsletter subscribe comment comments "
        "reply replies discussion disqus share social related recommended breadcrumb breadcrumbs pagination widget copyright legal "
        "button label select option toolbar tags meta"
    ),
}
_MAIN, _OTHER = (frozenset(WORDS[k].split()) for k in (True, False))

_OPEN = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>"']*+)|[/!?])""")
_QUOTE_OR_END = re.compile("[>\"']")
#: Elements whose content is no markup, each with its end.
_RAW = {x: re.compile(rf"</{x}(?=[\s/>])", re.IGNORECASE) for x in ("script", "style", "iframe", "textarea")}
#: Elements that are left out with their content where an end tag matches; without one only the tag is.
_HIDDEN = {x: re.compile(rf"<(?:(!--)|(/?)({x}|{'|'.join(_RAW)})(?=[\s/>]))", re.IGNORECASE) for x in ("noscript", "template", "svg", "object", "select", "title")}
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Za-z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

Block = tuple[str, str, int]  # path words, text, characters inside links


class _Tags:
    """The tags of a page, found in time linear in it: what was read ahead for one tag is kept for the next."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = page.rfind(">")  # no tag begins behind it
        self.seen = (0, -1)  # nothing to stop at from the first place up to the second
        self.after: dict[int, int] = {}  # a quote -> where a tag that reaches it ends

    def close(self, at: int) -> int:
        """Where the first > outside of quotes stands, -1 where none does."""
        page, passed = self.page, []
        while True:
            if not self.seen[0] <= at <= self.seen[1]:
                m = _QUOTE_OR_END.search(page, at)
                self.seen = (at, m.start() if m else len(page))
            at = self.seen[1]
            if at in self.after or at == len(page):
                found = self.after.get(at, -1)
                break
            if page[at] == ">":
                found = at
                break
            passed.append(at)
            at = page.find(page[at], at + 1) + 1
            if not at:
                found = -1
                break
        for quote in passed:
            self.after[quote] = found
        return found

    def comment(self, at: int) -> int:
        """Where the comment whose text begins there ends."""
        end = self.page.find("-->", at)
        return len(self.page) if end < 0 else end + 3

    def raw(self, name: str, at: int) -> int:
        """Where the raw text that begins there ends, its end tag included."""
        end = _RAW[name].search(self.page, at)
        gone = self.page.find(">", end.end()) if end else -1
        return len(self.page) if gone < 0 else gone + 1

    def next(self, at: int) -> tuple[int, int, str | None, bool, str] | None:
        """(start, end, name, is an end tag, attributes) of the next tag.

        The name is "" for raw text and None for comments, declarations and tags whose quotes never close.
        """
        while m := _OPEN.search(self.page, at):
            start = m.start()
            if m[1]:
                return start, self.comment(m.end()), None, False, ""
            if start > self.last:
                at = self.page.find("<!--", start)
                if at < 0:
                    return None
                continue
            end = self.close(m.end()) if m[3] else -1
            if end < 0:
                return start, self.page.find(">", start) + 1, None, False, ""
            name = m[3].lower()
            if name in _RAW and not m[2] and self.page[m.end()] not in "\"'":
                return start, self.raw(name, end + 1), "", False, ""
            return start, end + 1, name, bool(m[2]), self.page[m.end() : end]
        return None

    def hidden(self, name: str, at: int) -> dict[int, int]:
        """Where each element of that name after ``at`` begins and, by the matching end tag, ends."""
        ends: dict[int, int] = {}
        opened: list[int] = []
        while m := _HIDDEN[name].search(self.page, at):
            start, at = m.start(), m.end()
            if m[1]:
                at = self.comment(at)
                continue
            end = self.close(at)
            found = m[3].lower()
            if end < 0 or (found != name and m[2]):
                continue
            begun, at = at, end + 1
            if found != name:
                at = self.raw(found, at)
            elif not m[2]:
                if not (name == "svg" and self.page[begun:end].endswith("/")):
                    opened.append(start)
            elif opened:
                ends[opened.pop()] = at
        return ends


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order, with white space folded and references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = in_link = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append((" ".join(w for _, w in stack[-PATH_DEPTH:]), text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop() -> str:
        name, _ = stack.pop()
        opened[name] -= 1
        return name

    page = page or ""
    tags = _Tags(page)
    hidden: dict[str, dict[int, int]] = {}
    while tag := tags.next(at):
        start, end, name, is_end, attributes = tag
        if start > at:
            parts.append(page[at:start])
            if in_link:
                linked += start - at
        at = end
        if not name:
            if name == "":
                parts.append(" ")
            continue
        if name in _HIDDEN:
            if not is_end:
                if name not in hidden:
                    hidden[name] = tags.hidden(name, start)
                at = hidden[name].get(start, at)
            parts.append(" ")
            continue
        if name == "head":
            flush()  # what it holds is hidden or begins the body
            continue
        if name in _INLINE:
            if name == "a":
                in_link = 0 if is_end else 1
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        if is_end:
            if opened[name]:
                while pop() != name:
                    pass
                in_link = 0
            continue
        if name in _VOID:
            continue
        if stack and stack[-1][0] == "p":
            pop()  # a paragraph ends where another block begins
        while stack and stack[-1][0] in _CLOSES.get(name, ()):
            pop()
        opened[name] += 1
        named = attributes and " ".join(x for found in _NAMED.findall(attributes) for x in _PART.findall(" ".join(found)))
        stack.append((name, f"{name} {named.lower()}" if named else name))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def weak_label(path: str) -> float:
    """1 main, 0 other, nan if the path does not say."""
    words = path.split()
    if any(w in _OTHER for w in words):
        return 0.0
    return 1.0 if any(w in _MAIN for w in words) else np.nan


class Features:
    """Vectors of blocks: rows of path flags by path number, and dense columns."""

    def __init__(self, blocks: list[Block]) -> None:
        numbers: dict[str, int] = {}
        self.path = np.array([numbers.setdefault(p, len(numbers)) for p, _, _ in blocks], dtype=np.int64)
        data, offsets = buffers(pa.array(list(numbers), pa.string()))
        words, before = word_hashes(data, offsets)
        self.flags = np.zeros((len(numbers) + 1, PATH_FLAGS), dtype=np.float32)  # the last row is a hidden path
        self.flags[np.repeat(np.arange(len(numbers)), np.diff(before)), (words % U64(PATH_FLAGS)).astype(np.int64)] = 1.0

        data, offsets = buffers(pa.array([t for _, t, _ in blocks], pa.string()))
        n = len(blocks)
        words, before = word_hashes(data, offsets)
        count = np.diff(before)
        block = np.repeat(np.arange(n), count)
        slot = (words % U64(WORD_FLAGS)).astype(np.int64)
        sign = np.where((words >> U64(40)) & U64(1), 1.0, -1.0)
        histogram = np.bincount(block * WORD_FLAGS + slot, weights=sign, minlength=n * WORD_FLAGS).reshape(n, WORD_FLAGS).astype(float)
        histogram /= np.sqrt(np.maximum(count, 1))[:, None]
        size = np.maximum(np.diff(offsets), 1)
        share = lambda chars: np.diff(np.concatenate([[0], np.cumsum(np.isin(data, list(chars)))])[offsets]) / size
        links = np.array([x for _, _, x in blocks]) / np.maximum(np.array([len(t) for _, t, _ in blocks]), 1) if n else np.zeros(0)
        measures = [np.log1p(count) / 4, count < 8, links, 10 * share(b".,;:!?"), 10 * share(b"0123456789"), 10 * share(b"|\xc2"), np.ones(n)]
        self.dense = np.concatenate([0.3 * histogram, np.stack(measures, axis=1)], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class Labeller:
    """A bidirectional LSTM with one output for each block."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        size = PATH_FLAGS + WORD_FLAGS + MEASURES
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.w = {"out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for way in "fb":
            self.w[f"x{way}"] = draw(size, 4 * HIDDEN) * 2
            self.w[f"h{way}"] = draw(HIDDEN, 4 * HIDDEN)
            self.w[f"c{way}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)  # the forget gate starts open

    def _run(self, way: str, z: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states over time of projected input ``z`` (time, pages, gates)."""
        h = c = np.zeros((z.shape[1], HIDDEN), dtype=np.float32)
        out, kept = np.empty((*z.shape[:2], HIDDEN), dtype=np.float32), []
        for t in range(len(z)):
            gates = z[t] + h @ self.w[f"h{way}"]
            i, f, o = np.split(_sigmoid(gates[:, : 3 * HIDDEN]), 3, axis=1)
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            s = np.tanh(c)
            kept.append((i, f, o, g, before, s, h))
            h = out[t] = o * s
        return out, kept

    @staticmethod
    def _turned(x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Each page's own blocks in reverse order; padding stays at the end."""
        at = np.arange(len(x))[:, None]
        return x[np.where(at < size, size - 1 - at, at), np.arange(x.shape[1])]

    def scores(self, z: dict[str, np.ndarray], size: np.ndarray) -> tuple[np.ndarray, dict]:
        f, keep_f = self._run("f", z["f"])
        b, keep_b = self._run("b", self._turned(z["b"], size))
        both = np.concatenate([f, self._turned(b, size)], axis=2)
        return (both @ self.w["out"])[:, :, 0] + self.w["bias"], {"both": both, "f": keep_f, "b": keep_b}

    def project(self, features: Features) -> dict[str, np.ndarray]:
        """Every block's input to the gates, both ways; each distinct path is multiplied once."""
        z = {}
        for way in "fb":
            w = self.w[f"x{way}"]
            z[way] = (features.flags @ w[:PATH_FLAGS])[features.path] + features.dense @ w[PATH_FLAGS:] + self.w[f"c{way}"]
        return z

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length run together."""
        features = Features([b for p in pages for b in p])
        z, size = self.project(features), np.array([len(p) for p in pages], dtype=np.int64)
        start, out = np.cumsum(size) - size, [np.zeros(0, bool)] * len(pages)
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        while len(order):
            most = int(np.searchsorted(size[order], max(2 * size[order[0]], 16), "right"))
            some, order = order[:most][:512], order[min(most, 512) :]
            at = np.minimum(np.arange(size[some].max())[:, None], size[some] - 1) + start[some]
            score, _ = self.scores({k: v[at] for k, v in z.items()}, size[some])
            for j, p in enumerate(some):
                out[p] = score[: size[p], j] > 0
        return out

    def train(self, pages: list[tuple[list[Block], np.ndarray]], steps: int = STEPS, seed: int = 7) -> None:
        """Adam on the log loss of blocks whose label is known."""
        rng = np.random.default_rng(seed)
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.w.items()}
        for step in range(1, steps + 1):
            some = [pages[i] for i in rng.permutation(len(pages))[:BATCH]]
            size = np.array([len(b) for b, _ in some])
            features = Features([x for b, _ in some for x in b])
            hidden = rng.random(len(features.path)) < 0.15
            features.path[hidden] = len(features.flags) - 1
            at = np.minimum(np.arange(size.max())[:, None], size - 1) + np.cumsum(size) - size
            valid = np.arange(size.max())[:, None] < size
            target = np.concatenate([y for _, y in some])[at]
            known = valid & ~np.isnan(target)
            z = self.project(features)
            score, kept = self.scores({k: v[at] for k, v in z.items()}, size)
            wrong = np.where(known, _sigmoid(score) - np.nan_to_num(target), 0.0).astype(np.float32) / max(known.sum(), 1)
            grads = {"out": np.einsum("tbh,tb->h", kept["both"], wrong)[:, None], "bias": wrong.sum(keepdims=True)[0, :1]}
            down = wrong[:, :, None] * self.w["out"][:, 0]
            for way, dh in (("f", down[:, :, :HIDDEN]), ("b", self._turned(down[:, :, HIDDEN:], size))):
                dz, grads[f"h{way}"] = self._back(way, dh, kept[way])
                dz = (dz if way == "f" else self._turned(dz, size))[valid]
                rows = at[valid]
                grads[f"x{way}"] = np.concatenate([features.flags[features.path[rows]], features.dense[rows]], axis=1).T @ dz
                grads[f"c{way}"] = dz.sum(axis=0)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                self.w[k] = (self.w[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def _back(self, way: str, dh: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
        dz = np.empty((*dh.shape[:2], 4 * HIDDEN), dtype=np.float32)
        dw, next_h, next_c = np.zeros_like(self.w[f"h{way}"]), 0.0, 0.0
        for t in range(len(dh) - 1, -1, -1):
            i, f, o, g, before, s, h = kept[t]
            d = dh[t] + next_h
            dc = d * o * (1 - s * s) + next_c
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), d * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            dw += h.T @ dz[t]
            next_h, next_c = dz[t] @ self.w[f"h{way}"].T, dc * f
        return dz, dw


def varied(pages: list[list[Block]], seed: int = 3) -> list[tuple[list[Block], np.ndarray]]:
    """Training sequences: each page as it is, and with its parts renamed and others inserted."""
    rng = np.random.default_rng(seed)
    pick = lambda words: words[int(rng.integers(len(words)))]
    main, other = sorted(_MAIN), sorted(_OTHER)
    boxes = ["div", "section", "ul li", "div div", "div p", "div section p"]
    texts = [t for p in pages for _, t, _ in p] or ["text"]
    out = []
    for page in pages:
        page = page[:TRAIN_BLOCKS]
        labels = np.array([weak_label(p) for p, _, _ in page])
        if len(page):
            out.append((page, labels))
        seen: dict[tuple[str, float], str] = {}
        blocks, marks = [], []
        outer = pick(["html body", "html body div", "body", "html body div wrap", ""])
        for (path, text, linked), y in zip(page, labels, strict=True):
            leaf = path.split()[-1] if path else "p"
            if not np.isnan(y):
                new = seen.setdefault((path, y), f"{outer} {pick(boxes)} {pick(main if y else other)} {leaf if y else pick(boxes)}")
                path = f"{path} {new}" if y and rng.random() < 0.2 else new
            if rng.random() < 0.3:
                for _ in range(int(rng.integers(1, 4))):
                    inside = f"{pick(main)} " if not np.isnan(y) and y and rng.random() < 0.5 else ""
                    words = pick(texts).split()
                    text_in = " ".join(words[: int(rng.integers(1, 40))])
                    blocks.append((f"{outer} {inside}{pick(boxes)} {pick(other)} {pick(['p', 'div', 'li', 'span', 'h'])}", text_in, len(text_in) if rng.random() < 0.4 else 0))
                    marks.append(0.0)
            blocks.append((path, text, linked))
            marks.append(y)
        if blocks:
            out.append((blocks, np.array(marks)))
    return out


def trained(pages: DataFrame, html_col: str = "html") -> Labeller:
    """A labeller trained on the bounded sample of ``pages``."""
    page = F.col(html_col)
    sample = pages.select(page.alias("html"), F.xxhash64(F.lit("page"), page).alias("h")).where(F.length("html").between(1, TRAIN_CHARS))
    keys = sample.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).agg(F.max("h").alias("last")).first()["last"]
    rows = sample.where(F.col("h") <= F.lit(keys)).dropDuplicates(["h"]).orderBy("h").limit(TRAIN_PAGES).collect() if keys is not None else []
    labeller = Labeller()
    sequences = varied([blocks_of(r["html"]) for r in rows])
    if sequences:
        labeller.train(sequences)
    return labeller


def extract(pages: DataFrame, labeller: Labeller, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The ``keep`` columns, text (main blocks joined by newlines) and n_chars of every page."""
    spark = pages.sparkSession
    python_stage(spark)
    sent = spark.sparkContext.broadcast(labeller)  # a few thousand weights
    pages = pages.select(*keep, html_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffers(batch.column(len(keep)))
            for lo, hi in slices(offsets, 1 << 21):
                parsed = [blocks_of(x) for x in batch.column(len(keep)).slice(lo, hi - lo).to_pylist()]
                texts = ["\n".join(t for (_, t, _), y in zip(p, main, strict=True) if y) for p, main in zip(parsed, sent.value.label(parsed), strict=True)]
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    fields = [f for f in pages.schema.fields if f.name in keep]
    return pages.mapInArrow(rows, StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())]))


def op8_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(table_path(sf_dir, "pages"))
    return extract(pages, trained(pages))

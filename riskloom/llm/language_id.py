"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased and cut into runs of letters; each run is a sequence with
a boundary before and after. Every language has a model of order ``ORDER``
over these sequences. Lower orders count the distinct symbols seen before a
sequence (raw counts where only the boundary can precede). Models lie in
sorted 64-bit hash arrays, one for the sequences and one for the contexts of
each order, with a column per language: one binary search serves them all.

A document gets the language of least cross-entropy (bits a symbol). The score
is a softmax whose temperature maximises the likelihood of held-out training
rows; a document is *rejected* when it has no letter or when its cross-entropy
lies far beyond what the held-out rows of its language show at its length.

The models are fitted on a bounded sample: per language the ``rows_per_lang``
distinct texts first in a hash order, and of their sequences the ``max_grams``
most frequent of each order. Counting runs on Spark; only that bounded table
reaches the driver. Every row is scored on its whole text, each distinct
word of a batch once.

Defined results: null text, or text without a letter, gives ``und``, score 0
and rejected; rows without a label or a doc_id are scored but not learned
from; an empty training set gives ``und`` everywhere; equal cross-entropies
give the first language by name; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.llm.common import U64, Rolling, buffers, python_stage, slices, staged
from riskloom.session import table_path

ORDER = 5
ROWS_PER_LANG = 3000
MAX_GRAMS = 100_000
HELD_TEXTS = 20  # held-out texts that a language's limits need; with fewer texts in all, none is held out
MARGIN_BITS = 1.0  # a text is rejected only this far beyond eight spreads
_SYMBOLS = Rolling(0xDA942042E4DD58B5)
_EDGE = 0x10FFFF  # the boundary symbol; not a character

GRAMS = "lang string, ord int, gram long, ctx long, suf long, head boolean, cnt long"
SCORED = "lang_pred string, score double, bits double, symbols long, rejected boolean"


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


class Words:
    """Runs of letters of some texts, framed by boundaries, each distinct one kept once."""

    def __init__(self, texts: list[str | None]) -> None:
        low = [(t or "").lower() for t in texts]
        ends = np.cumsum([len(t) + 1 for t in low])
        codes = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        first, last = letter.copy(), letter.copy()
        first[1:] &= ~letter[:-1]
        last[:-1] &= ~letter[1:]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.texts = len(texts)
        self.text = np.searchsorted(ends, start, "right")
        hashes = _SYMBOLS.ranges(codes.astype(U64), start, end)
        _, at, self.kind = np.unique(hashes, return_index=True, return_inverse=True)
        size = (end - start)[at] + 2
        cuts = np.concatenate([[0], np.cumsum(size)])
        #: Symbols of the distinct words, and for each its place in the word and the word.
        self.place = np.arange(cuts[-1]) - np.repeat(cuts[:-1], size)
        self.word = np.repeat(np.arange(len(at)), size)
        self.codes = np.full(cuts[-1], _EDGE, dtype=U64)
        inner = (self.place > 0) & (self.place < np.repeat(size, size) - 1)
        self.codes[inner] = codes[np.repeat(start[at] - 1, size)[inner] + self.place[inner]]

    def grams(self, order: int) -> tuple[np.ndarray, ...]:
        """Positions that end a sequence of that order, and the hashes of sequence, context and suffix."""
        at = np.flatnonzero(self.place >= max(order - 1, 1))
        r = lambda lo, hi: _SYMBOLS.ranges(self.codes, lo, hi)
        lo = at - order + 1
        return at, r(lo, at + 1), r(lo, at), r(lo + 1, at + 1)


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of all sequences up to ``order`` in ``rows`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                own = batch.column(1).filter(pa.array(langs == lang))
                _, offsets = buffers(own)
                for lo, hi in slices(offsets):
                    words = Words(own.slice(lo, hi - lo).to_pylist())
                    times = np.bincount(words.kind, minlength=words.word.max(initial=-1) + 1)
                    for n in range(1, order + 1):
                        at, gram, ctx, suf = words.grams(n)
                        _, first, kind = np.unique(gram, return_index=True, return_inverse=True)
                        total = np.bincount(kind, weights=times[words.word[at]], minlength=len(first)).astype(np.int64)
                        k = len(first)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * k, pa.string()),
                                pa.array(np.full(k, n, dtype=np.int32)),
                                *(pa.array(x[first].view(np.int64)) for x in (gram, ctx, suf)),
                                pa.array(words.place[at][first] == n - 1),
                                pa.array(total),
                            ],
                            names=["lang", "ord", "gram", "ctx", "suf", "head", "cnt"],
                        )

    keys = ["lang", "ord", "gram", "ctx", "suf", "head"]
    return rows.mapInArrow(count, GRAMS).groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


class Models:
    """All languages' models: per order, sorted hashes with a column of log2 values per language."""

    def __init__(self, langs: list[str], counts: dict[str, list[dict[str, np.ndarray]]], order: int) -> None:
        self.langs, self.order = langs, order
        self.temperature = 1.0
        self.limits = np.full((len(langs), 3), np.inf)  # mean, spread between texts, spread of a symbol
        known = max((len(counts[x][0]["gram"]) for x in langs), default=0)
        self.floor = -np.log2(known + 2.0)
        fitted = [self._fit(counts[x]) for x in langs]
        self.grams, self.contexts = [], []
        for n in range(order):
            self.grams.append(_columns([f[n][0] for f in fitted], np.nan))
            self.contexts.append(_columns([f[n][1] for f in fitted], 0.0))

    def _fit(self, orders: list[dict[str, np.ndarray]]) -> list[tuple]:
        out, below = [], None
        for n, own in enumerate(orders, 1):
            gram, ctx, suf = own["gram"], own["ctx"], own["suf"]
            count = own["cnt"].astype(float)
            if n < len(orders):  # distinct symbols before the sequence, where a symbol can stand
                seen, before = np.unique(orders[n]["suf"], return_counts=True)
                if len(seen):
                    at = np.minimum(np.searchsorted(seen, gram), len(seen) - 1)
                    count = np.where(own["head"] | (seen[at] != gram), count, before[at])
            once, twice = (count == 1).sum(), (count == 2).sum()
            cut = once / (once + 2.0 * twice) if once and twice else 0.5
            seen, kind = np.unique(ctx, return_inverse=True)
            total, types = np.bincount(kind, weights=count), np.bincount(kind)
            lower = 2.0**self.floor if below is None else below(suf)
            left = cut * types / total
            p = np.maximum(count - cut, 0) / total[kind] + left[kind] * lower
            sort = np.argsort(gram)
            keys, values = gram[sort], p[sort]
            out.append(((keys, np.log2(values)), (seen, np.log2(left))))

            def below(suffix, keys=keys, values=values):  # noqa: ANN001, ANN202
                # a sequence's suffix was counted with it, unless its own order dropped it as rare
                at = np.minimum(np.searchsorted(keys, suffix), len(keys) - 1)
                return np.where(keys[at] == suffix, values[at], values.min())
        return out

    def bits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Bits of every text under each language, and its symbols."""
        kinds = int(words.kind.max(initial=-1)) + 1
        cost = np.zeros((kinds, len(self.langs)))
        place = words.place
        todo = np.flatnonzero(place > 0)
        logp = np.zeros((len(todo), len(self.langs)))
        unset = np.ones_like(logp, dtype=bool)
        for n in range(self.order, 0, -1):
            some = np.flatnonzero((place[todo] >= n - 1) & unset.any(axis=1))
            end = todo[some] + 1
            lo = end - n
            found = _lookup(self.grams[n - 1], _SYMBOLS.ranges(words.codes, lo, end), np.nan)
            hit = unset[some] & ~np.isnan(found)
            back = _lookup(self.contexts[n - 1], _SYMBOLS.ranges(words.codes, lo, end - 1), 0.0)
            logp[some] += np.where(unset[some], np.where(hit, found, back), 0.0)
            unset[some] &= ~hit
        logp += np.where(unset, self.floor, 0.0)
        for k in range(len(self.langs)):
            cost[:, k] = np.bincount(words.word[todo], weights=-logp[:, k], minlength=kinds)
        total = np.stack([np.bincount(words.text, weights=cost[words.kind, k], minlength=words.texts) for k in range(len(self.langs))], axis=1) if self.langs else np.zeros((words.texts, 0))
        length = np.bincount(words.word, minlength=kinds) - 1
        return total, np.bincount(words.text, weights=length[words.kind], minlength=words.texts).astype(np.int64)

    def predict(self, texts: list[str | None]) -> dict[str, list]:
        if not self.langs:
            none = len(texts)
            return {"lang": ["und"] * none, "score": [0.0] * none, "bits": [None] * none, "symbols": [0] * none, "rejected": [True] * none}
        total, symbols = self.bits(Words(texts))
        bits = total / np.maximum(symbols, 1)[:, None]
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(bits)), best]
        score = 1.0 / np.exp2(-self.temperature * (bits - least[:, None])).sum(axis=1)
        mean, between, within = self.limits[best].T
        far = least > mean + MARGIN_BITS + 8.0 * np.sqrt(between**2 + within**2 / np.maximum(symbols, 1))
        some = symbols > 0
        return {
            "lang": [self.langs[k] if s else "und" for k, s in zip(best, some, strict=True)],
            "score": np.where(some, score, 0.0).tolist(),
            "bits": [float(x) if s else None for x, s in zip(least, some, strict=True)],
            "symbols": symbols.tolist(),
            "rejected": (far | ~some).tolist(),
        }

    def calibrate(self, bits: np.ndarray, symbols: np.ndarray, true: np.ndarray) -> None:
        """Temperature and rejection limits from labelled texts that were not learned from."""
        if not len(bits):
            return
        own = bits[np.arange(len(bits)), true]
        grid = np.exp2(np.arange(-1, 7, 0.5))
        loss = [np.log(np.exp2(-t * (bits - own[:, None])).sum(axis=1)).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        for k in range(len(self.langs)):
            x, n = own[true == k], symbols[true == k]
            if len(x) >= HELD_TEXTS:
                mean = np.median(x)
                z = np.abs(x - mean) * np.sqrt(n)
                long = n >= np.median(n)
                self.limits[k] = mean, 1.4826 * np.median(np.abs(x[long] - mean)), 1.4826 * np.median(z)


def _columns(parts: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([p[0] for p in parts])) if parts else np.zeros(0, dtype=U64)
    table = np.full((len(keys), len(parts)), missing, dtype=np.float32)
    for k, (own, value) in enumerate(parts):
        table[np.searchsorted(keys, own), k] = value
    return keys, table


def _lookup(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, missing: float) -> np.ndarray:
    """Rows of the hashes; those not there get ``missing`` for every language."""
    keys, values = table
    if not len(keys):
        return np.full((len(hashes), values.shape[1]), missing, dtype=np.float32)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where((keys[at] == hashes)[:, None], values[at], np.float32(missing))


def _bits(rows: DataFrame, models: Models) -> DataFrame:
    """lang, bits a symbol under each model, and symbols of ``rows`` (lang, text) that have some."""
    sent = rows.sparkSession.sparkContext.broadcast(models)  # bounded by max_grams

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffers(batch.column(1))
            for lo, hi in slices(offsets):
                total, symbols = sent.value.bits(Words(batch.column(1).slice(lo, hi - lo).to_pylist()))
                langs = batch.column(0).slice(lo, hi - lo).to_pylist()
                use = np.flatnonzero((symbols > 0) & np.isin(langs, sent.value.langs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[i] for i in use], pa.string()), pa.array((total[use] / symbols[use, None]).tolist(), pa.list_(pa.float64())), pa.array(symbols[use])],
                    names=["lang", "bits", "symbols"],
                )

    return rows.mapInArrow(measure, "lang string, bits array<double>, symbols long")


def fit(rows: DataFrame, order: int = ORDER, rows_per_lang: int = ROWS_PER_LANG, max_grams: int = MAX_GRAMS) -> Models:
    """Models from labelled ``rows`` (lang, text), bounded as the module docstring says."""
    python_stage(rows.sparkSession)
    rows = rows.where("lang is not null and text is not null").withColumn("h", F.xxhash64(F.lit("lang"), "text"))
    first = W.partitionBy("lang").orderBy("h")
    keys = rows.select("lang", "h").dropDuplicates()  # copies of a text count once
    ends = keys.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= rows_per_lang)
    ends = ends.groupBy("lang").agg(F.max("h").alias("last"), (F.count(F.lit(1)) < HELD_TEXTS).alias("few"))  # a row a language; texts do not move for it
    sample = rows.join(F.broadcast(ends), "lang").where("h <= last").dropDuplicates(["lang", "h"])
    sample = sample.select("lang", "text", (F.expr("pmod(h, 6) = 0") & ~F.col("few")).alias("held"))
    sample = staged(sample.repartition(16), "lang-sample")
    learned = sample.where("not held").select("lang", "text")
    often = W.partitionBy("lang", "ord").orderBy(F.desc("cnt"), "gram")
    counted = gram_counts(learned, order).withColumn("nth", F.row_number().over(often)).where(F.col("nth") <= max_grams).drop("nth")
    table = counted.toArrow()  # at most max_grams rows for each language and order
    langs = sorted(set(table.column("lang").to_pylist()))
    which, ords = np.array(table.column("lang").to_pylist(), dtype=object), table.column("ord").to_numpy()
    columns = {c: table.column(c).to_numpy() for c in ("gram", "ctx", "suf", "head", "cnt")}
    columns |= {c: columns[c].view(U64) for c in ("gram", "ctx", "suf")}
    counts = {x: [{c: v[(which == x) & (ords == n)] for c, v in columns.items()} for n in range(1, order + 1)] for x in langs}
    models = Models([x for x in langs if len(counts[x][0]["gram"])], counts, order)
    if models.langs:
        checked = _bits(sample.where("held").select("lang", "text"), models).toArrow()  # numbers for a sixth of the sample
        true = np.array([models.langs.index(x) for x in checked.column("lang").to_pylist()], dtype=int)
        models.calibrate(np.array(checked.column("bits").to_pylist()).reshape(-1, len(models.langs)), checked.column("symbols").to_numpy(), true)
    return models


def identify(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, bits, symbols and rejected (replaced if they are there)."""
    spark = docs.sparkSession
    python_stage(spark)
    sent = spark.sparkContext.broadcast(models)  # bounded by max_grams
    added = {"lang_pred", "score", "bits", "symbols", "rejected"}
    docs = docs.select(*[c for c in docs.columns if c not in added])
    at = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffers(batch.column(at))
            for lo, hi in slices(offsets):
                own = batch.slice(lo, hi - lo)
                found = sent.value.predict(own.column(at).to_pylist())
                new = [
                    pa.array(found["lang"], pa.string()),
                    pa.array(found["score"], pa.float64()),
                    pa.array(found["bits"], pa.float64()),
                    pa.array(found["symbols"], pa.int64()),
                    pa.array(found["rejected"], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*own.columns, *new], names=[*own.schema.names, "lang_pred", "score", "bits", "symbols", "rejected"])

    return docs.mapInArrow(predict, StructType([*docs.schema.fields, *spark.createDataFrame([], SCORED).schema.fields]))


def held_out(id_col: str = "doc_id"):  # noqa: ANN201
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame) -> Models:
    """Models from the rows of ``docs`` (doc_id, text, lang) that aren't held out."""
    return fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).select("lang", "text"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    models = trained(docs)
    found = identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits", "symbols", "rejected")

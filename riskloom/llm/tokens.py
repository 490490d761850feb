"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is parsed here; from it come the normaliser
(character map, whitespace rules, dummy prefix, metaspace marker), the model
(unigram scores, or merges in score order) with byte fallback, and the
decoder. Batches are encoded by the library's thread pool.

Where no piece has the marker behind another symbol, no merge can cross a
single space. A text is then cut at its spaces and each distinct part is
encoded once per worker; texts with runs of spaces or literal markers, and all
texts of other models, are encoded whole. Both give the same ids.

Parity with the sentencepiece library and decoding back to the normalised text
are verified for every distinct part and every text encoded whole; nothing is
sampled.

Defined results: null and empty text have no tokens, parity and round trip;
a literal marker character decodes to a space; repeated rows get equal ids;
other columns pass through, and ones named like a result are replaced.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from riskloom.llm.common import buffers, python_stage, slices
from riskloom.session import table_path

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 200_000  # distinct parts a worker keeps before it starts anew
GROUP = 1000  # parts encoded as one text
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2


def _wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        number, kind = key >> 3, key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"protobuf wire type {kind}")
        yield number, value


@dataclass
class Model:
    """What a model file says that encoding needs."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in _wire(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _wire(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                if kind == UNKNOWN:
                    model.unknown = len(model.pieces)
                model.pieces.append((piece, score, kind))
            elif number == 2:
                trainer = dict(_wire(value))
                model.kind, model.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                norm = dict(_wire(value))
                model.charsmap = norm.get(2, b"")
                model.dummy_prefix, model.squeeze, model.escape = bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge models are supported")
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that make each piece, best piece first: what the model's scores say pair by pair."""
        ids = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        ranked = []
        for piece, score, kind in self.pieces:
            if kind == NORMAL:
                pairs = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in ids and piece[i:] in ids]
                ranked += [(-score, ids[piece], ids[a], ids[b], a, b) for a, b in pairs]
        return [(a, b) for *_, a, b in sorted(ranked)]

    @property
    def cuts_at_spaces(self) -> bool:
        """A single space starts a new part of the text for this model."""
        plain = not self.charsmap and not self.squeeze and self.dummy_prefix and self.escape
        kinds = {k for _, _, k in self.pieces}
        return plain and self.kind == BPE and USER not in kinds and not any(MARK in p.lstrip(MARK) for p, _, _ in self.pieces)

    def tokenizer(self, prefixed: bool = True):  # noqa: ANN201
        """The tokenizers pipeline; without ``prefixed`` the input already starts with the marker."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        if self.kind == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown, self.byte_fallback)
        else:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab, self.merges(), unk_token=self.pieces[self.unknown][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix and prefixed:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        if steps:
            out.normalizer = normalizers.Sequence(steps)
        users = [AddedToken(p, normalized=False) for p, _, k in self.pieces if k == USER]
        if users:
            out.add_tokens(users)
        parts = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        out.decoder = decoders.Sequence([*parts, decoders.Strip(" ", 1, 0)] if self.dummy_prefix else parts)
        return out


@dataclass
class Encoded:
    """Ids of some texts, flat, with each text's cut, and what was verified of each."""

    ids: np.ndarray
    cuts: np.ndarray
    parity: np.ndarray
    round_trip: np.ndarray

    def lists(self) -> list[list[int]]:
        return [x.tolist() for x in np.split(self.ids, self.cuts[1:-1])] if len(self.cuts) > 1 else []


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(size.sum())), size


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs values[start : start + size], one after the other."""
    to = np.cumsum(size) - size
    return values[np.arange(size.sum()) + np.repeat(start - to, size)]


class Encoder:
    """One worker's tokenizer, its checker and the pieces it has encoded."""

    def __init__(self, data: bytes, verify: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        self.model = Model.parse(data)
        self.whole = self.model.tokenizer()
        self.cut = self.model.cuts_at_spaces
        self.first = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
        self.checker = None
        if verify:
            from sentencepiece import SentencePieceProcessor

            self.checker = SentencePieceProcessor(model_proto=data)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.size, self.good = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, 2), bool)

    def _direct(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, sizes, and (parity, round trip) of texts encoded whole."""
        found = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        good = np.ones((len(texts), 2), dtype=bool)
        if self.checker:
            want = self.checker.encode(texts, num_threads=1)
            good[:, 0] = [a == b for a, b in zip(found, want, strict=True)]
            good[:, 1] = [a == self.normal(t) for a, t in zip(self.decode(found), texts, strict=True)]
        return *_flat(found), good

    def _learn(self, parts: set[str]) -> None:
        """Encode the parts not yet known, many in one text: every part begins with a piece that has the marker."""
        new = [p for p in parts if p not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self._forget()
            new = list(parts)
        if not new:
            return
        groups = [new[i : i + GROUP] for i in range(0, len(new), GROUP)]
        ids, _, good = self._direct([" ".join(g) for g in groups])
        good = np.repeat(good, [len(g) for g in groups], axis=0)
        cuts = np.flatnonzero(self.first[ids])
        size = np.diff(np.append(cuts, len(ids)))
        if len(size) != len(new) or not good.all():  # look at each part on its own
            ids, size, good = self._direct(new)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.ids, self.size, self.good = np.concatenate([self.ids, ids]), np.concatenate([self.size, size]), np.concatenate([self.good, good])

    def encode(self, texts: list[str]) -> Encoded:
        """Ids of each text, whether they equal the sentencepiece library's, and whether they decode to the text."""
        cut = [self.cut and " " not in (t[:1], t[-1:]) and "  " not in t and MARK not in t for t in texts]
        split = [t.split(" ") if c and t else [] for t, c in zip(texts, cut, strict=True)]
        self._learn(set(chain.from_iterable(split)))
        n_parts = np.array([len(x) for x in split], dtype=np.int64)
        part = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(n_parts.sum()))
        before = np.concatenate([[0], np.cumsum(n_parts)])
        done = np.concatenate([[0], np.cumsum(self.size[part])])
        size = done[before[1:]] - done[before[:-1]]
        bad = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(~self.good[part], axis=0)])
        good = bad[before[1:]] == bad[before[:-1]]
        ids = _gather(self.ids, (np.cumsum(self.size) - self.size)[part], self.size[part])
        if not all(cut):
            whole = [i for i, c in enumerate(cut) if not c]
            own, n, good[whole] = self._direct([texts[i] for i in whole])
            start = np.cumsum(size) - size
            start[whole], size[whole] = len(ids) + np.cumsum(n) - n, n
            ids = _gather(np.concatenate([ids, own]), start, size)
        return Encoded(ids, np.concatenate([[0], np.cumsum(size)]), good[:, 0], good[:, 1])

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)

    def normal(self, text: str) -> str:
        """The text that decoding gives back."""
        if self.model.charsmap or self.model.squeeze:
            out = self.whole.normalizer.normalize_str(text).replace(MARK, " ")
            return out[1:] if self.model.dummy_prefix and out[:1] == " " else out
        return text.replace(MARK, " ")


def load_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, text_col: str = "text", model: bytes | None = None, verify: bool = True, keep_text: bool = True) -> DataFrame:
    """``docs`` with ids, n_tokens, parity and round_trip (both null without ``verify``)."""
    spark = docs.sparkSession
    python_stage(spark)
    sent = spark.sparkContext.broadcast(load_model() if model is None else model)  # one model file
    new = [("ids", ArrayType(IntegerType())), ("n_tokens", LongType()), ("parity", BooleanType()), ("round_trip", BooleanType())]
    names = [n for n, _ in new]
    docs = docs.select(*[c for c in docs.columns if c not in names])
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    at = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(sent.value, verify)
            _, offsets = buffers(batch.column(at))
            for lo, hi in slices(offsets):
                own = batch.slice(lo, hi - lo)
                done = encoder.encode([t or "" for t in own.column(at).to_pylist()])
                checked = [pa.array(x if verify else [None] * (hi - lo), pa.bool_()) for x in (done.parity, done.round_trip)]
                lists = pa.ListArray.from_arrays(pa.array(done.cuts.astype(np.int32)), pa.array(done.ids))
                found = [lists, pa.array(np.diff(done.cuts)), *checked]
                yield pa.RecordBatch.from_arrays([own.column(f.name) for f in fields] + found, names=[f.name for f in fields] + names)

    return docs.mapInArrow(rows, StructType([*fields, *[StructField(n, t) for n, t in new]]))


def decode(rows: DataFrame, ids_col: str = "ids", model: bytes | None = None) -> DataFrame:
    """``rows`` with ``decoded``, the text of their ids (null stays null)."""
    spark = rows.sparkSession
    python_stage(spark)
    sent = spark.sparkContext.broadcast(load_model() if model is None else model)  # one model file
    rows = rows.select(*[c for c in rows.columns if c != "decoded"])
    at = rows.columns.index(ids_col)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(sent.value, verify=False)
            lists = batch.column(at).to_pylist()
            found = [None if x is None else t for x, t in zip(lists, encoder.decode([x or [] for x in lists]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(texts, StructType([*rows.schema.fields, StructField("decoded", StringType())]))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    return encode(docs.select("doc_id", "text"), keep_text=False)

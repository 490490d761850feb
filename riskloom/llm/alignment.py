"""Alignment of two tokenizers' tokens over the same texts.

Tokenizer A (tokenizers, byte-level) reads space + text, tokenizer B
(sentencepiece) the text, to which it adds that space. Each library says where
its tokens end: A by character offsets, B by the spans of its proto (byte
spans in the installed version, where the immutable proto is named ``proto``).
These are the coarse cuts. Tokens inside a multibyte character, which share
their character's offsets or have empty spans, are refined by their decoded
bytes. Bytes where tokens of both end cut the text into groups; the last
tokens of a group end together and are linked.

One of two tokens that end together is a suffix of the other in bytes, so the
possible links are those suffix pairs of the vocabularies, whatever the
corpus: they are numbered, and the corpus-wide count of each is one table of
fixed size, the only thing that is broadcast besides the two vocabularies.

Where a space that follows a non-space always starts a new token in both, a
text is cut at these spaces and each distinct part is aligned once per worker;
otherwise texts are aligned whole. Both give the same tokens.

Defined results: null and empty texts, and texts whose tokens' bytes differ
from space + text in A or B (a literal marker character), have no tokens:
zeros and an empty digest; special tokens' strings are plain text; repeated
rows get equal results and count each; other columns pass through, and ones
named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from riskloom.llm.common import buffers, python_stage, slices, staged
from riskloom.llm.tokens import MARK, MODEL_PATH, Model, load_model
from riskloom.session import table_path

BYTE_LEVEL_PATH = "/opt/tokenizers/byte_bpe_50k.json"
REMEMBERED, REMEMBERED_CHARS = 250_000, 1 << 25  # distinct parts a worker keeps before it starts anew
GROUP = 500  # parts encoded as one text
_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character in a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Each id's bytes, flat."""

    entries: list[bytes]

    def __post_init__(self) -> None:
        self.size = np.array([len(e) for e in self.entries], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.entries), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        to = np.cumsum(size) - size
        return self.flat[np.arange(size.sum()) + np.repeat(self.start[ids] - to, size)]


def suffix_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted codes (A id * B's size + B id) of all pairs where one's bytes end the other's."""
    by_bytes: tuple[dict[bytes, list[int]], ...] = ({}, {})
    for known, entries in zip(by_bytes, (a, b), strict=True):
        for i, e in enumerate(entries):
            known.setdefault(e, []).append(i)
    codes = [i * len(b) + j for i, e in enumerate(a) for k in range(len(e)) for j in by_bytes[1].get(e[k:], ())]
    codes += [i * len(b) + j for j, e in enumerate(b) for k in range(1, len(e)) for i in by_bytes[0].get(e[k:], ())]
    return np.unique(np.array(codes, dtype=np.int64))


def _splits_at_spaces(a: bytes) -> bool:
    """A's words are those of the byte-level pattern, and nothing rewrites a text before."""
    spec = json.loads(a)
    step = spec["pre_tokenizer"] or {}
    return spec["normalizer"] is None and step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space", True)


class Aligner:
    """Both tokenizers, the numbered pairs, and the parts that a worker has aligned."""

    def __init__(self, a: bytes, b: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        entries = [names.get(i, "") for i in range(max(names) + 1)]
        self.a_bytes = Vocabulary([bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode("utf-8") for t in entries])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = Vocabulary(
            [bytes([int(_BYTE.fullmatch(p)[1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode("utf-8") for i, p in enumerate(pieces)]
        )
        self.pairs = suffix_pairs(self.a_bytes.entries, self.b_bytes.entries)
        self.cut = Model.parse(b).cuts_at_spaces and _splits_at_spaces(a)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.texts: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, 1 if the bytes differ
        self.links = np.zeros(0, np.int32)

    @staticmethod
    def _refined(coarse: np.ndarray, whole: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ends of tokens: the coarse one where it ends a character, else the bytes since the last such."""
        done = np.cumsum(size)
        at = np.maximum.accumulate(np.where(whole, np.arange(len(size)), -1))
        back = np.concatenate([[-1], at[:-1]])  # the last whole token before each
        base = np.where(back >= 0, coarse[back] - done[back], 0)
        return np.where(whole, coarse, base + done)

    def _ends(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text, space + text's bytes, A's and B's ids, and the bytes at which their tokens end."""
        for text, read in zip(texts, self.a.encode_batch([" " + t for t in texts], add_special_tokens=False), strict=True):
            raw = (" " + text).encode("utf-8")
            octets = np.frombuffer(raw, dtype=np.uint8)
            at = np.append(np.flatnonzero((octets & 0xC0) != 0x80), len(octets))  # byte of each character
            a_ids = np.array(read.ids, dtype=np.int64)
            offsets = np.array(read.offsets, dtype=np.int64).reshape(-1, 2)
            whole = np.append(offsets[1:, 0] >= offsets[:-1, 1], True)[: len(a_ids)]
            a_end = self._refined(at[offsets[:, 1]], whole, self.a_bytes.size[a_ids])
            proto = self.b.encode(text, return_type="proto")
            spans = np.array([(p.id, p.begin, p.end) for p in proto.pieces], dtype=np.int64).reshape(-1, 3)
            b_ids = spans[:, 0]
            # spans are of the text without the added space
            b_end = self._refined(spans[:, 2] + 1, spans[:, 2] > spans[:, 1], self.b_bytes.size[b_ids])
            yield raw, a_ids, a_end, b_ids, b_end

    def _same(self, raw: bytes, a_ids: np.ndarray, b_ids: np.ndarray) -> bool:
        return self.a_bytes.joined(a_ids).tobytes() == raw and self.b_bytes.joined(b_ids).tobytes() == raw

    def _parts(self, raw_ends: np.ndarray, a_ids, a_end, b_ids, b_end) -> tuple[list[str], np.ndarray, np.ndarray]:  # noqa: ANN001
        """Digest text, counts and links of each part, given the byte at which it ends."""
        cuts = a_end[np.isin(a_end, b_end)]
        a_last, b_last = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        code = a_ids[a_last] * len(self.b_bytes.entries) + b_ids[b_last]
        links = np.searchsorted(self.pairs, code).astype(np.int32)
        done = np.searchsorted(cuts, raw_ends, "right")
        counts = np.zeros((len(raw_ends), 4), np.int64)
        counts[:, 0] = np.diff(np.searchsorted(a_end, raw_ends, "right"), prepend=0)
        counts[:, 1] = np.diff(np.searchsorted(b_end, raw_ends, "right"), prepend=0)
        counts[:, 2] = np.diff(done, prepend=0)
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        groups, i, j = [], 0, 0
        for m, n in zip((a_last + 1).tolist(), (b_last + 1).tolist(), strict=True):
            groups.append(",".join(a_text[i:m]) + "|" + ",".join(b_text[j:n]))
            i, j = m, n
        bounds = [0, *done.tolist()]
        return [";".join(groups[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)], counts, links

    def _direct(self, parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Each part on its own."""
        texts, counts, links = [], np.zeros((len(parts), 4), np.int64), []
        for i, (raw, a_ids, a_end, b_ids, b_end) in enumerate(self._ends(parts)):
            if self._same(raw, a_ids, b_ids):
                text, counts[i : i + 1], link = self._parts(np.array([len(raw)]), a_ids, a_end, b_ids, b_end)
                texts += text
                links.append(link)
            else:
                texts.append("")
                counts[i, 3] = 1
        return texts, counts, np.concatenate([np.zeros(0, np.int32), *links])

    def _joint(self, parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Parts aligned as one text; each begins with a space after a non-space, so tokens never span two."""
        raw, a_ids, a_end, b_ids, b_end = next(self._ends([" ".join(parts)]))
        ends = np.cumsum([len(p.encode("utf-8")) + 1 for p in parts])
        if not self._same(raw, a_ids, b_ids) or not (np.isin(ends, a_end) & np.isin(ends, b_end)).all():
            return self._direct(parts)
        return self._parts(ends, a_ids, a_end, b_ids, b_end)

    def _learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self.place]
        chars = sum(map(len, new))
        if len(self.place) + len(new) > REMEMBERED or self.chars + chars > REMEMBERED_CHARS:
            self._forget()
            new = list(parts)
            chars = sum(map(len, new))
        alone = [p for p in new if p[-1].isspace()]  # only where a text ends
        joint = [p for p in new if not p[-1].isspace()] if self.cut else []
        alone = alone if self.cut else new
        done = [self._joint(joint[i : i + GROUP]) for i in range(0, len(joint), GROUP)] + ([self._direct(alone)] if alone else [])
        self.place.update(zip(joint + alone, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.chars += chars
        self.texts += chain.from_iterable(d[0] for d in done)
        self.counts = np.concatenate([self.counts, *[d[1] for d in done]])
        self.links = np.concatenate([self.links, *[d[2] for d in done]])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Counts (A tokens, B tokens, groups) and digest of each text, and all links with each text's cut."""
        split = [(_CUT.split(t) if self.cut else [t]) if t else [] for t in texts]
        self._learn(set(chain.from_iterable(split)))
        n_parts = np.array([len(x) for x in split], dtype=np.int64)
        part = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(n_parts.sum()))
        before = np.concatenate([[0], np.cumsum(n_parts)])
        total = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.counts[part], axis=0)])
        counts = total[before[1:]] - total[before[:-1]]
        good = (counts[:, 3] == 0) & (n_parts > 0)
        counts = np.where(good[:, None], counts[:, :3], 0)
        digests = []
        for i, ok in enumerate(good.tolist()):
            names = map(self.texts.__getitem__, part[before[i] : before[i + 1]].tolist())
            digests.append(hashlib.sha256(";".join(names).encode("ascii")).hexdigest() if ok else "")
        kept = part[np.repeat(good, n_parts)]
        size = self.counts[kept, 2]
        start = (np.cumsum(self.counts[:, 2]) - self.counts[:, 2])[kept]
        links = self.links[np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)]
        return counts, digests, links, np.concatenate([[0], np.cumsum(counts[:, 2])])


@lru_cache(maxsize=2)
def _worker(a: bytes, b: bytes) -> Aligner:
    return Aligner(a, b)


def aligned(docs: DataFrame, a: bytes, b: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` without their text, with n_a, n_b, n_groups, groups_sha256 and links (numbers of suffix pairs)."""
    spark = docs.sparkSession
    python_stage(spark)
    sent = spark.sparkContext.broadcast((a, b))  # two vocabulary files
    new = [("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()), ("groups_sha256", StringType()), ("links", ArrayType(IntegerType()))]
    docs = docs.select(*[c for c in docs.columns if c not in {n for n, _ in new}])
    fields = [f for f in docs.schema.fields if f.name != text_col]
    at = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            aligner = _worker(*sent.value)
            _, offsets = buffers(batch.column(at))
            for lo, hi in slices(offsets, 1 << 21):
                own = batch.slice(lo, hi - lo)
                counts, digests, links, cuts = aligner.align(own.column(at).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(links))
                found = [*[pa.array(counts[:, k].copy()) for k in range(3)], pa.array(digests, pa.string()), lists]
                yield pa.RecordBatch.from_arrays([own.column(f.name) for f in fields] + found, names=[f.name for f in fields] + [n for n, _ in new])

    return docs.mapInArrow(rows, StructType([*fields, *[StructField(n, t) for n, t in new]]))


def pair_counts(rows: DataFrame, aligner: Aligner) -> tuple[np.ndarray, np.ndarray]:
    """How often each numbered pair is linked in the corpus, and whether no other pair of its B token is more often.

    At most one row a pair reaches the driver, and the pairs are fixed by the vocabularies.
    """
    found = rows.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).toArrow()
    count = np.zeros(len(aligner.pairs), np.int64)
    count[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    token = aligner.pairs % len(aligner.b_bytes.entries)
    most = np.zeros(len(aligner.b_bytes.entries), np.int64)
    np.maximum.at(most, token, count)
    return count, (count == most[token]) & (count > 0)


def align(docs: DataFrame, a: bytes, b: bytes, text_col: str = "text") -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum (links by their corpus-wide counts)."""
    spark = docs.sparkSession
    rows = staged(aligned(docs, a, b, text_col), "alignment")
    sent = spark.sparkContext.broadcast(pair_counts(rows, _worker(a, b)))  # one number and flag a suffix pair
    names = ["n_links", "n_best", "count_sum"]
    rows = rows.select(*[c for c in rows.columns if c not in names])
    at = rows.columns.index("links")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = sent.value
        for batch in batches:
            lists = batch.column(at)
            links, cuts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            per_text = [np.diff(cuts)]
            for value in (best, count):
                total = np.concatenate([[0], np.cumsum(value[links], dtype=np.int64)])
                per_text.append(total[cuts[1:]] - total[cuts[:-1]])
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x.astype(np.int64)) for x in per_text]], names=[*batch.schema.names, *names])

    return rows.mapInArrow(sums, StructType([*rows.schema.fields, *[StructField(n, LongType()) for n in names]]))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    found = align(docs, load_model(BYTE_LEVEL_PATH), load_model(MODEL_PATH))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

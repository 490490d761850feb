"""Secret scan with structural confirmation.

The base kinds are patterns: ``assign`` (a named password, token or key with a
value), ``access`` (an access-key id) and ``hex`` (a long lowercase hex run).
The further kinds are reported only when their content decodes and parses:

* ``jwt``: three base64url parts; header and payload are JSON objects and the
  header names a signing algorithm;
* ``der``: base64 or hex whose bytes are a private key in DER: every nested
  length fills its parent exactly, and the fields are those of PKCS#1, PKCS#8
  (plain or encrypted under a password), SEC1 or a DSA key;
* ``ssh``: base64 of an OpenSSH private key whose length-prefixed fields fit;
* ``pem``: an armoured private key whose body decodes to one of these, or
  whose headers name a cipher and an IV of its size and whose body is whole
  blocks of that cipher.

Keys may be wrapped: base64 lines that follow each other, their ends real or
escaped as in a string literal, are read as one run up to the key's own length
(at most ``KEY_BYTES``; a longer one is no key). The time is linear in the text.

Spans are [start, end) in code points, sorted by start, then kind in the order
of KINDS. Base spans are never dropped. Null text counts as empty; repeated
rows get equal spans; other columns are ignored by ``scan`` and kept by
``redact``. Each row is scanned on its own: nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import python_stage
from riskloom.session import table_path

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "der", "ssh", "pem")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # of maximal runs, those of 16 or more
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{5,})\.(eyJ[A-Za-z0-9_-]{3,})\.([A-Za-z0-9_-]+)")
_LONG = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_LONG_HEX = re.compile(r"[0-9A-Fa-f]{40,}\Z")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[^-]|-(?!----))*+)-----END \1-----")
_SSH_MAGIC = b"openssh-key-v1\0"
_SSH_TEXT = "b3BlbnNzaC1rZXkt"
_ENDING = re.compile(r"\\+[rn]|\\*[\r\n]")  # of a line, real or escaped
_KEY_START = re.compile(rf"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[rn]))(?:M[A-P][A-Za-z0-9+/_-]{{14}}|{_SSH_TEXT})")
#: The object identifiers of password-based encryption (PKCS#5, PKCS#12), but for their last byte.
_PASSWORD_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
#: Bytes of a block (and of an IV) of the ciphers that armour headers name.
_BLOCK_BYTES = {"AES-": 16, "CAMELLIA-": 16, "ARIA-": 16, "SEED-": 16, "DES-": 8, "BF-": 8, "CAST5-": 8, "IDEA-": 8, "RC2-": 8, "RC5-": 8}
KEY_BYTES = 1 << 16  # an RSA key of 16,384 bits takes about 9,400
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_NEXT_LINE = re.compile(r"[ \t]*(?:(?:\\+[rn])+|\\*\r?\n)[ \t]*(?=[A-Za-z0-9+/_-])")


def _base64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of consecutive DER values that fill ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size = int.from_bytes(data[at : at + more], "big")
            at += more
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def _is_password_cipher(algorithm: bytes) -> bool:
    """An algorithm identifier of password-based encryption, its parameters a sequence."""
    parts = _fields(algorithm)
    return parts is not None and [t for t, _ in parts] == [0x06, 0x30] and parts[0][1][:-1] in _PASSWORD_OIDS


def is_der_key(data: bytes) -> bool:
    outer = _fields(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = _fields(outer[0][1])
    if not inner:
        return False
    tags, version = [t for t, _ in inner], inner[0][1]
    if tags == [0x30, 0x04]:
        return len(inner[1][1]) >= 16 and _is_password_cipher(version)  # PKCS#8, encrypted: algorithm, bytes
    if tags[0] != 0x02:
        return False
    if len(inner) >= 9 and set(tags[:9]) == {0x02} and version in (b"\0", b"\1"):
        return True  # PKCS#1: version, modulus, exponents, primes, coefficients
    if tags == [0x02] * 6:
        p, q, *rest = (len(x) for _, x in inner[1:])
        return version == b"\0" and p >= 64 and 20 <= q <= p and all(1 <= x <= p for x in rest)  # DSA: version, p, q, g, y, x
    if len(inner) >= 3 and tags[1:3] == [0x30, 0x04] and version in (b"\0", b"\1"):
        kind = _fields(inner[1][1])
        return bool(kind) and kind[0][0] == 0x06  # PKCS#8: version, algorithm, key
    # SEC1: version, the scalar of a field of 112 to 576 bits, curve and public key where given
    return tags[1:2] == [0x04] and version == b"\1" and 14 <= len(inner[1][1]) <= 72 and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1])


def is_ssh_key(data: bytes) -> bool:
    if not data.startswith(_SSH_MAGIC):
        return False
    at, fields = len(_SSH_MAGIC), []
    for take in ("cipher", "kdf", "options", "count", "public", "private"):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if take == "count":
            if size != 1:
                return False
            continue
        if at + size > len(data):
            return False
        fields.append(data[at : at + size])
        at += size
    return at == len(data) and bool(fields[0]) and bool(fields[-1])


def _der_size(data: bytes) -> int | None:
    """Bytes of the private key whose first bytes these are."""
    more = data[1] & 0x7F if data[1] >= 0x80 else 0
    if data[0] != 0x30 or more > 4 or data[1] == 0x80:
        return None
    first = data[2 + more : 5 + more]  # a version, or the algorithm of an encrypted key
    if first[:2] != b"\x02\x01" and not (first[0] == 0x30 and first[2] == 0x06):
        return None
    return 2 + more + (int.from_bytes(data[2 : 2 + more], "big") if more else data[1])


def _ssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that ``data`` begins with."""
    at = len(_SSH_MAGIC)
    for take in ("cipher", "kdf", "options", "count", "public", "private"):
        if at + 4 > len(data):
            return None
        at += 4 + (0 if take == "count" else int.from_bytes(data[at : at + 4], "big"))
    return at if at <= len(data) else None


class _Lines:
    """Runs of base64 on consecutive lines, each run of lines read once for all keys that may begin in it."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans: list[tuple[int, int]] = []
        self.chars = [0]  # characters before each run
        self.heads: list[int] = []  # runs an OpenSSH key can begin at
        self.places: dict[int, int] = {}  # start of a run -> its number
        self.last = 0  # number after the last run of the lines read

    def place(self, start: int) -> int:
        """The number of the run that starts there."""
        if start not in self.places:
            at: int | None = start
            while at is not None:
                end = _RUN.match(self.text, at).end()
                self.places[at] = len(self.spans)
                if self.text.startswith(_SSH_TEXT, at):
                    self.heads.append(len(self.spans))
                self.spans.append((at, end))
                self.chars.append(self.chars[-1] + end - at)
                more = _NEXT_LINE.match(self.text, end)
                at = more.end() if more else None
            self.last = len(self.spans)
        return self.places[start]

    def joined(self, first: int, last: int) -> str:
        return "".join([self.text[a:b] for a, b in self.spans[first:last]])


def _wrapped_keys(text: str) -> list[tuple[str, int, int]]:
    """Spans of base64 keys over one or more lines that end where a line ends."""
    out, at, lines = [], 0, _Lines(text)
    while begin := _KEY_START.search(text, at):
        is_ssh = begin[0] == _SSH_TEXT
        size = None if is_ssh else _der_size(_base64(begin[0]))
        if not is_ssh and (size is None or size > KEY_BYTES):
            at = _RUN.match(text, begin.start()).end()
            continue
        first = lines.place(begin.start())
        at = lines.spans[first][1]
        if is_ssh:
            other = bisect_left(lines.heads, first + 1)  # the next key, or the lines' end
            joined = lines.joined(first, lines.heads[other] if other < len(lines.heads) else lines.last)
            raw = _base64(joined[: len(joined) - (len(joined) % 4 == 1)])
            size = _ssh_size(raw) if raw is not None else None
            if size is None:
                continue
        need = lines.chars[first] + -(-4 * size // 3)
        last = bisect_left(lines.chars, need)
        if last >= len(lines.chars) or lines.chars[last] != need:
            continue
        raw = _base64(lines.joined(first, last))
        if raw and (is_ssh_key(raw) if is_ssh else is_der_key(raw)):
            at = lines.spans[last - 1][1]
            at += text.startswith("=", at) + text.startswith("==", at)
            out.append(("ssh" if is_ssh else "der", begin.start(), at))
    return out


def is_signed_token(header: str, payload: str) -> bool:
    parts = []
    for part in (header, payload):
        raw = _base64(part)
        try:
            parts.append(json.loads(raw.decode("utf-8")) if raw is not None else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str) and parts[0]["alg"].lower() != "none"


def _is_encrypted(heads: list[str], size: int) -> bool:
    """Armour headers that name a cipher and an IV, above whole blocks of that cipher."""
    named = dict(x.split(":", 1) for x in heads)
    cipher, _, iv = named.get("DEK-Info", "").partition(",")
    block = next((n for start, n in _BLOCK_BYTES.items() if cipher.startswith(start)), None)
    return named.get("Proc-Type") == "4,ENCRYPTED" and block is not None and bool(re.fullmatch(rf"[0-9A-Fa-f]{{{2 * block}}}", iv)) and size % block == 0


def _is_pem(label: str, body: str) -> bool:
    lines = ["".join(x.split()) for x in _ENDING.split(body.replace("\\/", "/"))]
    heads = [x for x in lines if ":" in x]
    raw = _base64("".join(x for x in lines if ":" not in x))
    if not raw:
        return False
    return is_der_key(raw) or is_ssh_key(raw) or _is_encrypted(heads, len(raw))


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of one text."""
    if not text:
        return []
    spans = [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    low = text.lower()
    if any(x in low for x in _NAMES):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if "eyJ" in text:
        spans += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if is_signed_token(m[1], m[2])]
    for m in _LONG.finditer(text):
        run = m[0]
        for raw in (bytes.fromhex(run) if len(run) % 2 == 0 and _LONG_HEX.match(run) else None, _base64(run) if run[0] in "Mb" else None):
            if raw and is_der_key(raw):
                spans.append(("der", m.start(), m.end()))
            elif raw and is_ssh_key(raw):
                spans.append(("ssh", m.start(), m.end()))
    spans += [s for s in _wrapped_keys(text) if s not in spans]
    if "PRIVATE KEY-----" in text:
        spans += [("pem", m.start(), m.end()) for m in _PEM.finditer(text) if _is_pem(m[1], m[2])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans: array of (kind, start, end)."""
    python_stage(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["doc_id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(rows, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def mask_spans(text: str | None, fill: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping spans replaced by ``fill``."""
    out, at = [], 0
    for _, start, end in find(text):
        if start >= at:
            out += [text[at:start], fill]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in its text replaced; all columns and rows stay."""
    python_stage(docs.sparkSession)
    at = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(at, batch.schema.names[at], pa.array([mask_spans(t) for t in batch.column(at).to_pylist()], pa.string()))

    return docs.mapInArrow(rows, docs.schema)


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )

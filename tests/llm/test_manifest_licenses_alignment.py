"""Merkle manifests, license rules and token alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import re._parser as regex_parser
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import alignment, licenses, manifest
from riskloom.llm.tokens import MODEL_PATH, load_model

from .conftest import SF, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(hashes, fanout):
    """The root, and for each leaf its (left, right) siblings level by level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for leaf, i in enumerate(at):
            run, k = runs[i // fanout], i % fanout
            paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            at[leaf] = i // fanout
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def brute_manifest(rows, fanout):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for r in rows:
        leaf = sha("".join(field(r[c]) for c in manifest.FIELDS))
        trees.setdefault("" if r.lang is None else "=" + r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf))
    names = sorted(trees, key=str.encode)
    built = {x: brute_tree([leaf for _, _, leaf in sorted(trees[x])], fanout) for x in names}
    root, tops = brute_tree([built[x][0] for x in names], fanout)
    out = []
    for x, top in zip(names, tops, strict=True):
        subroot, paths = built[x]
        for (some, doc_id, leaf), path in zip(sorted(trees[x]), paths, strict=True):
            proof = sha("".join(a + b for a, b in path + top))
            out.append((doc_id if some else None, leaf, subroot, root, proof, root))
    return out


def manifest_rows(docs, **kw):
    path = F.col("path")
    found = manifest.manifest(docs, **kw).select("doc_id", "leaf", "subroot", "root", manifest.siblings_hash(path), manifest.fold(F.col("leaf"), path))
    return [tuple(r) for r in found.collect()]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (3, 1), (8, 4)])
def test_manifest_is_the_tree(spark, odd_docs, fanout, levels):
    got = manifest_rows(odd_docs, fanout=fanout, levels=levels)
    assert sorted(got, key=repr) == sorted(brute_manifest(odd_docs.collect(), fanout), key=repr)


@pytest.mark.parametrize("n", [1, 2, 5, 9, 27, 28])
def test_manifest_of_every_shape(spark, n):
    rows = [(i % 7, "s", "en" if i % 9 else None, i, f"text {i % 7}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert Counter(manifest_rows(docs, fanout=2, levels=1)) == Counter(brute_manifest(docs.collect(), 2))


def test_manifest_of_nothing_and_of_changed_rows(spark, odd_docs, no_docs):
    assert manifest_rows(no_docs) == []
    seen = manifest.manifest(odd_docs, changed={"text": F.upper("text")}, only=F.col("doc_id") < 6)
    for r in seen.collect():
        changed = r.doc_id in (4, 5)  # null, empty and blank texts stay what they are
        assert (r.seen is None) == (r.doc_id is None or r.doc_id >= 6) and (r.seen not in (None, r.leaf)) == changed


def sample_match(rng, parsed):
    """A random text that a pattern matches."""
    out = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "NOT_LITERAL":
            out.append("w")
        elif name == "SUBPATTERN":
            out.append(sample_match(rng, arg[3]))
        elif name == "BRANCH":
            out.append(sample_match(rng, rng.choice(arg[1])))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += [sample_match(rng, arg[2]) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 3)))]
        elif name == "IN":
            choice = arg[0]
            out.append(chr(choice[1]) if str(choice[0]) == "LITERAL" else str(rng.randint(0, 9)))
        else:
            raise AssertionError(name)
    return "".join(out)


def scan_one(scanner, text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return scanner.scan(data, np.array([0, len(data)]))[1].get(0, [])


def naive_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_every_match_passes_the_keyword_prefilter():
    rng, scanner = random.Random(3), licenses.Scanner()
    assert len(scanner.rules) > 400
    for i, rule in enumerate(scanner.rules):
        parsed = regex_parser.parse(rule.pattern)
        for _ in range(6):
            text = "alpha " + sample_match(rng, parsed) + " omega"
            assert any(m.rule == i for m in scan_one(scanner, text.replace(" ", rng.choice([" ", "\n// ", "-", ", "])))), (rule, text)


def test_suppression_is_containment():
    rng = random.Random(6)
    for _ in range(2000):
        priority = [rng.randint(0, 3) for _ in range(6)]
        found = []
        for r in range(6):
            first = rng.randint(0, 8)
            found.append((first, first + rng.randint(1, 6), r))
        inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1]

        def beats(b, a, priority=priority):
            higher, same = priority[b[2]] > priority[a[2]], priority[b[2]] == priority[a[2]]
            return inside(a, b) and (higher or same and ((b[0], b[1]) != (a[0], a[1]) or b[2] < a[2]))

        want = [not any(beats(b, a) for b in found if b != a) for a in found]
        assert licenses.suppress(found, priority) == want, (found, priority)


def check_licenses(rows, scanner):
    phrases = [(p.split(), label) for p, label in licenses.BASE]
    for r in rows:
        words = naive_words(r.text)
        joined = " ".join(words).encode()
        places = [(i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p)] == p]
        assert r.n_words == len(words)
        assert sorted((h["first"], h["label"]) for h in r.hits if h["base"]) == sorted(places)
        every = scanner.matches(joined, list(range(len(scanner.rules)))) if words else []  # no prefilter
        assert [(h["rule"], h["first"], h["last"], h["kept"]) for h in r.hits] == [(m.rule, m.first, m.last, m.kept) for m in every]


def test_licenses_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = licenses.detect(docs, keep_text=True).collect()
    assert len(rows) == docs.count()
    check_licenses(rows, licenses.Scanner())
    query = {r.doc_id: r for r in licenses.op12_license_scan(spark, SF).collect()}
    for r in rows:
        base, own = [h for h in r.hits if h["base"]], query[r.doc_id]
        starts = [h["first"] for h in base]
        assert (own.n_base, own.first_word, own.last_word) == (len(base), min(starts, default=None), max(starts, default=None))
        assert own.base_labels == ",".join(sorted({h["label"] for h in base}))
        assert own.labels == ",".join(sorted({h["label"] for h in r.hits if h["kept"] or h["base"]}))
        assert own.score == max((h["confidence"] for h in r.hits if h["kept"]), default=0.0)


def test_licenses_odd_rows(spark, odd_docs, no_docs):
    texts = ["CC-BY", "ccby", "cc by", "All rights\n * reserved.", "Éall rights reserved", "GNU General Public License", "x" * 300_000 + " cc by", None, "all rights reserved all rights reserved"]
    clash = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, hits string, n_words int")
    scanner = licenses.Scanner()
    rows = licenses.detect(clash, keep_text=True).orderBy("doc_id").collect()
    check_licenses(rows, scanner)
    assert [sum(h["base"] for h in r.hits) for r in rows] == [1, 0, 1, 1, 0, 1, 1, 0, 2]
    odd = licenses.detect(odd_docs, keep_text=True).collect()
    assert len(odd) == odd_docs.count()
    check_licenses(odd, scanner)
    assert licenses.detect(no_docs).count() == 0


def brute_alignment(rows):
    """Every text whole; ends of tokens by adding up their bytes."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.BYTE_LEVEL_PATH)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=MODEL_PATH)
    alphabet = alignment.byte_alphabet()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    found, links = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        own_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        own_b = [b_bytes(i) for i in ids_b]
        if not text or b"".join(own_a) != raw or b"".join(own_b) != raw:
            found.append((doc_id, 0, 0, [], ""))
            continue
        groups, i, j, end_a, end_b = [([], [])], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if end_a <= end_b:
                groups[-1][0].append(ids_a[i])
                end_a, i = end_a + len(own_a[i]), i + 1
            else:
                groups[-1][1].append(ids_b[j])
                end_b, j = end_b + len(own_b[j]), j + 1
            if end_a == end_b:
                groups.append(([], []))
        groups.pop()
        pairs = [(x[-1], y[-1]) for x, y in groups]
        links.update(pairs)
        found.append((doc_id, len(ids_a), len(ids_b), pairs, sha(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups))))
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return [(d, n, m, len(p), len(p), sum(links[q] == most[q[1]] for q in p), sum(links[q] for q in p), h) for d, n, m, p, h in found]


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_documents(spark):
    got = [tuple(r) for r in alignment.op13_token_alignment(spark, SF).select(*ALIGNED).collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(got) == Counter(brute_alignment(docs))


def test_alignment_of_odd_texts(spark, odd_docs, no_docs):
    a, b = load_model(alignment.BYTE_LEVEL_PATH), load_model(MODEL_PATH)
    rng = random.Random(12)
    bits = [" ", "  ", "\n", "\t", "a", "The", "日本", "\U0001f600", "\U0001f469‍\U0001f4bb", "é", "é", " ", "'s", "123", "<s>", "<|endoftext|>", "<0x0A>", "▁", "\u0000", "�", "ﬁ", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(100 + i, t) for i, t in enumerate(texts)] + [(100, texts[0]), (None, prose(rng, 30))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, links string, n_best int").repartition(4)
    got = [tuple(r) for r in alignment.align(docs, a, b).select(*ALIGNED).collect()]
    assert Counter(got) == Counter(brute_alignment(rows))
    assert alignment.align(no_docs, a, b).count() == 0

"""The pipeline against a plain version of each of its stages."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from test_llm import SMALL, plain_components, plain_fingerprint, plain_prototypes, plain_vector, poured

import corpus_pipeline
from graphloom.llm import langid, packing, secrets


def plain_languages(rows):
    """Cosines with the prototypes, one text at a time."""
    known, kept = {}, []
    _, prototypes = plain_prototypes([(r["doc_id"], r["text"], r["lang"]) for r in rows], known)
    for r in rows:
        v = plain_vector(r["text"] or "", known)
        n = langid.trigrams(r["text"] or "")[1].sum()
        if np.any(v) and max(float(v @ p) for p in prototypes) >= 0.18 * min(1, n / 100) * np.linalg.norm(v):
            kept.append(r)
    return kept


def plain_near_copies(rows):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    roots = plain_components([plain_fingerprint(r["text"] or "") for r in rows])
    return [rows[k] for k in sorted(set(roots))]


def plain_redaction(rows):
    out = []
    for r in rows:
        text = r["text"] or ""
        marks = [None] * len(text)
        spans = secrets.all_spans(text)[1]
        for a, b, kind in reversed(spans):
            for k in range(a, b):
                marks[k] = (a, kind)
        # A span that begins inside an earlier one is part of what that one hides.
        new, end = "", 0
        for a, b, kind in spans:
            if a >= end:
                new += text[end:a] + f"[{kind}]"
            end = max(end, b)
        new += text[end:]
        assert all(m is None for k, m in enumerate(marks) if not any(a <= k < b for a, b, _ in spans))
        out.append({**r, "text": new})
    return out


def plain_mix(rows):
    """{doc_id: [texts taken]}."""
    sizes, by_source = Counter(), defaultdict(list)
    for r in rows:
        n = len(r["text"].encode().split())
        u = (int(hashlib.sha256(f"7:{r['doc_id']}".encode()).hexdigest()[:12], 16) + 0.5) / 2.0**48
        mean = len(r["text"]) / max(n, 1) / 6.0
        by_source[r["source"]].append((-math.log(u) / max(0.05, 1 / mean if mean > 1 else mean), r["doc_id"], n, r["text"]))
        sizes[r["source"]] += n
    targets, out = poured(sizes), {}
    for source, docs in by_source.items():
        whole = min(3, int(targets[source] // sizes[source])) if sizes[source] else 0
        budget = round(targets[source]) - whole * sizes[source]
        for _, doc_id, n, text in sorted(docs):
            part = min(n, max(0, budget))
            budget -= part
            copies = [text] * whole + ([text] if part == n else [" ".join(text.encode().split()[k].decode() for k in range(part))] if part else [])
            if copies and n:
                out[doc_id] = copies
    return out


def test_pipeline(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = plain_mix(plain_redaction(plain_near_copies(plain_languages(rows))))
    pieces = Counter()
    for doc_id, texts in want.items():
        for text in texts:
            ids = np.append(packing.encode(text), np.uint32(0)).astype("<u4")
            start = 0
            for n in packing.cut(len(ids)):
                pieces[doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids)] += 1
                start += n
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == pieces
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_take_what_they_are_for(spark):
    """Documents with planted gibberish, copies, repeated rows and keys: each stage drops or changes just those."""
    rng = random.Random(31)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = docs.where("length(text) > 800").orderBy("doc_id").limit(40).collect()
    noise = [(10**9 + k, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(600)), None, "src1", 600) for k in range(10)]
    copies = [(2 * 10**9 + k, r.text, r.lang, r.source, r.n_chars) for k, r in enumerate(clean[:20])]
    key = "qZxW9vJkPf2GhTrB7nMcXqLdKs4YwE"
    keys = [(3 * 10**9 + k, r.text[::-1][:300] + f" use {key} now " + r.text, r.lang, r.source, 1) for k, r in enumerate(clean[20:30])]
    given = docs.union(spark.createDataFrame(noise + copies + keys, docs.schema)).union(spark.createDataFrame(clean[:5], docs.schema))
    stage = dict(corpus_pipeline.STAGES)
    one = stage["language"](spark, given, SMALL)
    gone = {r.doc_id for r in given.join(one, "doc_id", "left_anti").collect()}
    assert {k for k, *_ in noise} <= gone and len(gone) - len(noise) <= 2
    two = stage["near_copies"](spark, one, SMALL).collect()
    ids = [r.doc_id for r in two]
    assert len(ids) == len(set(ids)) and not {k for k, *_ in copies} & set(ids) and {k for k, *_ in keys} <= set(ids)
    three = {r.doc_id: r.text for r in stage["secrets"](spark, one, SMALL).collect()}
    assert all(key not in three[k] and "[random]" in three[k] for k, *_ in keys)
    assert sum(r.text == three[r.doc_id] for r in clean) >= 30


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "secrets", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

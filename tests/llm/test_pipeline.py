"""The pipeline on a small table against a plain version of every stage."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from test_operators import _components

from strandloom.llm import mixing, records, tokens
from strandloom.llm.common import written

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def good(text):
    ws = WORDS.findall(text or "")
    n, chars = len(ws), sum(map(len, ws))
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {j for i, g in enumerate(zip(ws, ws[1:], ws[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    count = lambda s: sum(text.count(c) for c in s)
    if n < 50 or 2 * len(covered) > n:
        return False
    bad = 10 * count("#*$%&|<>") > n or 10 * count("!") > 3 * n or 10 * count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") > 4 * chars or 10 * count("0123456789") > 4 * chars
    return not (bad or chars < 2 * n or chars > 15 * n or 2 * (len(lines) - len(set(lines))) > len(lines))


def test_stages(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "stage")
        seen.append(docs.toPandas())
    rows = [r for r in rows if good(r[1])]
    assert sorted(seen[0].doc_id) == sorted(r[0] for r in rows)
    comp = _components([(r[0], r[1]) for r in rows], 5, 80)
    rows = [r for r in rows if comp[r[0]][1] == r[0]]
    assert sorted(seen[1].doc_id) == sorted(r[0] for r in rows)
    squeeze = lambda t: " ".join(t.lower().split())
    rows = [r for r in rows if not any(squeeze(i) in squeeze(r[1]) for i in items)]
    assert sorted(seen[2].doc_id) == sorted(r[0] for r in rows)
    assert list(seen[3].columns) == ["doc_id", "text", "lang", "source", "n_chars"]
    size = {r[0]: len(WORDS.findall(r[1])) for r in rows}
    copies = Counter(seen[3].doc_id)
    assert set(copies) <= set(size) and max(copies.values()) <= mixing.REPEATS
    total = sum(size.values())
    assert abs(sum(size[i] * n for i, n in copies.items()) - total * mixing.PERCENT / 100) <= max(size.values())
    tok, start, want = tokens.load(records.WORD_BPE), 0, []
    text = {r[0]: r[1] for r in rows}
    for i in sorted(copies):
        ids = tok.encode(text[i], add_special_tokens=False).ids + [2]
        for _ in range(copies[i]):
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert sorted(map(tuple, seen[4][["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False))) == want

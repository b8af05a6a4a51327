"""Secret scans: fixed patterns, and a character CNN over every candidate and its surroundings.

The patterns' spans are always reported, with the network's score of their value. Besides, every long run
of key-like characters is a candidate: the network scores all of it, and its long parts, with the text
around them, and what passes the calibrated, recall-constrained threshold of its class and touches no
pattern span is added as kind ``model``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import char_cnn
from .common import free_name, table

#: The three base patterns. Upper and lower case are spelled out, so that only ASCII matches.
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_either = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
ASSIGN = re.compile(rf"""({"|".join(map(_either, _KEYWORDS))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
KINDS = ("assign", "access", "hex", "model")

_LONG_HEX = re.compile(rf"[0-9a-f]{{{HEX_MIN},}}")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns: leftmost, non-overlapping within a kind."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_MIN]
    if _has_run(text):
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
        found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]  # whole runs: same as filtering HEX
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _has_run(text: str) -> bool:
    return any(len(w) >= char_cnn.CANDIDATE_MIN for w in text.split())


def candidates(text: str) -> list[tuple[int, int]]:
    """Key-like runs: every long one; the network judges them all."""
    return [m.span() for m in char_cnn.CANDIDATE.finditer(text)] if _has_run(text) else []


def _value(text: str, a: int, b: int, kind: str) -> int:
    """Where the value of a base span starts."""
    return ASSIGN.match(text, a).start(2) if kind == "assign" else a


def scan(texts: list[str], model: dict) -> list[list[tuple[int, int, str, float]]]:
    """All spans (start, end, kind, score) of each text, in order. A candidate's best part is the span."""
    out, jobs, rows = [], [], []

    def add(i, kind, group, text, left, stop):
        """Queue the windows of a piece; pieces of one group compete."""
        windows = [char_cnn.codes(text, left, x, y, stop) for x, y in char_cnn.steps(left, stop)]
        jobs.append((i, kind, group, left, stop, len(rows), len(rows) + len(windows)))
        rows.extend(windows)

    for i, text in enumerate(texts):
        base = base_spans(text)
        out.append([])
        for a, b, kind in base:
            add(i, kind, (a, b), text, _value(text, a, b, kind), b)
        for a, b in candidates(text):
            if all(b <= s or a >= e for s, e, _ in base):
                for left, stop in char_cnn.pieces(text, a, b):
                    add(i, "model", (a, b), text, left, stop)
    p = char_cnn.score(model, np.array(rows, np.int16)) if rows else np.zeros(0)
    best: dict[tuple, tuple] = {}
    for i, kind, (a, b), left, stop, x, y in jobs:
        top = float(p[x:y].max())
        if kind != "model":
            out[i].append((a, b, kind, top))
        else:
            best[i, a, b] = max(best.get((i, a, b), (-1.0, 0, 0)), (top, left, stop))
    for (i, a, b), (top, left, stop) in best.items():
        if top >= model["thresholds"][char_cnn.candidate_class(texts[i][a:b])]:
            out[i].append((left, stop, "model", top))
    return [sorted(x, key=lambda s: (s[0], KINDS.index(s[2]))) for x in out]


def find_secrets(df: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """``df`` with ``secrets``: an array of (kind, start, end, score), code points, end exclusive, in text order.

    The model is fitted on the driver on a fixed number of generated findings unless one is given. Null
    and empty texts have no spans. Every row is kept; a column of ``df`` named secrets gets an underscore
    in front.
    """
    if clash := [c for c in df.columns if c.lower() == "secrets"]:
        df = df.withColumnRenamed(clash[0], free_name(df, "secrets"))
    shared = df.sparkSession.sparkContext.broadcast(model or char_cnn.fit())

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def spans(texts: pd.Series) -> pd.Series:
        found = scan(texts.fillna("").tolist(), shared.value)
        return pd.Series([[{"kind": k, "start": a, "end": b, "score": p} for a, b, k, p in x] for x in found], index=texts.index, dtype=object)

    return df.withColumn("secrets", spans(F.coalesce(F.col(text), F.lit(""))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kinds: F.filter("secrets", lambda s: s["kind"].isin(list(kinds)))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return docs.select("doc_id", *counts, F.sha2(joined(of(KINDS[:3])), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"), F.size(of(["model"])).cast("long").alias("n_model"))

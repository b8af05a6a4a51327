"""Token counts with a whole-token shortcut, and the tokenizer helpers that other operators use.

The shortcut is proved before any text is read: each vocabulary string is encoded alone, and those that
come back as a single token form a table. A text is cut into pre-tokens; pre-tokens of the table count as
one without merging, only the rest goes through the library's merges (and is remembered in a table per
worker that is bounded in entries and in their length). Stretches with characters on which Unicode tables
of two libraries might differ, or with the text of a special token, are encoded by the library; a stretch
reaches to the next single space between two sure characters, where a pre-token surely starts.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table

BYTE_BPE = "byte_bpe_50k.json"
#: Pre-tokens that a worker remembers besides the proved ones.
MEMO = 400_000
#: Longer pre-tokens are merged each time they are met.
MEMO_CHARS = 64
#: Characters outside this set, and "<|", send their stretch to the library.
_UNSURE = regex.compile(r"[^\t-\r\x20-įı-ſ‐-‧‰-⁞]|<\|")
#: Spaces before which every pre-token ends.
_CUT = regex.compile(r"(?<=[!-~À-įı-ſ]) (?=[!-~À-įı-ſ])")
#: Fixed value: the pre-token pattern of byte_bpe_50k.json's library type.
_BYTE_PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


@lru_cache(maxsize=4)
def load(name: str):
    """The tokenizer of a file of the installed tokenizer collection, or of a path; one per worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))


def _byte_letters() -> dict[int, str]:
    """Byte-level letters by rule: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def merge(tok, piece: str) -> list:
    """The model's merges of one pre-token, which is first spelled in byte-level letters."""
    return tok.model.tokenize(piece.encode().decode("latin-1").translate(_LETTERS))


def whole_tokens(name: str = BYTE_BPE) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and encode, alone, as exactly one token."""
    tok = load(name)
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    texts = [tok.decode([i]) for i in range(tok.get_vocab_size())]
    texts = [t for t in texts if t and "�" not in t and t not in special and not _UNSURE.search(t)]
    texts = [t for t in texts if (m := _BYTE_PIECES.match(t)) and m.end() == len(t)]
    encoded = tok.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, encoded) if len(e.ids) == 1)


class _Counts(dict):
    """Tokens of a pre-token. Proved ones are there from the start; others are merged when first met."""

    def __init__(self, tok, whole):
        super().__init__(dict.fromkeys(whole, 1))
        self.tok, self.whole = tok, whole

    def __missing__(self, piece: str) -> int:
        n = len(merge(self.tok, piece))
        if len(piece) > MEMO_CHARS:
            return n
        if len(self) > len(self.whole) + MEMO:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        self[piece] = n
        return n


@lru_cache(maxsize=2)
def _counts(name: str, whole: frozenset) -> _Counts:
    return _Counts(load(name), whole)


def stretches(text: str) -> list[tuple[str, bool]]:
    """The text in parts that can be tokenized apart, and whether a part has unsure characters."""
    unsure = [m.start() for m in _UNSURE.finditer(text)]
    if not unsure:
        return [(text, False)]
    cuts = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    out, last, k = [], 0, 0
    while k < len(unsure):
        at = bisect_right(cuts, unsure[k]) - 1
        start, end = cuts[at], cuts[at + 1] if at + 1 < len(cuts) else len(text)
        while k < len(unsure) and unsure[k] < end:
            k += 1
        if start > last:
            out.append((text[last:start], False))
        out.append((text[start:end], True))
        last = end
    if last < len(text):
        out.append((text[last:], False))
    return out


def count_text(text: str, name: str, counts: _Counts) -> int:
    total = 0
    for part, unsure in stretches(text):
        if unsure:
            total += len(load(name).encode(part, add_special_tokens=False).ids)
        else:
            total += sum(map(counts.__getitem__, _BYTE_PIECES.findall(part)))
    return total


def token_counter(spark: SparkSession, name: str = BYTE_BPE):
    """Column function: number of tokens of a text. The proved table is broadcast (at most the vocabulary)."""
    whole = spark.sparkContext.broadcast(whole_tokens(name))

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        counts = _counts(name, whole.value)
        return texts.fillna("").map(lambda t: count_text(t, name, counts)).astype("int64")

    return tokens


def count_tokens(df: DataFrame, text: str = "text", limit: int = 512, tokenizer: str = BYTE_BPE) -> DataFrame:
    """``df`` with n_bytes (UTF-8), n_tokens (long) and over_limit of each whole text.

    Null counts as the empty text: 0 bytes, 0 tokens. Special-token text inside a document is handled as
    the tokenizers library does by default; nothing is added, cut or padded. Every row is kept. Columns
    of ``df`` with a result column's name are kept with an underscore in front.
    """
    for name in ("n_bytes", "n_tokens", "over_limit"):
        if clash := [c for c in df.columns if c.lower() == name]:
            df = df.withColumnRenamed(clash[0], free_name(df, name))
    tokens = token_counter(df.sparkSession, tokenizer)
    t = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumns({"n_bytes": F.octet_length(t).cast("long"), "n_tokens": tokens(t)})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")

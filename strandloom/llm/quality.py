"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a Boolean column over per-text figures, the base rules included. On a bounded sample the
operator estimates each rule's cost (time of a pass over the sample beyond that of a pass without a rule)
and selectivity (share of texts it rejects) and nests the rules by rejection per cost. Where only the
verdict is wanted (``keep_good``) the figures stay expressions of the nested conditions, so a text that a
cheap rule rejects never pays for the dear ones. The order changes the work only, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, UPPER, free_name, let, table, word_chars, words

#: Texts that the order of the rules is estimated on, and their longest length (bounds, not shares of the table).
SAMPLE_ROWS, SAMPLE_CHARS = 400, 20_000
SYMBOLS = "#*$%&|<>"


def symbol_count(text: Column, symbols: str = SYMBOLS) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, symbols, ""))).cast("long")


def lines_with_words(text: Column) -> Column:
    blank = SPACES.replace("\n", "")
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.translate(x, blank, "")) > 0)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    return let(lines_with_words(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(ws: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that the text has twice or more, the first one included.

    Windows are compared by 64-bit hashes. Linear but for one sort of the hashes of texts that repeat
    anything.
    """
    hashes = let(
        ws,
        lambda w: F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, width))),
        ),
    )
    pair = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def starts(p):
        twin = lambda e, j: F.coalesce(F.get(p, j)["h"] == e["h"], F.lit(False))
        flags = F.transform(p, lambda e, i: F.when(twin(e, i - 1) | twin(e, i + 1), e["i"]))
        return F.sort_array(F.filter(flags, lambda x: x.isNotNull()))

    def covered(d):
        steps = F.transform(d, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(d, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(let(pair(h), starts), covered)
        ),
    )


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``reject`` of its figures is true."""

    name: str
    reject: Callable[[dict[str, Column]], Column]


def base_rules(min_words: int = 50, max_repeat_percent: int = 50) -> list[Rule]:
    return [
        Rule("few words", lambda f: f["n_words"] < min_words),
        Rule("repeats", lambda f: 100 * f["n_repeat_words"] > max_repeat_percent * f["n_words"]),
    ]


def rules() -> list[Rule]:
    """The method's rules."""
    count = lambda f, chars: symbol_count(f["text"], chars)
    return [
        Rule("symbols", lambda f: 10 * f["n_symbols"] > f["n_words"]),
        Rule("exclamations", lambda f: 10 * count(f, "!") > 3 * f["n_words"]),
        Rule("capitals", lambda f: 10 * count(f, UPPER) > 4 * f["word_chars"]),
        Rule("digits", lambda f: 10 * count(f, "0123456789") > 4 * f["word_chars"]),
        Rule("short words", lambda f: f["word_chars"] < 2 * f["n_words"]),
        Rule("long words", lambda f: f["word_chars"] > 15 * f["n_words"]),
        Rule("duplicate lines", lambda f: 2 * f["n_dup_lines"] > F.size(lines_with_words(f["text"]))),
    ]


def text_figures(text: Column, ws: Column) -> dict[str, Column]:
    """The figures of a text, each an expression of its own, given its words."""
    return {
        "text": text, "n_words": F.size(ws).cast("long"), "word_chars": word_chars(text), "n_symbols": symbol_count(text),
        "n_dup_lines": duplicate_lines(text), "n_repeat_words": repeated_words(ws),
    }


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def figures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) of each text.

    The figures are one generated row per text: later filters on them cannot pull their expressions in
    and compute them again for every rule.
    """
    f = free_name(df, "_figures")
    t = F.col(text)

    def all_of(w):
        found = text_figures(t, w)
        return F.struct(*(found[c].alias(c) for c in FIGURES))

    return df.select("*", F.explode(F.array(let(words(t), all_of))).alias(f)).select("*", f"{f}.*").drop(f)


def order_rules(df: DataFrame, text: str, rule_list: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost on a bounded sample of the texts of ``df``.

    The sample is taken by a hash of the text from as few partitions as hold enough, so the table is not
    read for it; texts of more than ``SAMPLE_CHARS`` characters are not in it. Ties and empty tables keep
    the given order.
    """
    t = F.col(text)
    taken = df.filter((F.length(t) <= SAMPLE_CHARS) & (F.pmod(F.xxhash64(t), F.lit(8)) == 0)).select(t.alias("text")).take(sample_rows)
    sample = df.sparkSession.createDataFrame([(r["text"],) for r in taken], "text string").cache()
    hit = lambda test: let(words(F.col("text")), lambda w: test(text_figures(F.col("text"), w)))
    shares = sample.select(*(F.avg(F.coalesce(hit(r.reject), F.lit(False)).cast("double")).alias(str(i)) for i, r in enumerate(rule_list))).first()

    def seconds(test) -> float:
        began = time.perf_counter()
        sample.agg(F.count(F.when(hit(test), 1))).first()
        return time.perf_counter() - began

    bare = seconds(lambda f: f["n_words"] < 0)
    gain = [(shares[i] or 0.0) / max(seconds(r.reject) - bare, bare / 100) for i, r in enumerate(rule_list)]
    sample.unpersist()
    return [rule_list[i] for i in sorted(range(len(rule_list)), key=lambda i: -gain[i])]


def cascade(rule_list: list[Rule], figures: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, in the given order; null if none does. Later rules don't run."""
    out = None
    for r in rule_list:
        out = F.when(r.reject(figures), r.name) if out is None else out.when(r.reject(figures), r.name)
    return F.lit(None).cast("string") if out is None else out


def judge_quality(df: DataFrame, text: str = "text", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """``df`` with the figures, ``base_failed`` and ``kept`` of each text.

    A text fails the base with fewer than ``min_words`` words or with more than ``max_repeat_percent``
    of its words in repeated windows; it is kept if neither the base nor a rule of the cascade rejects
    it. Null counts as the empty text, which fails the base. Repeated rows are judged one by one.
    Columns of ``df`` that have the name of a result column are kept with an underscore in front.
    """
    for name in (*FIGURES, "base_failed", "kept"):
        if clash := [c for c in df.columns if c.lower() == name and c != text]:
            df = df.withColumnRenamed(clash[0], free_name(df, name))
    ordered = order_rules(df, text, rules())
    out = figures(df, text)
    found = {"text": F.col(text), **{c: F.col(c) for c in FIGURES}}
    failed = F.lit(False)
    for r in base_rules(min_words, max_repeat_percent):
        failed = failed | r.reject(found)
    out = out.withColumn("base_failed", failed)
    # Which rule of the cascade rejects first depends on measured costs, so only the verdict is a result.
    return out.withColumn("kept", F.when(F.col("base_failed"), "base").otherwise(cascade(ordered, found)).isNull())


def keep_good(docs: DataFrame, text: str = "text", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps; columns stay as they are.

    Base rules and others are one cascade of expressions here: none is evaluated after one has rejected.
    Null and empty texts are rejected (too few words), repeated rows are judged one by one, and an empty
    table stays empty.
    """
    ordered = order_rules(docs, text, base_rules(min_words, max_repeat_percent) + rules())
    return docs.filter(let(words(F.col(text)), lambda w: cascade(ordered, text_figures(F.col(text), w)).isNull()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge_quality(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_REJECTS = " OR ".join(f"({r})" for r in (
    "10 * n_symbols > n_words", "10 * n_exclaim > 3 * n_words", "10 * n_upper > 4 * word_chars", "10 * n_digits > 4 * word_chars",
    "word_chars < 2 * n_words", "word_chars > 15 * n_words", "2 * n_dup_lines > n_lines",
))

ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines, row_number() OVER () AS rid FROM documents),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
k AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM g),
p AS (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS i FROM k WHERE c >= 2),
r AS (SELECT rid, count(*) AS n FROM p GROUP BY rid),
f AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    length(t) - length(translate(t, '!', '')) AS n_exclaim, length(t) - length(translate(t, '{UPPER}', '')) AS n_upper,
    length(t) - length(translate(t, '0123456789', '')) AS n_digits, len(lines) AS n_lines FROM d LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND NOT ({_REJECTS}) AS kept FROM b"""

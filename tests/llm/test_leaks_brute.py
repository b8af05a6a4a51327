"""Leaks against plain loops over every document and item; awkward rows."""

import math
import random
from collections import Counter, defaultdict

from strandloom.llm import decontaminate as D


def sides(text):
    """Template words and values of both templates, and the plain words."""
    ws, both = D.templates((text or "").encode())
    out = []
    for t, slot, starts in both:
        ends = [*starts[1:], len(ws)]
        values = ["".join(D._value(w) for w in ws[a:b]) if t[i] == D._QTY else " ".join(D._value(w) for w in ws[a:b]) for i, (a, b) in enumerate(zip(starts, ends))]
        out.append((t.tolist(), slot.tolist(), values))
    return out, [v for w in ws if (v := D._value(w))]


def held(doc, item, k=D.WINDOW):
    (mine, plain_doc), (theirs, plain_item) = doc, item
    usable = [[p for p in range(len(t) - k + 1) if sum(not s for s in slot[p : p + k]) >= D.LITERALS] for t, slot, _ in theirs]
    if not any(usable):
        n = len(plain_item)
        return n > 0 and any(plain_doc[i : i + n] == plain_item for i in range(len(plain_doc) - n + 1))
    for (t, slot, val), (u, _, other), places in zip(mine, theirs, usable):
        if not places:
            continue
        span = max(places) + k
        at = defaultdict(list)
        for p in range(len(t) - k + 1):
            at[tuple(t[p : p + k])].append(p)
        hits = [(p, q) for q in places for p in at[tuple(u[q : q + k])]]
        for half in (0, 1):
            bands = defaultdict(list)
            for p, q in hits:
                bands[math.floor((2 * (p - q) + half * span) / (2 * span))].append((p, q))
            for group in bands.values():
                if len({q for _, q in group}) < D.COVERAGE * len(places):
                    continue
                met = Counter((p - q, other[q + j], val[p + j]) for p, q in group for j in range(k) if slot[p + j])
                share = []
                for side in (1, 2):
                    top, total = Counter(), 0
                    for key, n in met.items():
                        top[key[0], key[side]] = max(top[key[0], key[side]], n)
                        total += n
                    share.append(sum(top.values()) / total if total else 1.0)
                if min(share) >= D.CONSISTENCY:
                    return True
    return False


def check(spark, docs, items):
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    d = D.with_row(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(d, b).collect()}
    left, right = [sides(t) for t in docs], [sides(t) for t in items]
    want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if held(x, y)}
    assert got == want
    return got


def test_against_every_pair(spark, sf):
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert check(spark, docs, items)


def test_edited_and_shared_windows(spark):
    r = random.Random(2)
    word = lambda: r.choice(["alpha", "beta", "gamma", "delta", "omega", "Paris", "Otto", "km", "in", "7", "12", "5kg", "the", "of"])
    items = [" ".join(word() for _ in range(r.randint(1, 18))) for _ in range(40)] + ["the same words for all of the items here"] * 5 + [None, "", "  "]
    docs = []
    for _ in range(60):
        ws = [w for _ in range(r.randint(0, 4)) for w in [*(r.choice(items) or "").split(), *(word() for _ in range(r.randint(0, 12)))]]
        docs.append(" ".join(w if r.random() < 0.93 else word() for w in ws))
    check(spark, docs + docs[:3] + [None, ""], items)


def test_values_stand_one_to_one_and_windows_in_one_stretch(spark):
    item = "she bought 3 apples at the market and then 5 pears at the other market for 9 friends of hers"
    far = " ".join("filler" for _ in range(200))
    ws = item.split()
    scattered = f" {far} ".join(" ".join(ws[i : i + 6]) for i in range(0, len(ws), 6))
    docs = [item.replace("3", "4").replace("5", "6"), item.replace("3", "4").replace("5", "4").replace("9", "4"), scattered, item.replace("and then", "and then with a word put in")]
    assert check(spark, docs, [item]) == {(0, 0), (3, 0)}


def test_prepositions_are_no_units():
    t, slot, _ = D.templates(b"a man in blue walks 12 in and in again")[1][0]
    assert slot.tolist() == [False, False, False, False, False, True, False, False, False]

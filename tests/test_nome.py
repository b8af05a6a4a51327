"""Calls of reads against the letters of their sequence, by plain loops over rows with nulls and repeats."""

import random

from strandloom.operators import methylation as ME

KIND = "read string, chrom string, pos long, start long, end long, call string, meth boolean"


def _own(seq, k):
    around = "".join(seq[i] if 0 <= i < len(seq) else "N" for i in range(k - 2, k + 3))
    if around[2] == "C":
        return around
    return "".join({"A": "T", "C": "G", "G": "C", "T": "A"}.get(x, x) for x in reversed(around)) if around[2] == "G" else None


def _plain(calls, seqs):
    out = []
    for read in {r[:2] + r[3:5] for r in calls}:
        name, chrom, start, end = read
        if start is None:
            continue
        lo, hi = min(x for x in (start, end) if x is not None), max(x for x in (start, end) if x is not None)
        n = [0, 0, 0, 0]
        for _, _, pos, _, _, call, meth in [c for c in calls if c[:2] + c[3:5] == read and None not in read and c[2] is not None and lo <= c[2] <= hi]:
            for seq in [s for i, s in seqs if i == chrom and s is not None and pos <= len(s)]:
                own = _own(seq, pos - 1)
                if own is None or call is None or meth is None:
                    continue
                h = own[3] in "ACT"
                context = "Z" if own[3] == "G" else "X" if h and own[4] == "G" else "H" if h and own[4] in "ACT" else None
                if context == call.upper():
                    if context == "Z" and own[1] in "AT":
                        n[not meth] += 1
                    elif context != "Z" and own[1] == "G":
                        n[2 + (not meth)] += 1
        out += [(name, chrom, lo, hi, *n) for i, s in seqs if i == chrom and s is not None and chrom is not None and start - 2 > 1 and len(s) >= start + (hi - lo + 1) + 2]
    return sorted(out, key=str)


def test_reads_meet_letters_chunk_by_chunk(spark):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("ACGTACGTCGGCN") for _ in range(n))
    seqs = [("a", text(900)), ("b", text(256)), ("b", text(300)), ("c", None), ("d", ""), (None, text(90))]
    calls = []
    for k in range(300):
        chrom, low, size = r.choice("aaabbcd"), r.randint(1, 290), r.choice([1, 30, 60, 300])
        start, end = (low, low + size - 1) if k % 2 else (low + size - 1, low)
        calls += [(f"r{k}", chrom, r.randint(low - 3, low + size + 3), start, end, r.choice("ZzXxHhZXH.u"), r.random() < 0.5) for _ in range(12)]
    calls += [c for c in calls if c[0] in ("r3", "r4", "r5")]
    calls += [("n", "a", None, 10, 40, "Z", True), ("n", "a", 20, 10, 40, None, True), ("n", "a", 20, 10, 40, "H", None), (None, "a", 20, 10, 40, "H", True), ("n", None, 20, 10, 40, "H", True)]
    calls += [("e", "a", 10, 10, None, "H", True), ("e", "a", 10, None, 10, "H", True), ("far", "a", 2000, 10, 3000, "H", True)]
    got = ME.nome_read_summary(spark.createDataFrame(calls, KIND).repartition(3), spark.createDataFrame(seqs, "id string, seq string"))
    assert sorted(map(tuple, got.collect()), key=str) == _plain(calls, seqs) and sum(sum(x[4:]) for x in map(tuple, got.collect())) > 40
    # Letters come from chunks; bases are no rows of their own, whose pieces had 16 letters.
    assert "{1,16}" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_sites_by_read_equal_sites_and_meet_letters_where_they_are(spark):
    r = random.Random(4)
    seqs = [("a", "".join(r.choice("ACGTN") for _ in range(700))), ("b", "CG" * 128), ("b", "GC" * 150), (None, "CCGG")]
    reads = [(r.choice("aab"), r.choice("+-"), r.randint(1, 660)) for _ in range(40)]
    rows = [(c, s, at, at + k, r.choice("ZzXxHh."), r.random() < 0.5) for c, s, at in reads for k in range(30)] + [("a", "+", 1, None, "Z", True), (None, "+", 1, 5, "Z", True), ("a", "+", 1, 3, "Z", None)]
    calls = spark.createDataFrame(rows, "chrom string, strand string, at long, pos long, call string, meth boolean").repartition(3)
    seqs = spark.createDataFrame(seqs, "id string, seq string")
    plain, lists = ME.site_methylation(calls), ME.site_methylation(calls, read=["chrom", "strand", "at"])
    seen = lambda df: sorted((tuple(x) for x in df.collect()), key=str)
    assert seen(lists.select(*plain.columns)) == seen(plain.filter("pos IS NOT NULL")) and "_c" in lists.columns
    for options in ({"upstream": True}, {"contexts": ("CG",), "zero_based": True}):
        want = ME.cytosine_report(seqs, plain, **options).filter("meth + unmeth >= 1")  # every C is a row
        for cov in (plain, lists):
            got = ME.cytosine_report(seqs, cov, threshold=1, **options)
            assert got.dtypes == want.dtypes and seen(got) == seen(want) and got.count() > 10
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "{1,16}" not in text  # only covered letters are looked at

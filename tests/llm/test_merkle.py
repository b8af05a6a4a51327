"""The manifest against plain loops, and requests for some leaves only."""

import hashlib
import zlib

from pyspark.sql import functions as F

from strandloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, rank long, path string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The top of the nodes, and the siblings (left, right) of each, level by level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, merged = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for k in range(len(run)):
                for i in groups[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H(*run))
            merged.append([i for g in groups[a : a + 8] for i in g])
        nodes, groups = up, merged
    return nodes[0] if nodes else None, paths


def loops(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: climb([x[2] for x in sorted(by[g], key=lambda x: x[:3])]) for g in langs}
    root, above = climb([trees[g][0] for g in langs])
    out = []
    for g, up in zip(langs, above):
        for (_, _, own, r), path in zip(sorted(by[g], key=lambda x: x[:3]), trees[g][1]):
            path = path + up
            i, s, lang, n, t = r
            bad = i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and t is not None
            f = leaf(i, s, lang, n, "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) if bad else own
            for a, b in path:
                f = H(a, f, b)
            out.append((str(i), own, trees[g][0], root, H(*(a + b for a, b in path)), f, f == root))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "p") for r in rows], SCHEMA)


def made():
    rows = [(i * 7 % 613, f"s{i % 3}", ["en", "de", "é"][min(i % 5, 2)], i, f"Text {i} Über") for i in range(600)]
    rows += [(1, None, None, None, None), (2, "", "solo", 0, ""), (None, "s", "en", 3, "no Id"), (None, "s", "en", 3, "no Id"), (9, "s", "en", 3, "AGAIN"), (9, "s", "en", 3, "AGAIN"), (10, "s", "en", 3, "Long " * 200_000)]
    return rows


def check(spark, rows):
    got = merkle.verify(frame(spark, rows), {"text": merkle.tampered(F.col("doc_id"), F.col("text"))}).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got) == loops(rows)


def test_against_loops(spark):
    check(spark, made())


def test_small_manifests(spark):
    check(spark, [(1, "s", "en", 1, "A")])  # the leaf is the root, the proof is empty
    check(spark, [(1, "s", "en", 1, "A"), (2, "s", "de", 1, "a")])
    check(spark, [(i, "s", f"l{i}", 1, "A") for i in range(20)])  # two levels above the languages
    assert merkle.verify(frame(spark, []), {}).collect() == []


def test_requests(spark):
    """Only the requested leaves come out, with the proofs that they have in the whole."""
    rows = made()
    docs = frame(spark, rows).select("doc_id", F.col("lang").alias("name"), merkle.leaf_digest(**{c: F.col(c) for c in merkle.COLUMNS}).alias("digest"))
    m = merkle.manifest(docs, "name", ["doc_id"])
    every = {str(r) for r in m.proofs().collect()}
    wanted = m.docs.leaves.filter("rank % 50 = 3 OR n = 1").select("group", "rank")
    some = m.proofs(wanted).collect()
    assert 10 < len(some) == wanted.count() < len(rows)
    assert {str(r) for r in some} <= every and len({r.root for r in some}) == 1

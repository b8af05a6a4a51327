"""The trie against plain loops, with long, empty, repeated and tied conversations."""

import hashlib
import re
import zlib

from strandloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, idx string, pos string, words string"


def loops(rows):
    name = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    own = {}
    for c, turn, r, t in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), name(r or "", t or ""), r or "", t or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h] + v[h:])
    members, ends = {}, {}
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], set()).add(c)
        ends.setdefault(v, []).append(c)
    below = {k: [0, 0, 0] for k in members}  # saved, leaves, children
    parents = {k[:-1] for k in members if k}
    for k, m in members.items():
        saved = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            below[k[:d]][0] += saved
            below[k[:d]][1] += k not in parents
        if k:
            below[k[:-1]][2] += 1
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), below[k][2], below[k][1], below[k][0], sha(ends.get(k, [])))
        for k, m in members.items()
    )


def check(spark, rows):
    df = spark.createDataFrame([(*r, "i", "p", "w") for r in rows], SCHEMA)
    got = prefix_trie.conversation_trie(df).collect()
    out = sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)
    assert out == loops(rows)


def test_against_loops(spark):
    rows = []
    for c in [*range(-45, 130), 4000, 4007]:
        for i in range(c * c % 7):
            rows.append((c, i if i else None, "user" if i % 2 == 0 else None, f"turn {i} of {c % 3}" if (c + i) % 5 else None))
    rows += [(200 + c, 0, "user", "hello there") for c in range(200)]  # a third of them alike
    rows += [(None, 1, "user", "lost"), (7, 3, "user", "tie b"), (7, 3, "user", "tie a"), (7, 3, "user", "tie a")]
    check(spark, rows)


def test_long_conversations(spark):
    """More turns than a cell holds, shared by two conversations, with a hundred thousand words in one turn."""
    rows = [(c, i, "user", f"line {i} with words") for c in (20, 31, 33) for i in range(2100)] + [(31, 2100, "user", "more"), (33, 2101, "user", "word " * 100_000)]
    check(spark, rows)


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []

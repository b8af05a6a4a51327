"""Corpus operators against brute force, and on awkward rows."""

import random
import re
import zlib
from collections import Counter

import compare
import numpy as np
import pytest

from strandloom.llm import char_cnn, decontaminate, html_text, licenses, mixing, near_dup, quality, records, registry, secrets, shingles, tokens, url_rules

SCHEMA = "doc_id long, text string, source string, extra map<string,int>, n_words string, kept string, text_ string"
LONG = "lorem ipsum dolor " * 20000


def awkward(spark):
    rows = [
        (1, None, "a"), (2, "", "a"), (3, LONG, None), (4, "same words here again", "b"), (4, "same words here again", "b"),
        (None, "a row without an id", "b"), (5, " \n\t ", None), (6, "é İ ß \u2028 日本語 \x00 <|endoftext|> don't", "b"),
    ]
    return spark.createDataFrame([(*r, {"k": 1}, "x", "y", "z") for r in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, sf, name):
    compare.same(registry.queries()[name](spark, sf), registry.oracle_sql()[name], compare.views(sf))


OPERATORS = {
    "secrets": lambda d: secrets.find_secrets(d, model=_model()),
    "tokens": tokens.count_tokens,
    "decontaminate": lambda d: decontaminate.decontaminate(d, d.sparkSession.createDataFrame([(1, None), (2, ""), (3, "one two three four five six seven")], "item_id long, text string")),
    "records": lambda d: records.read_records(records.pack(d)),
    "mixing": mixing.mix,
    "quality": quality.judge_quality,
    "near_dup": near_dup.near_duplicates,
    "licenses": licenses.find_licenses,
    "urls": lambda d: url_rules.judge_urls(d, url="text"),
    "html": lambda d: html_text.extract_text(d, html="text"),
}
_MODEL = []


def _model():
    if not _MODEL:
        _MODEL.append(char_cnn.fit())
    return _MODEL[0]


def test_many_texts_under_one_id(spark):
    """Every row is judged by its own text, and a class takes one row's text, not all texts of its id."""
    words = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(words[:40]) + f" end{i}") for i in range(50)] + [(8, " ".join(words[:40]) + " end0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == 51 and {r.component_id for r in got} == {7}
    wanted = docs.limit(1).select(near_dup.row_key(docs.doc_id, docs.text).alias("rep_row")).selectExpr("unhex('00') AS key", "rep_row")
    assert near_dup._sets(docs.withColumn("row", near_dup.row_key(docs.doc_id, docs.text)), wanted, 3).count() == 1


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows_and_empty_tables(spark, name):
    docs = awkward(spark)
    assert len(OPERATORS[name](docs).collect()) == docs.count()
    assert OPERATORS[name](docs.limit(0)).collect() == []


def test_stages_keep_columns(spark):
    docs = awkward(spark)
    for out in (quality.keep_good(docs), near_dup.drop_near_duplicates(docs), mixing.mixed_documents(docs)):
        assert out.columns == docs.columns
        out.collect()
    assert near_dup.drop_near_duplicates(docs).count() == docs.count() - 1  # one of the two equal rows


def test_secrets(spark, sf):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ['x api_key="abc12" token: abcdefgh', "secret:token: abcdef AKIA" + "B" * 16 + " é " + "a1" * 12, "k\u212aey PASSWD = 'abcdef'"]
    for text, spans in zip(texts, secrets.scan(texts, _model())):
        want = [(m.start(), m.end(), "assign") for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 6]
        want += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
        want += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
        assert sorted(s[:3] for s in spans if s[2] != "model") == sorted(want)


def test_secret_model_on_held_out_findings():
    x, of, y, kinds = char_cnn.labelled_findings(1500, 99)
    hit = char_cnn.largest(char_cnn.score(_model(), x), of) >= np.array(_model()["thresholds"])[kinds]
    assert hit[y == 1].mean() > 0.94 and y[hit].mean() > 0.9


@pytest.mark.parametrize("front", ["", "key=", "frontend_environment_production_deployment_client_name=", "a/very/long/path/of/many/folders/and/then/some/more/x/", "AZURE_STORAGE_ACCOUNT_PRODUCTION_CONNECTION_ACCESS=", "export sk_live_"])
def test_secrets_behind_long_names_and_paths(front):
    r, chars = random.Random(4), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    texts = [f"the old value {front}{''.join(r.choice(chars) for _ in range(32))} was here" for _ in range(200)]
    found = secrets.scan(texts, _model())
    assert sum(any(s[1] == t.index(" was here") for s in spans) for t, spans in zip(texts, found)) >= 190


def test_prose_has_no_secrets(spark, sf):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sum(any(s[2] == "model" for s in spans) for spans in secrets.scan(texts, _model())) <= 0.01 * len(texts)


def test_model_adds_a_bare_key():
    text = "the value sk_live_9aF3kLm2Qx7Zt1Wv8Yb4Nc6 was used as api key"
    model = _model()
    assert any(k == "model" for _, _, k, _ in secrets.scan([text], model)[0])


def _texts(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    return docs | {10_001: "a <|endoftext|> b", 10_002: "İß'S  x\x1cz don't\n\n we'll", 10_003: "日本語 “q” … ١٢"}


def test_token_counts_and_ids_match_the_library(spark, sf):
    texts = list(_texts(spark, sf).values())
    r = random.Random(6)
    odd = ["日本", "語 x", "Привет", "мир", "Σίσυφος", "😀", "\u0085", "\u180e", "\u200b", "\xa0", "<|endoftext|>", "<|", "ʼn", "ǅ", "é", "a", "don't", "12", " ", "\n", "  ", "\t", "..", "x" * 70, "ﬁ", "e\u0301", "\u2028", "½", "٣"]
    texts += ["".join(r.choice(odd) + r.choice(["", " ", " ", "\n"]) for _ in range(r.randint(1, 30))) for _ in range(1500)]
    count = tokens._counts(tokens.BYTE_BPE, tokens.whole_tokens())
    for name, ours in ((tokens.BYTE_BPE, lambda t: tokens.count_text(t, tokens.BYTE_BPE, count)), (records.WORD_BPE, lambda t: np.frombuffer(records.encode(t, records.WORD_BPE), "<u2").tolist())):
        for text, e in zip(texts, tokens.load(name).encode_batch(texts, add_special_tokens=False)):
            assert ours(text) in (len(e.ids), e.ids)


def test_records_round_trip(spark, sf):
    docs = _texts(spark, sf)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    manifest = records.pack(df)
    got = {r.doc_id: r for r in records.read_records(manifest, with_ids=True).collect()}
    start = 0
    for i in sorted(docs):
        ids = tokens.load(records.WORD_BPE).encode(docs[i], add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    shuffled = [r.doc_id for r in records.read_records(manifest, seed=3).collect()]
    assert sorted(shuffled) == sorted(docs) and shuffled != sorted(docs)


def test_damaged_record_is_refused():
    data = bytearray(records.frame(b"abcd"))
    assert records.unframe(memoryview(data), 0)[0] == b"abcd"
    data[13] ^= 1
    with pytest.raises(ValueError):
        records.unframe(memoryview(data), 0)


def test_leaks(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    item = f"Anna has 12 apples and {word()} gives {word()} 5 kg to {word()} before {word()} asks how {word()} {word()} remain"
    other = item.replace("12", "70").replace("5 kg", "9 kg").replace("Anna", "Otto")
    broken = "12 " + " ".join(f"{w}" for w in item.split()[::-1])
    prose = lambda n: " ".join(word() for _ in range(n))
    docs = [(1, prose(50) + " " + item + " " + prose(50)), (2, prose(30) + " " + other), (3, broken), (4, prose(200)), (5, None), (6, item.upper())]
    d = decontaminate.with_row(spark.createDataFrame(docs, "doc_id long, text string"))
    b = spark.createDataFrame([(1, item), (2, prose(40)), (3, "too short"), (4, None)], "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(d, b).collect()} == {(1, 1), (2, 1), (6, 1)}


def test_slots_must_agree(spark):
    item = "set x to 5 then add 5 and 5 again so that 5 is the very last value of it all"
    odd = item.split()
    for k, v in zip([i for i, w in enumerate(odd) if w == "5"], "6789"):
        odd[k] = v
    d = decontaminate.with_row(spark.createDataFrame([(1, item.replace("5", "8")), (2, " ".join(odd))], "doc_id long, text string"))
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {x.doc_id for x in decontaminate.find_leaks(d, b).collect()} == {1}


def test_mix_takes_each_target(spark, sf):
    got = mixing.query(spark, sf).toPandas()
    src = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").toPandas()
    got = got.merge(src, on="doc_id")
    assert (got.taken <= 2 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"), top=("size", "max"))
    assert ((per.taken - per.target).abs() <= per.top).all()
    assert abs(per.target.sum() - 1.5 * got["size"].sum()) < 1e-6 * got["size"].sum()


def _near_group(seed, n, edits):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdefgh") for _ in range(7)) for _ in range(90)]
    out = []
    for _ in range(n):
        ws = list(base)
        for _ in range(r.randint(0, edits)):
            ws[r.randrange(len(ws))] = "".join(r.choice("xyz") for _ in range(7))
        out.append(" ".join(ws))
    return out


def _components(docs, k, percent):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, k, percent):
    texts = _near_group(1, 120, 7) + _near_group(2, 60, 3) + _near_group(3, 30, 0) + ["a b", "A b", "b a", "", None, "one", "x y z w"]
    docs = list(enumerate(texts, 100))
    random.Random(0).shuffle(docs)
    want = _components(docs, k, percent)
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=k, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_joint_estimate_is_close():
    r = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.85):
        pool = r.integers(0, 2**63, 5000).astype(np.uint64)
        a, b = pool[:1000], np.concatenate([pool[: int(2000 * share / (1 + share))], pool[2000 : 3000 - int(2000 * share / (1 + share)) + 1000]])[:1000]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est = near_dup.joint_estimate(near_dup.sketch(a, 400)[None], near_dup.sketch(b, 400)[None], np.array([1000.0]), np.array([1000.0]))[0]
        assert abs(est - true) < 0.1
    assert (np.maximum(near_dup.sketch(a, 40), near_dup.sketch(b, 40)) == near_dup.sketch(np.union1d(a, b), 40)).all()


def test_license_alignment(spark, sf):
    mit = licenses.TEMPLATES["MIT"][2]
    gap = mit.replace("restriction, including", "any restriction whatsoever, including").replace("hereby ", "")
    text = "some words before " + gap + " and after. Licensed under CC BY-NC 4.0. Then Licensed under CC BY-NC 4.0. the license under of by"
    found = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE).scan(text)
    assert [f[0] for f in found] == ["MIT", "CC-BY-NC-4.0", "CC-BY-NC-4.0"] and found[0][3] > 0.95
    assert licenses.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 4)]) == [(1, 1), (2, 2), (4, 4)]
    lines = ["This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0."]
    for r in licenses.find_licenses(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        assert len(r.licenses) >= sum(r.text.count(x) for x in lines)


PAGE = """<html><head><title>T</title><script>if (a < b) "</p>"</script></head><body><div class="cookie-notice">We use cookies</div>
<header><h1>Site</h1></header><nav><a href=1>Home</a></nav><article><h1>Head</h1><p>First &amp; <b>bold</b>er&nbsp;text.<p>Second<br>line
<aside>Side</aside><form><input>Sign up</form><div class="ad">Buy</div><ul><li>item</ul></article><section id="comments"><p>A comment</section><footer>&copy; x</footer>"""


def test_html():
    assert html_text.main_text(PAGE) == "Head First & bolder text. Second line item"
    assert html_text.main_text(None) == "" and html_text.main_text("") == "" and html_text.main_text("<p") == ""
    plain = "<body><div id=menu><a href=x>The one</a></div><div><p>" + "It is the story of a man who was in the house and had to go. " * 5 + "</p><p>Short.</p></div><p><a href=y>all links here</a></p></body>"
    assert html_text.main_text(plain) == ("It is the story of a man who was in the house and had to go. " * 5).strip() + " Short."


def test_url_rules():
    assert url_rules.rule_tokens("||ads.*^banner^") == ["ads", "banner"]
    assert re.search(url_rules.rule_regex("^casino^"), "http://m.casino-win.example.com/")
    assert not re.search(url_rules.rule_regex("^casino^"), "http://casinos.example.com/")


def test_url_exceptions(spark):
    rows = [(1, "http://responsible.gambling.org/casino"), (2, "http://x.org/casino"), (3, None), (4, "casino"), (5, "x://h?://a/b"), (6, "http://EXAMPLE.com/en/x"), (7, "http://com"), (8, "http://www.example.com/en/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1][3] == "allow" and got[2][3] == "block" and got[3] == ("", "", None, "allow") and got[4] == ("", "", None, "block")
    assert got[5][:2] == ("h", "") and got[6] == ("example.com", "/en/x", "example.com/en/", "block") and got[7][2] is None and got[8][2] == "www.example.com/en/"


def test_rules_by_rejection_per_cost(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = quality.base_rules() + quality.rules()
    ordered = quality.order_rules(docs, "text", rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    eager = quality.judge_quality(docs).filter("kept").select("doc_id", "text")
    lazy = quality.keep_good(docs)
    assert lazy.columns == docs.columns and sorted(eager.collect()) == sorted(lazy.select("doc_id", "text").collect())


def test_windows_of_short_texts():
    assert len(shingles.shingle_set(b"a b", 3)) == 1 and len(shingles.shingle_set(None, 3)) == 0
    assert (shingles.shingle_set(b"A b C d", 3) == shingles.shingle_set(b"a B c D", 3)).all()
    assert Counter(map(len, [shingles.word_list(b"a\x0bb\x0cc\xc2\xa0d")])) == Counter([3])

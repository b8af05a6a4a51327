"""What every operator and pipeline stage says of null, empty, white, repeated and very long rows, and of empty tables."""

import corpus_pipeline
import pytest
from test_operators import LONG, _model, awkward

from strandloom.llm import decontaminate, html_text, licenses, mixing, near_dup, quality, records, secrets, tokens, url_rules

HOLLOW = (1, 2, 5)  # null, empty and white texts


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_texts_without_words(spark):
    docs = awkward(spark)
    found = by_id(secrets.find_secrets(docs, model=_model()))
    counted, notices, page = by_id(tokens.count_tokens(docs)), by_id(licenses.find_licenses(docs)), by_id(html_text.extract_text(docs, html="text"))
    judged = by_id(quality.judge_quality(docs))
    for i in HOLLOW:
        assert found[i][0].secrets == [] and notices[i][0].licenses == [] and page[i][0].text == "" and page[i][0].n_chars == 0
        assert judged[i][0].n_words == 0 and judged[i][0].base_failed and not judged[i][0].kept
    assert (counted[1][0].n_bytes, counted[1][0].n_tokens, counted[1][0].over_limit) == (0, 0, False) and counted[5][0].n_tokens > 0
    urls = url_rules.judge_urls(docs, url="text").collect()
    assert {(r.host, r.path, r.rule, r.verdict) for r in urls} == {("", "", None, "allow")}


def test_long_and_repeated_texts(spark):
    docs = awkward(spark)
    long = by_id(quality.judge_quality(docs))[3][0]
    assert long.n_words == 60_000 == long.n_repeat_words and long.base_failed
    assert by_id(tokens.count_tokens(docs))[3][0].n_tokens == len(tokens.load(tokens.BYTE_BPE).encode(LONG, add_special_tokens=False).ids)
    near = by_id(near_dup.near_duplicates(docs))
    assert near[3][0].n_shingles == 3 and [(r.component_id, r.kept) for r in near[4]] == [(4, True)] * 2
    assert near[None][0].component_id is None and near[None][0].kept
    rows = by_id(records.read_records(records.pack(docs)))
    assert rows[3][0].n_tokens == len(tokens.load(records.WORD_BPE).encode(LONG, add_special_tokens=False).ids) + 1
    assert rows[1][0].n_tokens == rows[2][0].n_tokens == 1 and rows[None][0].start == 0 and len(rows[4]) == 2
    taken = by_id(mixing.mix(docs))
    assert all(taken[i][0].size == 0 == taken[i][0].taken for i in HOLLOW) and all(r.taken <= 2 * r["size"] for x in taken.values() for r in x)


def test_equal_items_and_rows(spark):
    item = "one two three four five six seven"
    docs = decontaminate.with_row(spark.createDataFrame([(1, item), (1, item), (2, item + " eight"), (None, item), (3, None)], "doc_id long, text string"))
    items = spark.createDataFrame([(7, item), (8, item), (None, item), (9, None), (9, "")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()), key=str)
    assert got == sorted(((d, i) for d in (1, 2, None) for i in (7, 8, None)), key=str)
    none = items.limit(0)
    assert decontaminate.find_leaks(docs, none).collect() == [] and decontaminate.find_leaks(docs.limit(0), items).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_and_empty_tables(spark, sf, name, stage):
    docs = awkward(spark)
    out = stage(spark, docs, sf)
    ids = sorted((r.doc_id for r in out.collect()), key=str)
    want = {
        "quality rules": [], "near duplicates": [1, 2, 3, 4, 5, 6, None], "benchmark decontamination": [1, 2, 3, 4, 4, 5, 6, None], "token records": [1, 2, 3, 4, 4, 5, 6, None],
    }
    if name in want:
        assert ids == sorted(want[name], key=str)
    else:
        assert set(ids) <= {3, 4, 6, None}  # the mix never takes texts without words
    if name != "token records":
        assert out.columns == docs.columns
    assert stage(spark, docs.limit(0), sf).collect() == []

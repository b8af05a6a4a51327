"""Corpus preparation in five stages, from the documents table to verified token records.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Between stages the documents are a written table, so no stage repeats an earlier one.
"""

from strandloom.llm import decontaminate, mixing, near_dup, quality, records
from strandloom.llm.common import table, written


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go.

    Null, empty and white texts have no words and go; very long ones are judged whole; repeated rows and rows without an
    id are judged one by one. All columns stay, whatever their names. An empty table stays empty.
    """
    return quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, the one with the smallest id: five-word shingles, similarity 0.8 or more.

    Rows equal in id and text are one document. Documents without words and rows without an id all stay, once per
    id and text. All columns stay. An empty table stays empty.
    """
    return near_dup.drop_near_duplicates(docs, k=5, percent=80)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go.

    Null, empty and white texts hold none and stay, as do null and empty items without effect. Repeated rows go or stay together;
    an id is not needed. All columns stay. An empty table, or an empty benchmark, takes nothing away.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark, docs, sf_dir):
    """Documents as often as the mix takes them.

    Texts without words are never taken; a null source is a source of its own; repeated rows queue one by one. All columns
    stay. An empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def token_records(spark, docs, sf_dir):
    """Token records written and read back: doc_id, start, n_tokens, ids_crc32.

    A null text is the empty text, the end id alone; null ids come first; repeated rows are records of their own; very long texts
    are one record each. Other columns are left. An empty table gives no rows.
    """
    return records.read_records(records.pack(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("token records", token_records),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

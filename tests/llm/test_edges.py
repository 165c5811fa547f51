"""Every operator and stage on odd rows and on an empty table."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from terrace.llm import decontaminate, jaccard, lexical, licenses, lines, quality, sequences, shards, simhash, token_rows, toxicity, variants

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def items(spark):
    line = " ".join(f"line7word{j}" for j in range(12))
    rows = [(1, f"{line}\nand more of it here"), (2, None), (None, ""), (3, "one"), (3, "one")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("words", F.lit(1))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 0), (9, 1)], "doc_id bigint, toxic int").withColumn("terms", F.lit(1))


OPERATORS = {
    "token_rows": lambda d, i, n: token_rows.rows(d),
    "shards": lambda d, i, n: shards.assigned(d),
    "quality": lambda d, i, n: quality.verdicts(d),
    "licenses": lambda d, i, n: licenses.scanned(d, licenses.known_texts(d.sparkSession)),
    "simhash": lambda d, i, n: simhash.grouped(d),
    "decontaminate": lambda d, i, n: decontaminate.leaks(d, i),
    "sequences": lambda d, i, n: sequences.packed(d),
    "toxicity": lambda d, i, n: toxicity.scored(d, n),
    "lines": lambda d, i, n: lines.without_repeated_lines(d),
    "lexical": lambda d, i, n: lexical.ranked(d, i),
    "variants": lambda d, i, n: variants.grouped(d),
    "jaccard": lambda d, i, n: jaccard.grouped(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd_documents, items, labels, name):
    found = OPERATORS[name](odd_documents, items, labels).collect()
    per_row = {"quality", "simhash", "toxicity", "lines", "shards", "jaccard"}
    if name in per_row:
        assert len(found) == odd_documents.count()
    elif name == "licenses":
        assert sum(r.line == -1 for r in found) == odd_documents.count()
    elif name == "decontaminate":
        # The null-id text holds question and answer of item 1, and only doc 7 says "one".
        assert {(r.doc_id, r.item_id) for r in found} == {(None, 1), (7, 3)}
    elif name == "sequences":
        assert sum(r.piece == 0 for r in found) == odd_documents.count()
    elif name == "lexical":
        # Item 1 is a line of 1, 2 and 2, and of the text without an id; "one" is only in document 7; the other items have no terms.
        assert sorted((r.item_id, r.rank, r.doc_id) for r in found if r.item_id == 3) == [(3, 1, 7)]
        assert sorted(r.rank for r in found if r.item_id == 1) == [1, 2, 3, 4] and {r.doc_id for r in found if r.item_id == 1} == {None, 1, 2}
    elif name == "variants":
        assert found == []  # runs of letters end at digits, and are short here
    if name == "jaccard":
        by_text = {(r.doc_id, r.n_shingles): r.component_id for r in found}
        assert by_text[1, 94] == by_text[2, 94] == 1 and by_text[3, 0] == 3 and by_text[None, 0] is None and by_text[7, 1] == 7


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd_documents, items, labels, name):
    none = odd_documents.limit(0)
    assert OPERATORS[name](none, items.limit(0), labels.limit(0)).collect() == []
    assert OPERATORS[name](none, items, labels).collect() == []


def test_without_items_and_labels(odd_documents, items, labels):
    assert decontaminate.leaks(odd_documents, items.limit(0)).collect() == []
    scores = {r.score for r in toxicity.scored(odd_documents, labels.limit(0)).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 0.5


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, odd_documents, items, tmp_path, place):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    step = corpus_pipeline.STAGES[place][1]
    made = step(spark, odd_documents, str(tmp_path))
    rows = made.collect()
    if place < 4:
        assert made.columns == odd_documents.columns
    assert step(spark, odd_documents.limit(0), str(tmp_path)).collect() == []
    if place == 2:
        groups = simhash.grouped(odd_documents).collect()
        roots = simhash.near_duplicates(simhash.with_fingerprint(odd_documents, "fp")).select("root").distinct().count()
        assert len(rows) == roots < len(groups)
        assert {r.doc_id for r in rows} >= {r.component_id for r in groups}
    if place == 0:
        assert {r.doc_id for r in rows} == {1, 2, None, 6}


def test_whole_pipeline(spark, odd_documents, items, tmp_path):
    """The last stage's places, of odd rows and of empty tables."""
    for name, docs, known in (("odd", odd_documents, items), ("none", odd_documents.limit(0), items), ("nothing", odd_documents.limit(0), items.limit(0))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        known.write.parquet(str(tmp_path / name / "benchmark.parquet"))
        found = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {"doc_id", "piece", "sequence_id", "offset"} <= set(found[0].asDict()) and 6 in {r.doc_id for r in found} if name == "odd" else found == []
        assert {r.doc_id for r in found} <= {1, 2, None, 6}


def test_verdicts_of_odd_rows(odd_documents):
    by_id = {r._row.doc_id: r for r in quality.verdicts(odd_documents.where("doc_id in (3, 4, 5)")).collect()}
    assert all((r.n_words, r.failure_bits, r.base_failed) == (0, 1, True) for r in by_id.values())


def test_the_first_of_repeated_rows_keeps_its_lines(spark, odd_documents):
    found = lines.without_repeated_lines(odd_documents.where("doc_id = 2")).collect()
    assert sorted(r.n_removed for r in found) == [0, 8]
    text = "\n".join(f"line {i} of it" for i in range(6))
    rows = [(1, text, "a"), (1, text, "b"), (None, text, "a"), (None, text, "a"), (2, text, "a"), (2, "short", "a"), (2, "short", "a")]
    found = lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert len(found) == 7 and sum(r.n_removed for r in found) == 4 * 6
    # NULL ids come first, so one of them keeps the lines.
    assert [r._row.doc_id for r in found if r.n_removed == 0 and r.n_lines == 6] == [None]
    assert {r.text for r in found if r.n_lines == 1} == {"short"}
    both = lines.without_repeated_lines(odd_documents.where("doc_id in (1, 2)")).collect()
    assert sorted(r.n_removed for r in both) == [0, 8, 8]


def test_filters_stay_above_what_they_filter(documents):
    """Pushed down, a filter would compute windows of words and lines once per element of a list."""
    for df, wanted in ((quality.verdicts(documents), "kept and n_repeat_words > 0"), (lines.without_repeated_lines(documents), "n_removed > 0")):
        plan = df.where(wanted)._jdf.queryExecution().optimizedPlan().toString()
        assert max(map(len, plan.split("\n"))) < 6000
        assert 0 < df.where(wanted).count() < documents.count()

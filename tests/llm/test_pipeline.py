"""The stages one after another, each against a plain version on its own input."""

import corpus_pipeline
from cases import SMALL
from test_joins import plain_components
from test_tokens_files import check_pieces, ids_of
from tokenizers import Tokenizer

from feedloom.llm import templates
from feedloom.llm.common import stored
from feedloom.llm.tokens import default_tokenizer


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {}
    rows = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        assert docs.count() == len(kept[name])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    first = kept["quality_classifier"]
    known = [i for i in rows if i in labels]
    assert sum((i in first) == (labels[i] == 1) for i in known) >= 0.93 * len(known)
    components, _ = plain_components([(i, r["text"]) for i, r in first.items()])
    assert set(kept["ngram_jaccard_join"]) == {i for i, (_, c) in components.items() if i == c}
    second = kept["ngram_jaccard_join"]
    third = kept["benchmark_decontamination"]
    table = spark.createDataFrame([(i, r["text"]) for i, r in second.items()], "doc_id long, text string")
    leaked = {r["doc_id"] for r in templates.leaks(table, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert set(third) == set(second) - leaked
    assert {i for i, r in second.items() if any(t in r["text"] for t in items)} <= leaked
    fourth = kept["secret_scans"]
    assert set(fourth) == set(third) and all(r["text"] == third[i]["text"] or "[SECRET]" in r["text"] for i, r in fourth.items())
    library = Tokenizer.from_file(default_tokenizer())
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SMALL).collect()
    check_pieces(pieces, {i: ids_of(library, r["text"]) for i, r in fourth.items()})


def test_run_gives_the_pieces_of_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_stages_take_nulls_repeats_and_clashing_columns(spark):
    names = "quality own_id own_hash own_digest live times empty score node component_id spans key rank hash whole_text clean_text digest n".split()
    text = "some plain words that make a line of text.\nAnother line with token=abcdef123456 in it."
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, text + " And more."), (5, "word " * 3_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[k] * len(names)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in names))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    near = corpus_pipeline.near_copy_stage(spark, docs, SMALL).collect()
    assert sorted((r["doc_id"] or 0) for r in near) == [1, 2, 3, 5] or sorted((r["doc_id"] or 0) for r in near) == [1, 2, 3, 4, 5]
    masked = corpus_pipeline.secret_stage(spark, docs, SMALL).collect()
    assert len(masked) == len(rows) and sum("[SECRET]" in (r["text"] or "") for r in masked) == 4
    assert corpus_pipeline.packing_stage(spark, docs, SMALL).count() >= len(rows)

"""The pipeline and the register of queries."""

import numpy as np

import corpus_pipeline
import __spark_entry__ as entry
from tapline.llm import decontaminate
from tests.conftest import SF_DIR

DIR = str(SF_DIR)


def test_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))


def test_stages(spark, documents):
    docs = documents
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == documents.columns
        kept[name] = {r.doc_id: r.text for r in out.collect()}
        assert len(kept[name]) <= docs.count()
        docs = spark.createDataFrame(out.collect(), documents.schema)
    good = [d for d in labels if labels[d].quality == 1]
    assert sum(d in kept["quality"] for d in good) > 0.9 * len(good)
    items = [" ".join(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    assert not any(i in " ".join(decontaminate.words_of(t)) for t in kept["decontamination"].values() for i in items)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()
    assert len(last) == len(kept["decontamination"]) and all(r.round_trip and r.n_tokens * 4 == len(r.ids) for r in last)


def test_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, DIR).count() > 0
        assert stage(spark, docs.limit(0), DIR).count() == 0


def test_near_duplicates_from_a_shingle_similarity_of_0_8(spark):
    rng = np.random.default_rng(9)

    def jaccard(a, b):
        a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        return len(a & b) / len(a | b)

    rows, gone = [], set()
    # Words of a text, and how many of them are replaced; the last two are below 0.8.
    for size, edits in [(60, 1), (100, 1), (100, 2), (300, 1), (300, 3), (300, 5), (1000, 20), (100, 3), (300, 12)] * 8:
        text = [f"w{i}" for i in rng.integers(0, 100_000, size)]
        copy = list(text)
        for i in range(edits):
            copy[(2 * i + 1) * size // (2 * edits)] = f"new{rng.integers(0, 1 << 40)}"
        if jaccard(text, copy) >= 0.8:
            gone.add(len(rows) + 1)
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(copy))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.no_near_duplicates(spark, frame, DIR).collect()}
    assert len(gone) == 56 and kept & gone == set() and len(kept) == len(rows) - len(gone)


def test_all_pairs_of_a_bucket_are_verified(spark, monkeypatch):
    from tapline.llm import shingle_sets

    # The least node is alike with none of the others, which are alike in a row.
    sets = {1: [*range(0, 6), *range(100, 104)], 2: list(range(10)), 3: list(range(1, 11)), 4: list(range(2, 12))}
    table = spark.createDataFrame([(n, s) for n, s in sets.items()], "node long, shingles array<bigint>")
    nodes = spark.createDataFrame([(n, [7]) for n in sets], "node long, keys array<bigint>")
    for most in (1000, 1):
        monkeypatch.setattr(shingle_sets, "SET_TEXTS", most)
        found = shingle_sets.similar_links(nodes, lambda wanted: table.join(wanted, "node")).collect()
        assert {frozenset((r.a, r.b)) for r in found} == {frozenset((2, 3)), frozenset((3, 4))}

import math
import random
from collections import Counter

import pytest

from tapline.llm import search


def plain(docs, items, top):
    """Scores by definition: docs are (id, text), items are (id, text)."""
    counts = [(d, Counter(search.terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    many, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(search.terms_of(t))
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * many) // length
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("bounds", [{}, {"STRETCH": 64, "PAIRS": 3000, "ACCUMULATORS": 1, "GATHERED": 50}])
def test_query_against_definition(spark, documents, texts, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(search, name, value)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = rows(search.search(documents, items))
    assert got == plain(texts.items(), [(r.item_id, r.text) for r in items.collect()], 50)


def test_odd_rows(spark, odd):
    items = [(1, "one two THREE four"), (2, None), (3, "..."), (4, "zzzz"), (None, "one"), (1, "Bob words"), (5, "été 日本語 A"),
             (6, "x" * 20000), (7, "one two"), (7, "one two")]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'s' as score", "1 as doc_id")
    got = rows(search.search(odd, table, top=3))
    assert got == plain([(r.doc_id, r.text) for r in odd.collect()], items, 3)


def test_long_texts_and_ties(spark, monkeypatch):
    monkeypatch.setattr(search, "STRETCH", 1000)
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [
        (50, "word " * 5000 + "here" + " Ä" * 3000), (51, "y" * 5000 + " here"), (52, "here " + "z" * 5000)]
    items = [(0, "here words y"), (1, "Ä word " + "z" * 5000)]
    got = search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                        spark.createDataFrame(items, "item_id long, text string"), top=7)
    assert rows(got) == plain(docs, items, 7)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.search(none, items).count() == 0
    assert search.search(documents, items.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_the_graph_adds_up_to_the_items(seed):
    dice = random.Random(seed)
    items = {i: sorted({f"t{int(30 * dice.random() ** 2)}" for _ in range(dice.randint(1, 25))}) for i in range(30)}
    graph = search.Sharing(items)
    held = [{t for t, a in zip(graph.terms, graph.atom) if a == n} for n in range(graph.atoms)]
    for x, y in graph.nodes:
        assert not held[x] & held[y]
        held.append(held[x] | held[y])
    for terms, parts in zip(items.values(), graph.parts):
        assert sorted(t for p in parts for t in held[p]) == terms
    assert graph.additions() < sum(len(t) - 1 for t in items.values())

"""Operators that look at one document at a time, against plain versions."""

import base64
import hashlib
import re
import struct
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tapline.llm import byte_bpe, language, line_rules, pii, quality
from tests.conftest import SF_DIR

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(deadline=None)
@given(st.text())
def test_bpe_of_any_text(reference, text):
    codec = byte_bpe.load(PATH, P.PATTERN)
    [ids] = codec.encode([text])
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference.encode_ordinary(text)
    assert byte_bpe.load_decoder(PATH).decode(ids) == text.encode()


def test_bpe_streams_long_texts(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 100)
    text = "naïve words, 123 and more  \n\n" * 50
    [ids] = byte_bpe.Codec(PATH, P.PATTERN).encode([text])
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference.encode_ordinary(text)


def test_bpe_query(spark, texts, reference):
    rows = byte_bpe.op4_byte_bpe(spark, str(SF_DIR)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_rows(odd):
    rows = byte_bpe.digests(odd, PATH, P.PATTERN).collect()
    assert sorted(r.n_tokens for r in rows)[:2] == [0, 0] and len(rows) == odd.count()
    apart = byte_bpe.decode(byte_bpe.encode(odd, PATH, P.PATTERN), PATH)
    both = byte_bpe.transcode(odd, PATH, P.PATTERN)
    assert both.columns == apart.columns and both.exceptAll(apart).count() == 0 and both.count() == len(rows)
    first = byte_bpe.encode(odd, PATH, P.PATTERN).select(byte_bpe.ids_array().alias("a")).collect()
    assert sum(len(r.a) for r in first) == sum(r.n_tokens for r in rows)
    assert byte_bpe.digests(odd.limit(0), PATH, P.PATTERN).count() == 0


def test_quality_holds_out(spark):
    scored = quality.op7_quality(spark, str(SF_DIR)).toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().merge(scored, on="doc_id")
    unseen = labels[labels.held_out]
    assert (unseen.quality == unseen.predicted).mean() > 0.9
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.5) == (scored.predicted == 1)).all()


def test_quality_bounds_its_sample_and_odd_labels(spark, odd):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (4, 1), (5, 0), (5, 0), (6, 7), (6, None), (99, 1)],
                                   "doc_id long, quality int")
    model = quality.fit(odd, labels, quality.Settings(per_label=1))
    assert model.evidence.any()
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    blank = quality.fit(odd, labels.limit(0))
    assert {r.score for r in quality.score(odd, blank).collect()} == {0.5}
    assert quality.score(odd.limit(0), model).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = [b"some words here", b"", b"  other\twords", b"a", b"some words here"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    buckets, owner = quality.features(raw, np.cumsum([0, *map(len, texts)]))
    for i, text in enumerate(texts):
        alone, _ = quality.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert sorted(buckets[owner == i]) == sorted(alone)


def plain_profile(text, size):
    text = "".join(c if c.isalpha() else " " for c in text.lower())
    found = Counter()
    for word in text.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            found.update(g for i in range(len(padded) - n + 1) if (g := padded[i:i + n]).strip() and (n > 1 or g != " "))
    def code(g):
        return sum((0 if c == " " else ord(c)) << (42 - 21 * i) for i, c in enumerate(g)) + sum(
            language.NONE << (42 - 21 * i) for i in range(len(g), 3))
    return [code(g) for g, _ in sorted(found.items(), key=lambda x: (-x[1], code(x[0])))][:size]


@settings(deadline=None)
@given(st.lists(st.text(alphabet="abé Z.ñ\n1🙂", max_size=40), min_size=1, max_size=5))
def test_ranked_grams(texts):
    text, rank, gram = language.ranked(texts, 10)
    for i, t in enumerate(texts):
        assert gram[text == i].tolist() == plain_profile(t, 10)
        assert rank[text == i].tolist() == list(range(len(gram[text == i])))


def test_language_holds_out(spark, documents):
    found = language.op2_language(spark, str(SF_DIR)).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    unseen = found[found.held_out]
    assert len(found) == documents.count() and (unseen.lang == unseen.lang_pred).mean() > 0.95


def test_language_odd_rows(odd):
    rows = language.predicted(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (0, 1, 2))
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language.predicted(odd.where("lang = 'xx'")).collect()} == set()
    unknown = language.identify(odd, language.learn(odd.where("lang = 'xx'")))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub(r"\D", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in KINDS for m in re.finditer(p, text) if ok(m.group()))


def test_pii_base_spans(spark, documents, odd):
    rng = np.random.default_rng(2)
    parts = ["1", "2", "255", "256", "4111111111111111", "-", " ", ".", "+", "(", ")", "@", "a", "b-", "é", "🙂", "x.y", "%"]
    made = ["".join(rng.choice(parts, rng.integers(60))) for _ in range(800)]
    made += ["1.2.3.4.5.6.7.8", "a@b.c@d.e", "a@b.c+d@e.f", "+1234567890" * 3, "5.6.7.8 " * 700]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string")
    for docs in (frame, documents, odd):
        texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
        for r in pii.digests(docs).collect():
            wanted = plain_spans(texts[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(wanted.encode()).hexdigest()
            assert ",".join(s for s in r.spans.split(",") if not s.startswith("term")) == wanted
            assert r.n_ip == wanted.count("ip:")


def test_pii_terms_that_disclose(spark):
    told = [(i, f"Agent Falconer number {i} wrote to eve@spy.example about things") for i in range(4)]
    other = [(10 + i, f"nothing about other things here, case {i}") for i in range(200)]
    lone = [(500, "Falconer said nothing else")]
    docs = spark.createDataFrame(told + other, "doc_id long, text string")
    found = pii.sanitise(pii.find(docs)).collect()
    terms = {r.doc_id: {(s.value, s.action) for s in r.pii if s.kind == "term"} for r in found}
    assert {("Falconer", "remove"), ("Agent", "remove"), ("wrote", "remove"), ("number", "remove")} == terms[0]
    assert not terms[10]
    assert "eve@spy" not in next(r for r in found if r.doc_id == 0).clean_text
    # With one more text that has the term alone it reveals nearly all: generalised.
    more = pii.find(docs.union(spark.createDataFrame(lone, docs.schema)), pii.Disclosure(alpha=0.9)).collect()
    assert ("Falconer", "generalise") in {(s.value, s.action) for r in more for s in r.pii}
    # Copies are one text: three rows of the same show nothing.
    same = spark.createDataFrame([(i, told[0][1]) for i in range(5)] + other, "doc_id long, text string")
    assert not any(s.kind == "term" for r in pii.find(same).collect() for s in r.pii)


def test_pii_empty(odd):
    assert pii.digests(odd.limit(0)).count() == 0


def plain_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_rules_base(documents, odd):
    for docs in (documents, odd):
        for r in line_rules.apply_rules(docs).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(r.text or "")
            assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("n", [4094, 4095, 4096, 30_000])
def test_rules_on_texts_of_many_words(spark, n):
    again = " ".join(f"again{i % 3}" for i in range(20))
    text = " ".join(f"w{i}" for i in range(n - 60)) + f"\n{again} x {again} one two three four five six seven eight nine one two three four five end"
    texts = [text, " ".join(f"w{i}" for i in range(n))]
    rows = line_rules.apply_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "*", "'h' as source")).orderBy("doc_id").collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(r.text)
    assert rows[0].n_repeat_words > 40 and rows[1].n_repeat_words == 0


def test_rules_frequent_lines(spark):
    body = "every document has ten words or more of its own number"
    rows = [(i, f"{body} {i}\nShared   Footer 2024 of this host\n", "h") for i in range(40)]
    rows += [(100 + i, "shared footer 1999 of this host\n" * 3 + f"{i}", "h") for i in range(2)]
    rows += [(200, "Shared Footer 2024 of this host, of no use " + body, "g"), (201, "Shared Footer 2024 of this host\n" + body, "g")]
    out = {r.doc_id: r for r in line_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    # Numbers are one digit pattern: bodies 0 to 9 and 10 to 39 are frequent lines as well.
    assert out[201].kept and out[201].n_removed == 0
    assert all(out[i].n_removed >= 6 for i in range(40)) and not out[100].kept
    assert "ooter" not in out[5].clean_text


def test_rules_empty(odd):
    assert line_rules.apply_rules(odd.limit(0)).count() == 0


def test_rules_lines_of_large_hosts(spark):
    def text(i, n):
        shared = [f"this line is on {'x' * n} pages of a host"] if n else []
        return "\n".join([" ".join(chr(97 + i // 26 ** k % 26) * (k + 1) for k in range(12)), *shared])

    rows = [(i, text(i, 90 if i < 90 else 40 if i < 130 else 0), "large") for i in range(2000)]
    rows += [(3000 + i, text(3000 + i, 8 if i < 8 else 20 if i < 28 else 0), "small") for i in range(100)]
    out = {r.doc_id: r.n_removed for r in line_rules.apply_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    # 90 is many anywhere; 40 of 2,000 is neither many nor a large share; 20 of 100 is a large share, 8 are too few.
    assert {i for i, n in out.items() if n} == set(range(90)) | set(range(3008, 3028))


def test_quality_rules_shuffle_no_text(spark):
    plan = line_rules.op10_quality_rules(spark, SF_DIR)._jdf.queryExecution().optimizedPlan()

    def joins(node):
        inner = [node.children().apply(i) for i in range(node.children().size())]
        return [node] * (node.nodeName() == "Join") + [j for child in inner for j in joins(child)]

    found = joins(plan)
    assert found
    for join in found:
        for side in (join.left().output(), join.right().output()):
            kinds = {side.apply(i).name(): side.apply(i).dataType().simpleString() for i in range(side.size())}
            assert not any("string" in kind for kind in kinds.values()), kinds

"""Language id, toxicity and exact top-k search."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from partflow.llm import language_id, topk_mtree, toxicity
from partflow.llm.catalog import op1_language_id, op8_toxicity
from partflow.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def test_profiles_and_distances_match_plain_counting(spark, docs):
    rows = docs.collect()
    model = language_id.learn(docs)
    assert model.languages == ["en"]
    counts = Counter()
    for r in rows:
        if r["lang"] == "en" and r["text"] is not None:
            counts.update(language_id.grams(r["text"]).tolist())
    ranked = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: language_id.PROFILE]]
    assert {int(g): int(r) for g, r in zip(model.grams, model.ranks[:, 0])} == {g: i for i, g in enumerate(ranked)}
    place = {g: i for i, g in enumerate(ranked)}
    for r in language_id.predict(docs, model).collect():
        own = Counter(language_id.grams(r["text"]).tolist())
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        top = [g for g, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))[: language_id.TEXT_PROFILE]]
        far = sum(abs(place[g] - i) if g in place else language_id.PROFILE for i, g in enumerate(top))
        assert math.isclose(r["score"], 1 - far / (language_id.PROFILE * len(top))) and 0 <= r["score"] <= 1
        assert r["lang_pred"] == "en"


def test_grams_keep_letters_only():
    assert language_id.grams("a1 b") .tolist() == language_id.grams(" A, B!").tolist()
    assert len(language_id.grams(None)) == len(language_id.grams("12 !")) <= 1


def test_language_id_without_training_or_rows(docs, empty):
    none = language_id.learn(empty)
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(empty, none).collect() == []


@pytest.mark.parametrize("languages", [1, 3])
def test_language_id_in_blocks_of_languages(docs, languages):
    """As many passes as there are blocks of languages, and the same rows; a language told twice ties with its first name."""
    told = docs.withColumn("lang", F.coalesce("lang", F.lit("fr")))
    twice = told.unionByName(told.withColumn("lang", F.concat(F.lit("z-"), "lang")))
    whole = language_id.learn(twice)
    some = language_id.learn(twice, languages=languages)
    assert whole.rest is None and some.rest is not None and len(some.languages) == languages
    asked = docs.withColumn("score", F.lit("x")).withColumn("far", F.lit(1))
    want, got = language_id.predict(asked, whole), language_id.predict(asked, some)
    assert want.columns == got.columns and "far" in got.columns and language_id.FAR not in got.columns
    assert Counter(tuple(r) for r in want.collect()) == Counter(tuple(r) for r in got.collect())
    assert not any(r["lang_pred"].startswith("z-") for r in got.collect())


def test_language_id_on_held_out_documents(spark):
    truth = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    got = op1_language_id(spark, SF_DIR).join(truth, "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() >= 0.97 * got.count()


def brute_topk(vectors, queries, k):
    out = set()
    for q, x in queries:
        scored = sorted((-int(np.dot(x, y)), i) for i, y in vectors if i != q and len(y) == len(x))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("tree_rows", [16, 4096])
def test_topk(spark, monkeypatch, tree_rows):
    monkeypatch.setattr(topk_mtree, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(topk_mtree, "PAGE_ROWS", 4)
    monkeypatch.setattr(topk_mtree, "BLOCK_QUERIES", 2)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 3, 0.3) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(300, [1000.5] * 6), (301, [-3.25] * 6)]
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [0.5] * 6)]
    rows += [(500, [1.0, 2.0]), (510, [2.0, 1.0]), (520, []), (0, rows[0][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string").repartition(3)
    ready = topk_mtree.quantized(df, "vec_id", "embedding")
    plain = [(r["vec_id"], np.array(r["v"], np.int64)) for r in ready.collect()]
    asked = [(i, v) for i, v in plain if i % 10 == 0 and i != 0] + [(0, next(v for i, v in plain if i == 0))]
    found = topk_mtree.search_topk(ready, ready.filter("vec_id % 10 = 0"), k=10)
    assert Counter(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == Counter(brute_topk_rows(plain, asked, 10))
    assert all((np.floor(np.float64(np.float32(x)) * 1024) == y) for (i, v) in rows[:5] for x, y in zip(v, dict(plain)[i]))


def brute_topk_rows(vectors, queries, k):
    for q, x in queries:
        if len(x):
            scored = sorted((-int(np.dot(x, y)), i) for i, y in vectors if i != q and len(y) == len(x))[:k]
            yield from ((q, n + 1, i, -s) for n, (s, i) in enumerate(scored))


def test_topk_empty(spark):
    none = topk_mtree.quantized(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert topk_mtree.search_topk(none, none).collect() == []


@pytest.mark.parametrize("frequent, long, first", [(512, 64, 8), (3, 8, 1), (0, 1, 2), (5, 10_000, 1)])
def test_block_max_index_is_exact(monkeypatch, frequent, long, first):
    """The same rows as all cosines, with terms in the matrix, in short lists and in blocks; ties by row."""
    monkeypatch.setattr(toxicity, "FREQUENT", frequent)
    monkeypatch.setattr(toxicity, "LONG", long)
    monkeypatch.setattr(toxicity, "FIRST", first)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    rng = random.Random(4)
    vectors = []
    for i in range(700):
        some = range(i // 70 * 3, i // 70 * 3 + 12)
        raw = {t: rng.random() + 0.01 for t in rng.sample(some, rng.randrange(1, 6))}
        norm = sum(x * x for x in raw.values()) ** 0.5
        vectors.append({t: x / norm for t, x in raw.items()} if i % 9 else vectors[i // 2] if vectors else {0: 1.0})
    index = toxicity.Index(vectors, np.arange(700), np.zeros(700, int), np.ones(700), 60)
    for query in [*vectors[::9], {59: 1.0}]:
        sums = [sum(w * v.get(t, 0) for t, w in query.items()) for v in vectors]
        want = sorted((-round(s, 12), r) for r, s in enumerate(sums) if s > 0)[:15]
        found = index.nearest(query, 15)
        assert np.allclose([s for s, _ in found], [-s for s, _ in want], atol=1e-6)
        assert all(abs(sums[r] - s) < 1e-6 for s, r in found) and len({r for _, r in found}) == len(want)


def test_toxicity_equals_plain_votes(spark):
    """Score and evidence worked out from the texts with dictionaries."""
    rng = random.Random(2)
    texts = {i: " ".join(f"{'bad' if i % 4 == 0 and rng.random() < 0.2 else 'term'}{rng.randrange(60)}" for _ in range(rng.randrange(25))) for i in range(160)}
    label = {i: int(i % 4 == 0) for i in range(0, 160) if i % 3}
    split = lambda body: [t for w in re.findall(r"[^\W\d_]+", body.lower()) for t in toxicity._terms(w)]
    texts = {i: re.sub(r"\d+", lambda m: "abcdefghij"[int(m[0]) % 10] * (int(m[0]) // 10 + 1), body) for i, body in texts.items()}
    counts = {i: Counter(split(body)) for i, body in texts.items()}
    size = Counter(label.values())
    seen = {c: Counter(t for i in label if label[i] == c for t in counts[i]) for c in (0, 1)}
    df = Counter(t for c in counts.values() for t in c)
    weigh = {}
    for t in {*seen[0], *seen[1]}:
        held = seen[0][t] + seen[1][t]
        phi = abs(seen[1][t] * size[0] - seen[0][t] * size[1]) / math.sqrt(size[0] * size[1] * held * max(len(label) - held, 1))
        weigh[t] = (math.log((1 + len(texts)) / (1 + df[t])) + 1) * (toxicity.FLOOR + min(phi, 1))

    def vector(i):
        raw = {t: (1 + math.log(n)) * weigh[t] for t, n in counts[i].items() if t in weigh}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()}

    examples = {i: vector(i) for i in label if counts[i]}
    prior = size[1] / len(label)
    bare = [label[i] for i in label if not counts[i]]
    model = toxicity.learn(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame(list(label.items()), "doc_id long, label int"))
    asked = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in toxicity.score(asked, model).collect():
        own = vector(r["doc_id"])
        cosines = {j: round(sum(x * v.get(t, 0) for t, x in own.items()), 12) for j, v in examples.items()}
        best = sorted(((s, j) for j, s in cosines.items() if s > 0), reverse=True)[: toxicity.NEIGHBOURS]
        if not own:
            assert r["evidence"] == [] and r["score"] == pytest.approx((sum(bare) + 0.5 * prior) / (len(bare) + 0.5))
            continue
        assert [e["cosine"] for e in r["evidence"]] == pytest.approx([s for s, _ in best], abs=1e-6)
        assert all(e["cosine"] == pytest.approx(cosines[e["doc_id"]], abs=1e-6) and e["label"] == label[e["doc_id"]] for e in r["evidence"])
        votes = sum(e["cosine"] for e in r["evidence"])
        toxic = sum(e["cosine"] * e["label"] for e in r["evidence"])
        assert r["score"] == pytest.approx((toxic + 0.5 * prior) / (votes + 0.5)) and r["predicted"] == int(r["score"] >= 0.5)


def test_toxicity_learns_and_keeps_rows(spark, docs, empty):
    rng = random.Random(9)
    rows = [(i, " ".join([*(f"word{rng.randrange(300)}" for _ in range(40)), *(["nasty"] if i % 5 == 0 else [])])) for i in range(200)]
    known = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(150)] + [(None, 1), (3, None), (9999, 1)], "doc_id long, label int")
    model = toxicity.learn(known, labels)
    assert toxicity.term_hash("nasty") in model.vocabulary.tolist()
    got = {r["doc_id"]: r for r in toxicity.score(known, model).collect()}
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in range(150, 200))
    assert all(e["cosine"] > 0 and e["label"] == 1 for e in got[155]["evidence"]) and got[155]["evidence"]
    out = toxicity.score(docs, model)
    assert out.count() == docs.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty, model).collect() == []
    unknown = toxicity.learn(known, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, unknown).collect()} == {0.0}
    assert toxicity.learn(empty.select("doc_id", "text"), labels).index is None


def test_toxicity_on_held_out_labels(spark):
    truth = table(spark, SF_DIR, "labels").select("doc_id", "toxic")
    got = op8_toxicity(spark, SF_DIR).join(truth, "doc_id").filter("held_out")
    assert got.filter(F.col("predicted") == F.col("toxic")).count() >= 0.93 * got.count()


def test_toxicity_searches_whole_vectors_of_both_classes(spark):
    """Few and rare words decide: every labelled text is in the index, and every text with a known word has neighbours."""
    rows = [(0, "gut alt haus"), (1, "gut neu haus"), (2, "bös alt haus"), (3, "quux"), (4, "neu quux"), (5, "unheard"), (6, None), (7, "bös")]
    known = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 1)], "doc_id long, label int")
    model = toxicity.learn(known, labels)
    assert sorted(model.index.ids.tolist()) == [0, 1, 2, 3] and set(model.index.labels.tolist()) == {0, 1}
    got = {r["doc_id"]: {e["doc_id"] for e in r["evidence"]} for r in toxicity.score(known, model).collect()}
    assert got == {0: {0, 1, 2}, 1: {0, 1, 2}, 2: {0, 1, 2}, 3: {3}, 4: {1, 3}, 5: set(), 6: set(), 7: {2}}


def test_toxicity_looks_new_words_up_at_once(monkeypatch):
    """Terms and counts as by plain counting, also when kept words go; one search of the vocabulary for all new words and one for their stems."""
    texts = [None, "", "Alpha alphabet alpha be", "alphorn alpin be_be 12 alpha", "ärger äbc unknownword", "be"] * 3
    every = lambda body: [t for w in re.findall(r"[^\W\d_]+", (body or "").lower()) for t in toxicity._terms(w)]
    names = {toxicity.term_hash(t): t for body in texts[:4] for t in every(body)}
    vocabulary = np.array(sorted(names), np.int64)
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 3)
    searches, search = [], np.searchsorted
    monkeypatch.setattr(toxicity.np, "searchsorted", lambda *a, **b: searches.append(1) or search(*a, **b))
    known = toxicity._Terms(vocabulary)
    for some in (texts, texts[3:5], texts[:3]):
        got = [{names[int(vocabulary[t])]: int(n) for t, n in zip(*found)} for found in known.of(some)]
        assert got == [{t: n for t, n in Counter(every(body)).items() if t in names.values()} for body in some]
    assert len(searches) == 6 and len(known.place) <= 5
    assert [len(terms) for terms, _ in toxicity._Terms(vocabulary[:0]).of(texts)] == [0] * len(texts)


def test_toxicity_index_is_narrow():
    """Rows take two bytes as long as they fit."""
    vectors = [{0: 0.6, 1: 0.8}, {1: 1.0}]
    assert toxicity.Index(vectors, np.arange(2), np.zeros(2, int), np.ones(2), 2).row.dtype == np.uint16


def test_toxicity_opens_the_index_by_small_parts(spark, monkeypatch):
    """A worker holds a bounded number of postings besides the index while it opens it."""
    texts = [(i, " ".join(f"word{chr(97 + j % 26)}{chr(97 + i % 7)}" for j in range(i, i + 30))) for i in range(60)]
    model = toxicity.learn(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int"))
    monkeypatch.setattr(toxicity, "PART", 50)
    sizes = [len(term) for term, _, _ in model.index._parts(model.weight)]
    assert max(sizes) <= 50 and sum(sizes) == model.index.held.sum()
    monkeypatch.setattr(toxicity, "PART", 1 << 16)
    whole = model.index.load(model.weight)
    monkeypatch.setattr(toxicity, "PART", 7)
    index = model.index.load(model.weight)
    assert all(np.array_equal(getattr(whole, a), getattr(index, a)) for a in ("matrix", "row", "value", "begin", "top"))

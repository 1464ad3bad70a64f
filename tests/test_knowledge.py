import json
import math
import random
import time
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators import answers, embedding, narrate, profile, reports, retrieve
from partflow.operators.answers import answer_questions, answer_table, context_and_prompt
from partflow.operators import features as ft
from partflow.plans.forecast import run_forecast
from partflow.plans.ingest import run_ingest, summaries
from partflow.plans.knowledge import QuestionService, build_knowledge_base
from partflow.session import materialize, scratch_path
from partflow.sources import sample, tables


@pytest.fixture(scope="module")
def run(spark):
    """Sample data through all phases, with few trees."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "out")
    sample.write_sample(spark, raw)
    ingested = run_ingest(spark, raw, out)
    forecast = run_forecast(ingested.valid, out, ties=("store_id",), trees=3, depth=3)
    chunks = build_knowledge_base(forecast, out, ties=("store_id",))
    return ingested, forecast, chunks, out


def test_sample_tables(spark, run):
    sales = sample.sample_sales(spark)
    assert sales.count() == 8 * 6 * 30 and sample.sample_prices(spark).count() == 8 * 6 * 5
    means = {r["cat_id"]: r["m"] for r in sales.groupBy("cat_id").agg(F.avg("sales").alias("m")).collect()}
    assert 4.5 < means["HOBBIES"] < 6.2 and 11.5 < means["HOUSEHOLD"] < 14.5
    assert sales.exceptAll(sample.sample_sales(spark).repartition(7)).count() == 0
    first = sample.sample_calendar(spark).orderBy("date").first()
    assert (first["wm_yr_wk"], first["weekday"], first["wday"], first["snap_CA"]) == (11101, "Thursday", 4, 1)


def test_missing_file_is_named(spark):
    with pytest.raises(FileNotFoundError, match="sales"):
        tables.load_raw(spark, "/nowhere")


def test_ingest_invariants(spark, run):
    ingested, _, _, out = run
    total, valid, rejected, rate, _ = ingested.report.first()
    assert (total, valid, rejected, rate) == (1440, 1440, 0, 100.0)
    stored = spark.read.parquet(f"{out}/validated")
    assert stored.count() == 1440
    assert {r[0] for r in stored.select("region").distinct().collect()} <= set(fv.REGIONS)
    assert stored.filter("demand_quantity < 0 or part_number is null or unit_cost <= 0").count() == 0
    assert summaries(ingested.mapped)["dataset"].first()["unique_parts"] == 8


def test_forecast_tables(spark, run):
    _, forecast, _, out = run
    assert forecast.features.count() == 8 * 179
    assert {r["model"] for r in forecast.metrics.collect()} == {fv.BOOSTED_NAME, fv.SEASONAL_NAME, fv.NAIVE_NAME}
    assert forecast.part_metrics.count() == 8
    assert spark.read.parquet(f"{out}/predictions").count() == 3 * (1432 - int(1432 * 0.8))


def test_chunk_counts(run):
    _, _, chunks, _ = run
    counts = {r["source"]: r["n_chunks"] for r in narrate.chunk_counts(chunks).collect()}
    assert counts == {"part_profile": 8, "model_summary": 1, "domain_knowledge": 4}


def test_chunk_json(spark, run):
    _, _, chunks, out = run
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{out}/knowledge_base").collect()]
    by_id = {x["id"]: x for x in lines}
    part = by_id["part_AMAT-RF-7800-GEN"]
    assert list(part["metadata"]) == ["part_number", "demand_type", "region", "avg_demand", "trend", "stockout_risk", "source"]
    assert isinstance(part["metadata"]["avg_demand"], float)
    assert part["text"].startswith("Part AMAT-RF-7800-GEN is a NPI-type semiconductor component primarily serving the North America region.\n\n")
    assert len(part["text"].split("\n\n")) == 7
    assert tables.read_chunks(spark, f"{out}/knowledge_base").count() == 13
    assert "importance)" in by_id["model_comparison_summary"]["text"]


def test_profile_rules(spark):
    rows = [(10.0, 5.1, "stable", None), (10.0, 3.1, "increasing", 50.1), (10.0, 3.0, "increasing", 50.0), (0.0, 3.0, "increasing", None)]
    df = spark.createDataFrame(rows, "avg_demand double, std_demand double, trend string, mape double")
    df = df.withColumn("volatility", profile.volatility()).withColumn("risk", profile.stockout_risk())
    got = [(r["volatility"].split()[0], r["risk"]) for r in df.collect()]
    assert got == [
        ("high", fv.RISK_MODERATE_VOLATILE), ("moderate", fv.RISK_HIGH), ("low", fv.RISK_MODERATE_TREND), ("low", fv.RISK_MODERATE_TREND),
    ]


def test_trend_needs_fourteen_rows(series):
    rows = {r["part_number"]: r for r in profile.demand_trend(series, ("tie",)).collect()}
    assert rows["C"]["trend"] == fv.TREND_SHORT and rows["C"]["trend_pct"] == 0
    q = [r["demand_quantity"] for r in series.filter("part_number = 'A'").orderBy("tie").collect()]
    change = (sum(q[-7:]) - sum(q[-14:-7])) / sum(q[-14:-7]) * 100
    assert rows["A"]["trend_pct"] == pytest.approx(round(change, 1))


def test_statistics_agree_with_pandas(series):
    rows = ft.build_features(series, ("tie",))
    pdf = rows.toPandas()
    for r in profile.part_statistics(rows, ("tie",)).collect():
        p = pdf[pdf["part_number"] == r["part_number"]]
        assert r["avg_demand"] == round(p["demand_quantity"].mean(), 1)
        assert r["std_demand"] == round(p["demand_quantity"].std(), 1)
        assert r["region"] == p["region"].mode().iloc[0]
        assert r["rolling_std_7"] == round(p["rolling_std_7"].mean(), 1)
        assert (r["n_days"], r["npi_days"]) == (len(p), p["has_npi_signal"].sum())


# Retrieval against brute force


def brute_force(chunks, question, k):
    words = set(question.lower().split()) - set(fv.STOP_WORDS)
    if not words:
        return [c["id"] for c in chunks[:k]]
    scored = []
    for c in chunks:
        body = c["text"].lower() + " " + c["metadata_json"].lower()
        points = sum(w in body for w in words) + (3 if question.lower() in body else 0)
        points += sum(2 for w in words for v in c["string_values"] if w in v.lower())
        scored.append((c["id"], points / len(words)))
    return [i for i, _ in sorted(scored, key=lambda s: -s[1])[:k]]


QUESTIONS = [*fv.SAMPLE_QUESTIONS, "the of and", "", 'risk? "npi', "é \t a  NPI", "Safety stock"]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_keyword_search_agrees_with_brute_force(run, k):
    chunks = run[2]
    ordered = chunks.orderBy("kind", "seq").collect()
    hits = retrieve.keyword_search(chunks, QUESTIONS, k).orderBy("qid", "rank").collect()
    for i, question in enumerate(QUESTIONS):
        assert [h["id"] for h in hits if h["qid"] == i] == brute_force(ordered, question, k), question


def test_more_questions_than_one_pass(run):
    asked = [f"question {i} about NPI" for i in range(retrieve.PASS_SIZE + 3)]
    assert retrieve.keyword_search(run[2], asked, 1).count() == len(asked)


def test_top_k_bounds(run):
    for k in (0, 11):
        with pytest.raises(ValueError):
            QuestionService(run[2]).query(["x"], k)
    assert retrieve.keyword_search(run[2], ["x"], 11).count() == min(11, run[2].count())


def test_questions_without_hits_and_tables_of_questions(spark, run):
    nothing = run[2].filter("false")
    assert [r["answer"] for r in answer_questions(nothing, ["trend of parts"]).collect()] == [fv.ANSWER_EMPTY]
    assert [r["context"] for r in context_and_prompt(nothing, ["a", "b"]).collect()] == ["", ""]
    asked = spark.createDataFrame([(7, "risk?"), (8, None), (9, "hello there")], "n int, q string")
    got = {r["n"]: r for r in answer_table(run[2], asked, "q").collect()}
    assert sorted(got) == [7, 8, 9] and got[8]["question"] == "" and all(r["answer"] for r in got.values())
    assert answer_table(run[2], asked.limit(0), "q").collect() == []


def test_tables_of_more_questions_than_a_request(spark, run):
    chunks = run[2].limit(6)
    asked = spark.range(10_050).select("id", F.concat(F.lit("trend of part "), (F.col("id") % 7).cast("string")).alias("q"))
    got = answer_table(chunks, asked, "q")
    assert got.count() == 10_050 and got.select("id").distinct().count() == 10_050
    want = {r["question"]: (r["answer"], r["sources"]) for r in answer_questions(chunks, [f"trend of part {i}" for i in range(7)]).collect()}
    assert {r["question"]: (r["answer"], r["sources"]) for r in got.dropDuplicates(["question"]).collect()} == want


def test_terms_and_intents(spark):
    texts = ["What IS the risk? risk?", "compare vs", "forecast the risk", "should we act", "growing", "hello there"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", retrieve.query_terms(F.col("t")).alias("w"), retrieve.question_intent(F.col("t")).alias("n")).orderBy("i").collect()
    assert rows[0]["w"] == ["risk?"] and rows[5]["w"] == ["hello", "there"]
    assert [r["n"] for r in rows] == ["risk", "compare", "risk", "recommend", "trend", "general"]


def test_vector_search_agrees_with_brute_force(spark):
    rows = [(i, [float((i * 7 + j * 3) % 11) for j in range(4)], i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, embedding array<float>, label int")
    asked = [[1.0, 2.0, 3.0, 4.0], [0.0] * 4]
    for where in (None, F.col("label") == 1):
        hits = retrieve.vector_search(df, asked, 3, where=where).orderBy("qid", "rank").collect()
        for i, v in enumerate(asked):
            pool = [(sum((a - b) ** 2 for a, b in zip(e, v)), n) for n, e, label in rows if where is None or label == 1]
            assert [(h["distance"], h["id"]) for h in hits if h["qid"] == i] == sorted(pool)[:3]


# Answers


def hand_chunks(spark):
    def part(name, risk, trend):
        meta = {"part_number": name, "demand_type": "NPI", "trend": trend, "stockout_risk": risk, "source": "part_profile"}
        return ("part_" + name, f"Part {name} is here.\n\nRecent trend: {trend}.\n\nForecast accuracy: MAE 1.\n\nRecommendation: Increase.", "part_profile", meta)

    rows = [part("A", "HIGH", "increasing"), part("B", "LOW", "stable"), ("m", "Models: XGBoost wins", "model_summary", {"source": "model_summary"})]
    return [(0, q, n + 1, *r) for q in ("ask",) for n, r in enumerate(rows)]


def answer_for(spark, question):
    schema = "qid int, question string, rank int, id string, text string, source string, metadata map<string,string>"
    rows = [(i, question, *r[2:]) for i, r in enumerate(hand_chunks(spark))]
    df = spark.createDataFrame([(0, *r[1:]) for r in rows], schema)
    return answers.group_hits(df).select(answers.answer_text(F.col("question"), F.col("hits"))).first()[0]


@pytest.mark.parametrize(
    "question, expected",
    [
        (
            "any risk",
            "Based on the supply chain data analysis:\n\nHIGH RISK parts (immediate attention needed):\n  - A (NPI, trend: increasing)\n\n"
            "LOW RISK parts (stable):\n  - B (NPI, trend: stable)\n\nDetails:\n  Recent trend: increasing.\n  Recommendation: Increase.\n"
            "  Recent trend: stable.\n  Recommendation: Increase.\n",
        ),
        (
            "predict it",
            "Forecast performance summary:\n\n  Forecast accuracy: MAE 1.\n  Forecast accuracy: MAE 1.\nModels: XGBoost wins\n\n",
        ),
        (
            "difference",
            "Comparison based on available data:\n\n--- A (NPI) ---\n  Recent trend: increasing.\n  Forecast accuracy: MAE 1.\n  Recommendation: Increase.\n\n"
            "--- B (NPI) ---\n  Recent trend: stable.\n  Forecast accuracy: MAE 1.\n  Recommendation: Increase.\n\n",
        ),
        ("what should we do", "Recommendations based on analysis:\n\n  Recommendation: Increase.\n  Recommendation: Increase.\n"),
        ("growing", "Demand trends:\n\nA:\n  Recent trend: increasing.\n\nB:\n  Recent trend: stable.\n\n"),
    ],
)
def test_answers(spark, question, expected):
    assert answer_for(spark, question) == expected


def test_general_answer_cuts_texts(spark):
    got = answer_for(spark, "hello")
    assert got.startswith("Here's what I found relevant to your question:\n\n--- A ---\nPart A is here.")
    assert got.endswith("Models: XGBoost wins\n\n")


def test_question_service(run):
    chunks = run[2]
    for vectors in (False, True):
        rows = QuestionService(chunks, vectors).query(fv.SAMPLE_QUESTIONS).orderBy("qid").collect()
        assert [r["question"] for r in rows] == list(fv.SAMPLE_QUESTIONS)
        assert all(r["num_sources"] == 3 and len(r["sources"]) == 3 for r in rows)


def test_empty_knowledge_base(run):
    rows = answers.answer_questions(run[2].limit(0), ["any risk"]).collect()
    assert [(r["answer"], r["num_sources"]) for r in rows] == [(fv.ANSWER_EMPTY, 0)]


def test_prompt(run):
    row = answers.context_and_prompt(run[2], ["Safety stock"], 2).first()
    assert row["context"].count(fv.CONTEXT_RULE) == 1
    assert row["prompt"] == fv.PROMPT_TEMPLATE.replace("{context}", row["context"]).replace("{question}", "Safety stock")


def test_reports(run):
    ingested, forecast, chunks, _ = run
    assert reports.list_parts(chunks).count() == 8
    assert reports.list_parts(chunks, "NPI").count() == 3
    assert sum(r["n_parts"] for r in reports.risk_buckets(chunks).collect()) == 8
    assert [r[0] for r in reports.distinct_types(chunks).collect()] == sorted(fv.DEMAND_TYPES)
    card = reports.kpi_cards(chunks, forecast.metrics).first()
    assert card["total_parts"] == 8 and card["best_mae"] == min(r["mae"] for r in forecast.metrics.collect())
    assert reports.demand_by_type(forecast.features).count() == 4


def test_sales_header_decides(spark):
    path = scratch_path(spark, "odd-sales")
    spark.createDataFrame([("3.7", "i", "202401", "z"), ("x", "j", "202402", "z")], "sales string, item_id string, wm_yr_wk string, extra string").write.option("header", True).csv(path)
    df = tables.read_sales(spark, path)
    assert df.columns == ["sales", "item_id", "wm_yr_wk", "extra"]
    assert sorted(((r["sales"], r["wm_yr_wk"]) for r in df.collect()), key=str) == [(3, 202401), (None, 202402)]


def test_embedded_search_agrees_with_plain_cosines(spark, run):
    chunks = run[2].select("id", "text")
    odd = spark.createDataFrame([("x1", None), ("x2", ""), ("x3", "--"), ("x4", "Ärger ärger zwölf"), ("x5", "ärger")], "id string, text string")
    chunks = chunks.unionByName(odd)
    texts = {r["id"]: r["text"] for r in chunks.collect()}

    def split(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    often = Counter(t for text in texts.values() for t in set(split(text)))
    numbers = {t: i for i, t in enumerate(sorted(often))}

    def vector(text):
        raw = {t: n * math.log((len(texts) + 1) / (often[t] + 1)) for t, n in Counter(split(text)).items() if t in often and often[t] < len(texts)}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()}

    embedder = embedding.text_embedder(chunks)
    embedded = embedding.embed(chunks, embedder)
    for r in embedded.collect():
        want = sorted((numbers[t], w) for t, w in vector(r["text"]).items())
        assert [p["term"] for p in r["embedding"]] == [n for n, _ in want]
        assert all(math.isclose(p["weight"], w, rel_tol=1e-9) for p, (_, w) in zip(r["embedding"], want))
    asked = [*fv.SAMPLE_QUESTIONS, "ärger", "", "nothing9"]
    hits = embedding.cosine_search(embedded, embedding.embed_questions(asked, embedder), 3).collect()
    for i, q in enumerate(asked):
        own = vector(q)
        best = sorted((-round(sum(w * vector(t).get(k, 0) for k, w in own.items()), 9), key) for key, t in texts.items() if set(own) & set(vector(t)))[:3]
        found = sorted((h["rank"], h["id"], h["cosine"]) for h in hits if h["qid"] == i)
        assert [h[2] for h in found] == pytest.approx([-c for c, _ in best]) and [h[0] for h in found] == list(range(1, len(best) + 1))
    assert {h["id"] for h in hits if h["qid"] == len(fv.SAMPLE_QUESTIONS)} == {"x4", "x5"}
    none = embedding.text_embedder(chunks.limit(0))
    assert embedding.embed(chunks.limit(0), none).collect() == []


def test_vector_search_leaves_few_rows_a_block(spark, monkeypatch):
    """Blocks of two vectors; null, short and incomplete vectors are no hits; ties go to the smaller key."""
    monkeypatch.setattr(retrieve, "SCORED", 2)
    rows = [(i, [float(i % 3), 1.0]) for i in range(20)] + [(30, None), (31, [1.0]), (32, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(3)
    found = retrieve.vector_search(df, [[0.0, 1.0], [9.0]], 4).collect()
    assert [(r["qid"], r["rank"], r["id"], r["distance"]) for r in sorted(found)] == [(0, k + 1, 3 * k, 0.0) for k in range(4)] + [(1, 1, 31, 64.0)]


def test_empty_request(run):
    with pytest.raises(ValueError):
        retrieve.keyword_search(run[2], [])


def _chunk_table(spark, rows):
    schema = "id string, kind int, seq int, text string, metadata_json string, string_values array<string>"
    return spark.createDataFrame(rows, schema).repartition(3)


def test_index_search_agrees_with_scoring_every_pair(spark, monkeypatch):
    """Substrings, phrases, values, ties, classes of one and of many chunks, questions without terms or hits."""
    from partflow.operators import postings

    rng = random.Random(11)
    names = ["alpha", "beta", "Gamma-7", "delta", "überzug", "x", "in", "overstock", "stockout", "risk", "N/A", "42"]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(names) + rng.choice(["", "", ",", str(i % 5)]) for _ in range(rng.randrange(0, 9)))
        values = [rng.choice(names) + " " + rng.choice(names) for _ in range(rng.randrange(0, 3))]
        rows.append((f"c{i:03}", i % 3, i, text + rng.choice(["", " demand part", "\tdemand\npart"]), '{"k": "%s"}' % rng.choice(names), values))
    rows += [("n1", 0, 500, None, "{}", ["alpha"]), ("n2", 0, 501, "alpha", "{}", None), ("e", 0, 502, "", "", [])]
    chunks = _chunk_table(spark, rows)
    asked = ["alpha", "stock", "out risk", "demand part", "a", "", "the of", "  Gamma-7   beta ", "zzz", "in x", "ÜBER delta N/A", "alpha alpha beta 42 risk demand", "mand\tpart"]
    table = spark.createDataFrame([(q,) for q in asked], "question string")
    want = {(asked[r["qid"]], r["rank"], r["id"], round(r["score"], 9)) for r in retrieve.keyword_search(chunks, asked, 4).collect()}
    for share in (1, 4, 10_000):
        monkeypatch.setattr(postings, "COMMON", share)
        found = retrieve.keyword_search_table(chunks, table, 4)
        assert {(r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in found.collect()} == want
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert retrieve.keyword_search_table(chunks.limit(0), table).collect() == []
    assert retrieve.keyword_search_table(chunks, table.limit(0)).collect() == []


def test_a_term_in_a_word_of_every_chunk_pairs_no_chunks(spark):
    """Every chunk has an item word of its own, so "tem" is in as many words as chunks; questions met each of them."""
    from partflow.operators import postings

    chunks = _chunk_table(spark, [(f"c{i:03}", 0, i, f"item_{i} {'blue' if i % 2 else 'red'}", "{}", [f"item_{i}"]) for i in range(300)])
    asked = ["tem", "tem blue", "item_7 red", "red em", "m_299 tem"]
    table = spark.createDataFrame([(q,) for q in asked], "question string")
    want = {(asked[r["qid"]], r["rank"], r["id"], round(r["score"], 9)) for r in retrieve.keyword_search(chunks, asked, 3).collect()}
    assert {(r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in retrieve.keyword_search_table(chunks, table, 3).collect()} == want
    numbered = spark.createDataFrame([(i, q, q.split()) for i, q in enumerate(asked)], "qid int, phrase string, terms array<string>")
    pairs = postings.question_points(postings.chunk_index(chunks), chunks, numbered, 3).select("qid", "id").distinct()
    per = {r["qid"]: r["n"] for r in pairs.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per[2] < 200 and per[4] < 50


def test_questions_and_chunks_are_never_sent_whole(spark, monkeypatch):
    from partflow.operators import postings

    # Small packed files may hold many rows, so no join of the index goes by the size of its files.
    rows = [(f"c{i}", f"part {i} word{i % 3}", "{}", [f"v{i % 2}"], 0, i, "s", {"part_number": str(i)}) for i in range(20)]
    schema = "id string, text string, metadata_json string, string_values array<string>, kind int, seq int, source string, metadata map<string,string>"
    chunks = spark.createDataFrame(rows, schema)
    path = scratch_path(spark, "few-chunks")
    chunks.write.parquet(path)
    asked = spark.createDataFrame([(i, f"word{i % 4} of part {i}") for i in range(30)], "n int, q string")
    plans = []

    def noted(df, name, partition=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, name, partition)

    for module in (postings, retrieve):
        monkeypatch.setattr(module, "materialize", noted)
    answers = answer_table(spark.read.parquet(path), asked, "q")
    plans.append(answers._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not [p for p in plans if "BroadcastExchange" in p]
    assert answers.count() == 30


def test_embedding_of_a_text_of_many_terms(spark):
    # A length summed up anew for each of its terms would take 10**10 steps.
    names = [f"t{i}" for i in range(100_000)]
    df = spark.createDataFrame([("a", " ".join(names)), ("b", "t0"), ("c", None)], "id string, text string")
    start = time.monotonic()
    got = {r["id"]: r["embedding"] for r in embedding.embed(df, embedding.text_embedder(df)).collect()}
    assert time.monotonic() - start < 120
    assert len(got["a"]) == 100_000 and len(got["b"]) == 1 and got["c"] == []
    assert math.isclose(sum(p["weight"] ** 2 for p in got["a"]), 1.0, rel_tol=1e-9)


def test_common_and_rare_terms_meet_apart(spark, monkeypatch):
    texts = [f"all{' half' * (i % 2)} own{i}{' twice' * (2 if i == 3 else 0)}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = []
    for share in (1, 4, 1_000):
        monkeypatch.setattr(embedding, "COMMON", share)
        rows = embedding.embed(df, embedding.text_embedder(df))
        found.append({r["id"]: [tuple(p) for p in r["embedding"]] for r in rows.collect()})
    assert found[0] == found[1] == found[2] and [len(found[0][i]) for i in (2, 3)] == [1, 3]

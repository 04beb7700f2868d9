import math
import re
from collections import Counter, defaultdict

import pytest

from starloom.llm import mixing as M
from tests.llm.conftest import DOC_SCHEMA


@pytest.fixture(scope="module")
def docs(spark, words):
    rows = []
    for i in range(1200):
        source = ["big", "big", "big", "mid", "small", None][min(5, i % 9)] if i % 9 < 6 else "big"
        rows.append((i, " ".join(words[i % 50:i % 50 + 1 + i % 23]), "en", source, i))
    rows += [(5000 + i, t, "en", "empty", 0) for i, t in enumerate([None, "", " \n"])]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def totals_of(docs):
    return M.source_totals(docs.select("source", M.words("text").alias("tokens")))


def test_words(spark, odd_texts):
    df = spark.createDataFrame([(t,) for t in odd_texts], "text string").select("text", M.words("text").alias("n"))
    for r in df.collect():
        assert r["n"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))


def test_power_for_a_repetition_limit(docs):
    totals = {r["source"]: r["total"] for r in totals_of(docs).collect()}
    found = M.find_power(totals_of(docs), max_epochs=3.0)
    has = [t for t in totals.values() if t]
    ratio = (min(has) / max(has)) ** (found.power - 1)
    assert 0 < found.power < 1 and ratio == pytest.approx(3.0, abs=1e-6)
    assert M.find_power(totals_of(docs), max_epochs=1e9).power == pytest.approx(0, abs=1e-9)
    assert M.find_power(totals_of(docs), max_epochs=1.0).power == pytest.approx(1)


def test_power_for_an_entropy(docs):
    totals = [r["total"] for r in totals_of(docs).collect() if r["total"]]
    found = M.find_power(totals_of(docs), target_entropy=0.97)
    w = [(t / sum(totals)) ** found.power for t in totals]
    w = [x / sum(w) for x in w]
    assert -sum(x * math.log(x) for x in w) / math.log(len(w)) == pytest.approx(0.97, abs=1e-6)


@pytest.mark.parametrize("bad", [{}, {"max_epochs": 2.0, "target_entropy": 0.5}, {"max_epochs": 0.5}])
def test_wrong_targets(docs, bad):
    with pytest.raises(ValueError):
        M.find_power(totals_of(docs), **bad)


def test_draws_fill_the_quotas(docs, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TOKENS", 300)
    rows = M.draws(docs, max_epochs=2.5).collect()
    plan = {r["source"]: r for r in M.quotas(
        totals_of(docs), M.find_power(totals_of(docs), max_epochs=2.5)).collect()}
    tokens, times = defaultdict(int), Counter()
    for r in rows:
        tokens[r["source"]] += r["tokens"]
        times[r["id"]] += 1
    assert set(times) == {r["doc_id"] for r in docs.collect()}  # all are read
    for source, p in plan.items():
        assert p["rounds"] >= 1
        assert tokens[source] <= max(p["quota"], 0) and p["quota"] - tokens[source] < 200
    assert max(times.values()) <= 3
    assert len({r["block"] for r in rows if r["source"] == "big"}) > 5
    # a whole permutation is complete before the next one begins
    for source in plan:
        own = sorted((r for r in rows if r["source"] == source and r["tokens"]), key=lambda r: r["position"])
        assert [r["epoch"] for r in own] == sorted(r["epoch"] for r in own)
        places = [r["position"] for r in own]
        assert all(0 <= p < 1 for p in places) and len(set(places)) == len(places)


def test_the_order_differs_between_epochs(docs):
    rows = [r for r in M.draws(docs, max_epochs=4).collect() if r["source"] == "small"]
    orders = [[r["id"] for r in sorted(rows, key=lambda r: r["position"]) if r["epoch"] == e] for e in (0, 1)]
    assert sorted(orders[0]) == sorted(orders[1]) and orders[0] != orders[1]


def test_mix_returns_whole_rows(docs):
    clash = docs.selectExpr("*", "1 AS position", "2 AS epoch", "3 AS tokens", "4 AS total")
    out = M.mix(clash, max_epochs=2.0)
    assert out.columns == clash.columns
    a, b = Counter(r["doc_id"] for r in out.collect()), Counter(
        r["id"] for r in M.draws(docs, max_epochs=2.0).collect())
    assert set(a) == set(b) and sum(a.values()) == sum(b.values())


def test_one_source_empty_table_and_repeated_rows(spark, docs):
    one = docs.filter("source = 'mid'")
    assert M.mix(one, max_epochs=3.0).count() == one.count()
    assert M.mix(docs.limit(0), max_epochs=3.0).count() == 0
    twice = one.unionAll(one)
    assert M.mix(twice, target_entropy=0.9).count() == 2 * one.count()


def test_no_python_in_the_plan(docs):
    plan = M.draws(docs, max_epochs=2.0)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_without_words_or_ids_are_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TOKENS", 50)
    rows = [(None, None, "en", "hot", 0)] * 1000 + [(i, "a b", "en", "s", 0) for i in range(100)]
    drawn = M.draws(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4), max_epochs=2.0).filter("source = 'hot'")
    sizes = [r["count"] for r in drawn.groupBy("block").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) > 12 and max(sizes) < 150

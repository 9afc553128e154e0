from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cases import DATA, EDGE_TEXTS, alnum_words, frame, some_texts, with_clashes
from salestrata.llm import decontaminate


def brute(texts, items):
    windows = {}
    for item, text in items:
        words = alnum_words(text)
        for i in range(max(len(words) - 9, 1) if words else 0):
            windows.setdefault(tuple(words[i:i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    for text in texts:
        words = alnum_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                who = windows.get(tuple(words[i:i + n]))
                if who:
                    hit.update(range(i, i + n))
                    found |= who
        yield len(words), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.fixture(scope="module")
def case(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/benchmark.parquet").collect()]
    long = items[0][1]
    items += [(900, "short item"), (901, "Three Words, here"), (902, None), (903, ""), (904, "one"), (904, "one"),
              (None, "no id at all"), (905, "the the the the the the the the the the the the"), (906, long),
              (907, "a b c d e f"), (908, "été 中文")]
    texts = EDGE_TEXTS + some_texts(spark) + [
        "x " + long, long.upper(), " ".join(long.split()[:12]), "before SHORT---item after one", "no id at all",
        "the " * 40, "a b c d e", "z a b c d e f a b c d e f", "été 中文 ONE", "three words", "here three words here"]
    return texts, items


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 300])
def test_hits_equal_brute_force(spark, case, block):
    texts, items = case
    docs = with_clashes(frame(spark, texts), ["items", "spans", "document", "n_words"])
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit("w"))
    found = decontaminate.hits(docs, benchmark, ["doc_id"], block=block).select("document.doc_id", "n_words", "spans", "items").collect()
    assert len(found) == len(texts)
    wanted = list(brute(texts, items))
    assert sum(n > 0 for _, n, _ in wanted) > 10
    for r in found:
        n_hit = sum(s.end - s.first for s in r.spans)
        assert (r.n_words, n_hit, sorted(r["items"])) == wanted[r.doc_id], repr(texts[r.doc_id])


def test_keep_clean(spark, case):
    texts, items = case
    docs = with_clashes(frame(spark, texts), ["items", "spans"])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, n, _) in enumerate(brute(texts, items)) if not n}


def test_empty_tables(spark, case):
    texts, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, texts)
    assert decontaminate.decontaminate(docs.limit(0), benchmark).collect() == []
    for none in (benchmark.limit(0), benchmark.where("text is null or text = ''")):
        found = decontaminate.decontaminate(docs, none).collect()
        assert len(found) == len(texts)
        assert not any(r.n_hit or r.contaminated or r.n_items for r in found)
        assert all(r.n_words == len(alnum_words(texts[r.doc_id])) for r in found)


def test_a_worker_holds_one_block_at_a_time(spark, case, monkeypatch):
    texts, items = case
    docs = frame(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = decontaminate.benchmark_windows(benchmark).count()
    plans = []
    matched = decontaminate._matched

    def noted(rows, document, index):
        found = matched(rows, document, index)
        plans.append(found._jdf.queryExecution().toString().split("== Physical Plan ==")[1])
        return found
    monkeypatch.setattr(decontaminate, "_matched", noted)
    found = decontaminate.hits(docs, benchmark, ["doc_id"], block=-(-windows // 20))
    assert len(plans) >= 20 and all(plan.count("MapInArrow") == 1 for plan in plans)
    one = decontaminate.hits(docs, benchmark, ["doc_id"])
    columns = ["document.doc_id", "n_words", "spans", F.array_sort("items").alias("items")]
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, one.select(*columns).collect()))


def test_shingles_are_counted_in_any_number_of_passes(spark, case):
    texts, items = case
    docs = frame(spark, texts)
    windows = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"))
    one, many = (sorted(map(tuple, decontaminate.shingle_counts(windows, docs, n).collect())) for n in (1 << 22, 40))
    assert one == many and len(one) > 100

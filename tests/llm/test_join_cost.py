"""What the similarity join holds, sends and compares."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerloom.llm import components, jaccard_join
from ledgerloom.llm.jaccard_join import _describe, _first_keys, _word_hashes, shingle_sets


def test_words_are_told_apart_as_a_pattern_does():
    draw = random.Random(3)
    letters = "aAbB\x0b\x0c\t\n\r\x1c\x1d\x85\xa0 é \x00"
    texts = ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(400)]
    texts += ["x" * 64, "x" * 65, "x" * 64 + "y", "x" * 64 + "z", " " * 9, "y" * 70_000 + " b", "ab ba", "b a"]
    seen: dict[bytes, int] = {}
    for text in texts:
        data = text.encode().lower()
        words = re.findall(rb"[^\x20\x09-\x0d]+", data)
        hashes = _word_hashes(data).tolist()
        assert len(hashes) == len(words)
        for word, h in zip(words, hashes, strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_parts():
    words = [f"w{k}" * (1 + k % 40) for k in range(120_001)]
    whole = _word_hashes(" ".join(words).encode())
    assert whole[[0, 49_999, 50_000, 100_000, 120_000]].tolist() == [
        int(_word_hashes(words[k].encode())[0]) for k in (0, 49_999, 50_000, 100_000, 120_000)
    ]


def test_sets_follow_order_and_distinct_shingles():
    of = shingle_sets()
    assert len(of("a b c d e")) == 1 and len(of("a b c d e f")) == 2
    assert of("a b c d e").tolist() == of("A\tB  c\nD E ").tolist() != of("b a c d e").tolist()
    assert of("a b").tolist() != of("b a").tolist() and len(of(" ")) == len(of(None)) == 0
    assert len(of("a " * 900)) == 1


def test_a_task_holds_the_tokens_of_a_block_once(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 400_000)
    draw = random.Random(5)
    shared = " ".join(f"s{k}" for k in range(30))
    texts = [f"{shared} " + " ".join(f"{draw.getrandbits(40):x}" for _ in range(4000)) for _ in range(110)]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "hash": range(len(texts)), "text": texts})
    batches = [frame.iloc[k : k + 1] for k in range(len(frame))]
    list(_describe(1 / 1000)(iter(batches[:1])))
    tracemalloc.start()
    found = pd.concat(_describe(1 / 1000)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    often = found[found["kind"] == 1].groupby("id")["n"].sum()
    assert len(often) == 26 and set(often) == {110}
    assert peak < 3.3 * 400_000 * 8  # the block, its tokens in one array, bitmaps of all texts


def test_frequent_tokens_are_counted_as_by_unique():
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in draw.integers(0, 3, 40)) for _ in range(200)]
    frame = pd.DataFrame({"doc_id": range(200), "hash": range(200), "text": texts})
    found = pd.concat(_describe(0.25)(iter([frame])))
    found = found[found["kind"] == 1]
    of = shingle_sets()
    tokens, counts = np.unique(np.concatenate([of(t) for t in set(texts)]), return_counts=True)
    often = counts >= max(3, 0.125 * len(set(texts)))
    assert often.any()
    assert found["id"].tolist() == tokens[often].view(np.int64).tolist() and found["n"].tolist() == counts[often].tolist()


def test_likest_partners_are_sought_among_few_keys(spark):
    rows = spark.range(600).select(
        F.explode(F.sequence(F.lit(1), F.lit(90))).alias("key"),
        F.col("id").alias("sid"),
        F.lit(146).alias("size"),
        F.col("id").alias("of"),
        F.lit(1).alias("times"),
        F.lit(600).alias("in_key"),
    )
    found = _first_keys(rows).toPandas()
    assert len(found) == 600 * jaccard_join.FIRST_KEYS and found["key"].nunique() == jaccard_join.FIRST_KEYS
    assert set(found["in_key"]) == {600} and set(found.columns) == set(rows.columns)


def test_few_links_are_written_by_few_tasks(spark, monkeypatch):
    written = []
    stored = components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: written.append(df.rdd.getNumPartitions()) or stored(df, name))
    set_to = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in set_to}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        links = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
        found = components.connected_components(links).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(found) == [(k, 0) for k in range(300)]
    assert len(written) > 5 and max(written[1:]) <= 2

"""The registered corpus queries over whole test tables, against SQL or brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute_force as plain
import corpus_pipeline
from compare import differences
from freshet.llm import catalog
from freshet.llm.staging import handing_back

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return {r["doc_id"]: r for r in rows}


def run(spark, number):
    name = next(n for n in catalog.QUERIES if n.startswith(f"op{number}_"))
    return catalog.QUERIES[name](spark, SF).collect()


@pytest.fixture(scope="module")
def library():
    """The tokenizers library over whole texts."""
    from tokenizers import Tokenizer

    def load(name):
        tokenizer = Tokenizer.from_file(catalog.vocabulary_file(name))
        tokenizer.encode_special_tokens = True
        return lambda text, end: [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]

    return load


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_query_equals_sql(spark, name):
    assert differences(spark, name, "0.001") == []


def test_every_number_has_one_query():
    numbers = Counter(re.match(r"op(\d+)_", name)[1] for name in catalog.QUERIES)
    assert numbers == Counter(map(str, range(1, 14)))


def test_packing_places_every_token_once(spark, docs, library):
    encode = library("word_bpe_49k.json")
    ids = {i: encode(r["text"], 1) for i, r in docs.items()}
    rows = run(spark, 1)
    cut, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 4096 * r["piece"] and len(piece) == r["length"]
        assert r["ids_crc32"] == plain.crc32(piece)
        cut[r["doc_id"]].append(r["length"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: sum(lengths) for i, lengths in cut.items()} == {i: len(x) for i, x in ids.items()}
    for places in sequences.values():
        places.sort()
        ends = np.cumsum([length for _, length in places])
        assert [at for at, _ in places] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    fewest = -(-sum(map(len, ids.values())) // 4096)
    assert len(sequences) <= 1.02 * fewest + 1


def test_personal_data_equals_plain_patterns(spark, docs):
    for r in run(spark, 2):
        base = plain.base_spans(docs[r["doc_id"]]["text"])
        kinds = ("email", "ip", "card", "phone")
        assert [r[f"n_{k}"] for k in kinds] == [sum(x == n for _, x, _ in base) for n in range(4)]
        spans = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        assert set(spans) <= set(r["spans"].split(",")) or not spans


def test_languages_of_held_out_documents(spark, docs):
    rows = run(spark, 4)
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mix_meets_its_targets(spark, docs):
    rows = run(spark, 5)
    sizes = plain.source_sizes([(i, r["text"], r["source"]) for i, r in docs.items()])
    wanted, taken = plain.targets(sizes), Counter()
    largest = Counter()
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == len(plain.words(docs[r["doc_id"]]["text"]))
        assert r["source_size"] == sizes[source] and r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(wanted[source])
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - wanted[s]) <= largest[s] for s in sizes)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.03)


def test_mix_agrees_with_itself(spark):
    first, again = (sorted(map(tuple, run(spark, 5))) for _ in range(2))
    assert first == again


def test_fingerprints_and_edited_texts(spark, docs):
    rows = run(spark, 7)
    expected = plain.edited([(i, r["text"]) for i, r in docs.items()])
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == expected
    by_text = defaultdict(set)
    for r in rows:
        by_text[docs[r["doc_id"]]["text"]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(found) == 1 for found in by_text.values())
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.9


def test_shards_are_even_and_slots_gapless(spark, docs):
    rows = run(spark, 9)
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        raw = docs[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / 16
    assert all(abs(size[k] - mean) <= 0.03 * mean for k in range(16))
    groups = defaultdict(set)
    for r in rows:
        groups[docs[r["doc_id"]]["text"]].add(r["shard"])
    assert all(len(shards) == 1 for shards in groups.values())


def test_token_files_give_back_every_id(spark, docs, library):
    encode = library("byte_bpe_50k.json")
    rows = {r["doc_id"]: r for r in run(spark, 10)}
    start = 0
    for i in sorted(docs):
        ids = encode(docs[i]["text"], 2)
        assert (rows[i]["start"], rows[i]["n_tokens"]) == (start, len(ids))
        assert rows[i]["ids_crc32"] == plain.crc32(ids)
        start += len(ids)


@pytest.mark.parametrize("stage", [corpus_pipeline.identify_language, corpus_pipeline.mask_personal_data])
def test_stages_hand_few_texts_to_a_worker_at_once(spark, stage):
    """pipeline: ten thousand at once, never given back, took more than an executor's memory."""

    @F.pandas_udf("long")
    def handed(texts: pd.Series) -> pd.Series:
        return pd.Series(len(texts), index=texts.index)

    rows = [(i, f"some words and the number {i}", "en", "a", 30) for i in range(3000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).coalesce(1).withColumn("handed", handed("text"))
    out = stage(spark, docs, "").agg(F.count("*"), F.max("handed")).first()
    assert out[0] > 0 and out[1] <= 1024


def test_a_task_gives_memory_back_at_its_end(monkeypatch):
    done = []
    monkeypatch.setattr("freshet.llm.staging.release_memory", lambda: done.append(True))
    assert [(x, len(done)) for x in handing_back(iter("ab"))] == [("a", 1), ("b", 1)]
    assert len(done) == 2


def test_pipeline_stage_by_stage(spark, docs):
    """Every stage against its predecessor's rows."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = frame.columns
        frame = stage(spark, frame, SF)
        rows = frame.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == columns
            frame = spark.createDataFrame(rows, frame.schema)
        done[name] = rows
    known = done["language_id"]
    assert len(known) == len(docs)  # all have letters and a known language
    expected = plain.near_duplicates([(r["doc_id"], r["text"]) for r in known])
    assert {r["doc_id"] for r in done["minhash_dedup"]} == {i for i, _, _, kept in expected if kept}
    for before, after in zip(
        sorted(done["minhash_dedup"]), sorted(done["personal_data"]), strict=True
    ):
        assert before["doc_id"] == after["doc_id"] and after["n_chars"] == len(after["text"])
        assert not plain.base_spans(after["text"])
        if not plain.base_spans(before["text"]):
            assert before["text"] == after["text"]
    masked = done["personal_data"]
    sizes = plain.source_sizes([(r["doc_id"], r["text"], r["source"]) for r in masked])
    wanted, taken, copies = plain.targets(sizes), Counter(), Counter()
    for r in done["source_mixing"]:
        taken[r["source"]] += len(plain.words(r["text"]))
        copies[r["doc_id"]] += 1
    assert max(copies.values()) <= 2
    largest = {s: max(len(plain.words(r["text"])) for r in masked if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - wanted[s]) <= largest[s] for s in sizes)
    packed = Counter(r["doc_id"] for r in done["packing"] if r["piece"] == 0)
    assert packed == copies

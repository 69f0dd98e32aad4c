"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute_force as plain
import corpus_pipeline
from edge_rows import TEXTS, edge_documents, whole_rows
from freshet.llm.catalog import vocabulary_file
from freshet.llm.embedding_links import link_vectors
from freshet.llm.fingerprints import fingerprint_documents
from freshet.llm.kd_shards import shard_documents
from freshet.llm.language_id import identify_languages
from freshet.llm.minhash import near_duplicates
from freshet.llm.mixing import mix_documents
from freshet.llm.packing import pack_documents
from freshet.llm.pii import find_personal_data
from freshet.llm.token_files import read_token_files, write_token_files

WORD_IDS, BYTE_IDS = "word_bpe_49k.json", "byte_bpe_50k.json"
IDS = Counter(i for i, *_ in TEXTS)


@pytest.fixture(scope="module")
def docs(spark):
    return edge_documents(spark)


@pytest.fixture(scope="module")
def nothing(spark):
    return edge_documents(spark, [])


def ids_of(rows):
    return Counter(r["doc_id"] for r in rows)


def test_packing(spark, docs):
    rows = pack_documents(spark, docs, vocabulary_file(WORD_IDS)).collect()
    assert ids_of(r for r in rows if r["piece"] == 0) == IDS
    assert {r["length"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert all(r["length"] == 4096 for r in rows if r["doc_id"] == 10 and r["piece"] == 0)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["offset"] + r["length"]))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 4096
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_packing_keeps_ids_if_asked(spark, docs):
    rows = pack_documents(spark, docs, vocabulary_file(WORD_IDS), keep_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)


def test_personal_data(spark, docs):
    rows = find_personal_data(docs).collect()
    assert ids_of(rows) == IDS
    by_id = {r["doc_id"]: r for r in rows}
    text = next(t for i, t, *_ in TEXTS if i == 12)
    spans = [f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in plain.base_spans(text)]
    assert by_id[12]["spans"] == ",".join(spans) and by_id[12]["n_email"] == by_id[12]["n_phone"] == 1
    assert by_id[3]["spans"] == by_id[4]["spans"] == "" and by_id[3]["base_sha256"]


def test_near_duplicates(spark, docs):
    rows = near_duplicates(spark, docs).collect()
    assert ids_of(rows) == IDS
    assert set(map(tuple, rows)) == plain.near_duplicates([(i, t) for i, t, *_ in TEXTS])


def test_languages(spark, docs):
    rows = identify_languages(spark, docs).collect()
    assert ids_of(rows) == IDS
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 8):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in identify_languages(spark, unlabelled).collect()} == {"und"}


def test_mixing(spark, docs):
    rows = mix_documents(spark, docs).collect()
    assert ids_of(rows) == IDS
    sizes = plain.source_sizes([(i, t, s) for i, t, _, s in TEXTS])
    wanted = plain.targets(sizes)
    assert None in sizes
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]


def test_mixing_with_one_source_and_with_no_words(spark):
    one = edge_documents(spark, [(i, "a b c", "en", "s") for i in range(10)])
    assert sum(r["taken"] for r in mix_documents(spark, one).collect()) == 45
    empty = edge_documents(spark, [(i, None, "en", "s") for i in range(3)])
    assert [tuple(r)[2:] for r in mix_documents(spark, empty).collect()] == [(0, 0, 0.0, 0, 0)] * 3


def test_fingerprints(spark, docs):
    rows = fingerprint_documents(spark, docs).collect()
    assert ids_of(rows) == IDS
    known = {i: t for i, t, *_ in TEXTS}
    expected = plain.edited([(i, t) for i, t in known.items() if i is not None and i not in (1, -7, 2)])
    for r in rows:  # rows between unlike neighbours only
        if r["doc_id"] in (4, 5, 6, 7, 8, 9, 10, 11, 12):
            assert (r["n_chars"], r["edited_sha256"]) == expected[r["doc_id"]]
    alone = edge_documents(spark, [(5, "only this one", "en", "s")])
    (only,) = fingerprint_documents(spark, alone).collect()
    assert only["near_next"] == 1.0


def test_shards(spark, docs):
    rows = shard_documents(spark, docs, shards=4).collect()
    assert ids_of(rows) == IDS
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(4))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_equal_documents_are_even(spark):
    same = edge_documents(spark, [(i, "same text", "en", "s") for i in range(1000)])
    sizes = Counter(r["shard"] for r in shard_documents(spark, same, shards=8).collect())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 3


def test_shards_by_target_bytes(spark):
    same = edge_documents(spark, [(i, "0123456789" * 10, "en", "s") for i in range(100)])
    rows = shard_documents(spark, same, target_bytes=2000).collect()
    assert len({r["shard"] for r in rows}) == 8  # 10,100 bytes in leaves of 1,262


def test_token_files(spark, docs, tmp_path):
    write_token_files(spark, docs, str(tmp_path / "t"), vocabulary_file(BYTE_IDS), 50_257)
    rows = sorted(read_token_files(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    assert ids_of(rows) == IDS
    ids = [-(1 << 60) if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    start = 0
    for r in rows:
        assert r["start"] == start and len(r["ids"]) == 4 * r["n_tokens"]
        start += r["n_tokens"]


VECTORS = [
    (0, [1.0, 0.0, 0.0], 1),
    (1, [2.0, 0.0, 0.0], 1),
    (2, [1.0, 0.0, 0.0], 1),
    (3, [1.0, 0.0, 0.0], 2),
    (4, [1.0, 0.0, 0.0], None),
    (5, None, 1),
    (6, [], 1),
    (7, [0.0, 0.0, 0.0], 1),
    (8, [1.0, None, 0.0], 1),
    (9, [1.0, float("nan"), 0.0], 1),
    (10, [float("inf"), 0.0, 0.0], 1),
    (11, [1.0, 0.0], 1),
    (12, [0.99, 0.1, 0.0], 1),
    (13, [0.95, 0.29, 0.0], 1),
    (14, [-1.0, 0.0, 0.0], 1),
]


def test_vector_links(spark):
    schema = "vec_id long, embedding array<float>, label int, kept string, node int, id int"
    rows = [(*r, "x", 1, 2) for r in VECTORS]
    found = link_vectors(spark, spark.createDataFrame(rows, schema)).collect()
    assert set(map(tuple, found)) == plain.vector_links(VECTORS) and len(found) == len(VECTORS)
    assert link_vectors(spark, spark.createDataFrame([], schema)).collect() == []
    without_id = spark.createDataFrame([(None, [1.0], 1, "x", 1, 2)] * 2, schema)
    assert whole_rows(link_vectors(spark, without_id)) == [(None, 0, None, True)] * 2


@pytest.mark.parametrize("name", ["pack", "pii", "near", "lang", "mix", "print", "shard"])
def test_empty_tables(spark, nothing, name):
    work = {
        "pack": lambda: pack_documents(spark, nothing, vocabulary_file(WORD_IDS)),
        "pii": lambda: find_personal_data(nothing),
        "near": lambda: near_duplicates(spark, nothing),
        "lang": lambda: identify_languages(spark, nothing),
        "mix": lambda: mix_documents(spark, nothing),
        "print": lambda: fingerprint_documents(spark, nothing),
        "shard": lambda: shard_documents(spark, nothing),
    }
    assert work[name]().collect() == []


def test_empty_token_files(spark, nothing, tmp_path):
    write_token_files(spark, nothing, str(tmp_path / "t"), vocabulary_file(BYTE_IDS), 50_257)
    assert read_token_files(spark, str(tmp_path / "t")).collect() == []


def test_pipeline_stages_on_edge_rows(spark, docs, nothing):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, frame, "").collect()
        assert stage(spark, nothing, "").collect() == []
        kept = spark.createDataFrame(rows, docs.schema)
        if name == "minhash_dedup":
            assert max(n for i, n in ids_of(rows).items() if i is not None) == 1
        if name == "personal_data":
            text = next(r["text"] for r in rows if r["doc_id"] == 12)
            assert text == "write to [EMAIL] or [PHONE] now"
        if name == "source_mixing":
            assert max(ids_of(rows).values()) <= 2
        frame = kept
    last = corpus_pipeline.STAGES[-1][1]
    assert {r["doc_id"] for r in last(spark, frame, "").collect()} == set(ids_of(frame.collect()))


def test_language_stage_without_labels_keeps_texts_with_letters(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, unlabelled, "").collect()
    assert {r["doc_id"] for r in kept} == set(IDS) - {3, 4, 5, 8}


def test_one_id_with_unlike_texts_brings_no_copy_back(spark):
    """Of (1, A), (5, A), (5, B) the second goes, whatever becomes of the third."""
    other = "an entirely different text that shares no words whatsoever with its namesake"
    rows = [(1, plain_text(0), "en", "a"), (5, plain_text(0), "en", "a"), (5, other, "en", "a"), (9, plain_text(0), "en", "a")]
    docs = edge_documents(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == [(1, plain_text(0)), (5, other)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_stand_one_id_with_unlike_texts(spark, name, stage):
    rows = [*TEXTS, (2, "another text of document two, which has quite other words", "en", "b"), (2, None, "en", None)]
    docs = edge_documents(spark, rows)
    found = stage(spark, docs, "").collect()
    assert {r["doc_id"] for r in found} <= {i for i, *_ in rows} and found


def plain_text(k: int) -> str:
    return TEXTS[k][1]

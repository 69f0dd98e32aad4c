"""Language model, conversation trie and spelling variants against plain versions, and their edge rows."""

import numpy as np
import pytest

import brute_force as plain
from edge_rows import TEXTS, edge_documents, whole_rows
from freshet.llm import interpolated_lm
from freshet.llm.conversation_trie import prefix_trie
from freshet.llm.interpolated_lm import pack, score_documents, unpack
from freshet.llm.spelling_variants import KEPT, near_words, signatures, spelling_variants

SF = "/root/testdata/sf0.001"

TURNS = [
    (0, 0, "user", "hello"),
    (0, 1, "assistant", "hi"),
    (0, 2, "user", "more"),
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "hi"),
    (2, 0, "user", "hello"),
    (2, 0, "user", "hello"),
    (2, None, None, None),
    (3, 5, "", ""),
    (4, 0, "user", "Größe \U0001f600"),
    (7, 0, "user", "no base"),
    (8, 0, "user", "no base"),
    (8, 1, "user", "again"),
    (11, 0, "a", "bc"),
    (11, 1, "ab", "c"),
    (-3, 0, "user", "negative"),
    (-5, 0, "user", "negative base"),
    (-7, 1, "user", "x" * 30_000),
    (None, 0, "user", "no conversation"),
    *((20, k, "user", f"turn {k}") for k in range(400)),
    *((21, k, "user", f"turn {k}") for k in range(400)),
    *((1 << 40, k, "user", "the same") for k in range(12)),
]
TURN_SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, seq boolean, length int"


def turn_frame(spark, turns):
    return spark.createDataFrame([(*t, 1, "x", True, 9) for t in turns], TURN_SCHEMA)


def test_trie_of_edge_rows(spark):
    rows = prefix_trie(spark, turn_frame(spark, TURNS)).drop("k1", "k2").collect()
    assert len(rows) == len(set(rows)) and set(map(tuple, rows)) == plain.trie(TURNS)


def test_trie_of_nothing(spark):
    assert prefix_trie(spark, turn_frame(spark, [])).collect() == []
    assert prefix_trie(spark, turn_frame(spark, [(None, 0, "user", "x")])).collect() == []


def test_trie_of_short_conversations_is_the_root(spark):
    turns = [(7, 0, "user", "taken from nowhere")]  # crc32("7") % 9 is above 1, and 5 is absent
    rows = prefix_trie(spark, turn_frame(spark, turns)).drop("k1", "k2").collect()
    assert set(map(tuple, rows)) == plain.trie(turns)


def test_long_conversation_spreads_over_stretches(spark):
    """Range partitions cut one conversation; its prefix keys are still those of its whole."""
    turns = [(5, k, "user", f"turn {k % 7}") for k in range(5000)]
    turns += [(c, k, "user", f"turn {k % 7}") for c in (6, 9) for k in range(5000)]
    rows = prefix_trie(spark, turn_frame(spark, turns)).drop("k1", "k2").collect()
    assert len(rows) == 5001 and {r["n_convs"] for r in rows} == {3}
    assert rows[0]["n_leaves"] == 1 and sum(r["n_children"] for r in rows) == 5000


def test_spelling_of_edge_rows(spark):
    words = "ancient ancients ancienne anciint aancient ncient Ancient ancient\u00d7 \u00c9cole\u00e9t\u00e9 xancient"
    more = [(100 + k, f"{words} remarkable remarkabl {'remarkable ' * (k % 9)}", None, None) for k in range(60)]
    rows = [*TEXTS, *more]
    found = spelling_variants(spark, edge_documents(spark, rows)).collect()
    expected = plain.spelling([(i, t) for i, t, *_ in rows])
    assert set(map(tuple, found)) == expected and len(found) == len(expected)
    assert any(r["form"] for r in found)


def test_spelling_of_nothing(spark):
    assert spelling_variants(spark, edge_documents(spark, [])).collect() == []


def test_signatures_meet_for_every_edit():
    """Every word one edit apart from another shares a signature with it."""
    rng = np.random.default_rng(7)
    letters = list("aabcde\u00e9z")
    for _ in range(300):
        word = "".join(rng.choice(letters, rng.integers(7, 14)))
        edits = [word[:k] + word[k + 1 :] for k in range(len(word))]
        edits += [word[:k] + x + word[k + 1 :] for k in range(len(word)) for x in "aq"]
        edits += [word[:k] + x + word[k:] for k in range(len(word) + 1) for x in "aq"]
        edits = [e for e in edits if len(e) >= 7 and plain.one_edit(e, word)]
        own = set(signatures([word])[0].tolist())
        assert len(own) == 2 * len(KEPT)
        assert all(own & set(row) for row in signatures(edits).tolist())


def test_near_words_equal_every_pair_compared(spark):
    rng = np.random.default_rng(11)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(7, 10))) for _ in range(400)} | {"a" * 500, "a" * 501})
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    expected = [(a, b) for k, a in enumerate(words) for b in words[k + 1 :] if plain.one_edit(a, b)]
    assert sorted(map(tuple, near_words(spark, frame).collect())) == expected


def compared(rows, expected):
    rows = sorted(map(tuple, rows), key=repr)
    expected = sorted(expected, key=repr)
    assert [r[:5] for r in rows] == [e[:5] for e in expected]
    assert np.allclose([r[5] for r in rows], [e[5] for e in expected])
    assert np.allclose([r[6] for r in rows], [e[6] for e in expected], rtol=2e-4)


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(interpolated_lm, "BUCKET_TOKENS", 9000)


def test_scores_equal_plain_counting(spark, small_slices):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = score_documents(spark, docs).collect()
    compared(rows, plain.language_model([(r["doc_id"], r["text"]) for r in docs.collect()]))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 1.1 * sum(r["base_score"] for r in held)


def test_scores_of_edge_rows(spark):
    compared(
        score_documents(spark, edge_documents(spark)).collect(),
        plain.language_model([(i, t) for i, t, *_ in TEXTS]),
    )


@pytest.mark.parametrize("fold", [(1,), (4,), (1, 4), (0, 1)])
def test_scores_where_a_part_is_absent(spark, fold):
    import zlib

    chosen = [(i, "a b c a b d" if i % 2 else "a b", None, None) for i in range(60) if zlib.crc32(str(i).encode()) % 5 in fold]
    compared(
        score_documents(spark, edge_documents(spark, chosen)).collect(),
        plain.language_model([(i, t) for i, t, *_ in chosen]),
    )


def test_scores_of_nothing(spark):
    assert score_documents(spark, edge_documents(spark, [])).collect() == []


def test_probabilities_after_a_context_sum_to_one():
    """Over all known words and the share of unknown ones."""
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 50, (3, 40)).astype(float)
    f1, f2, f3 = counts / counts.sum(axis=1, keepdims=True)
    weights = interpolated_lm.Weights(0.7, np.full(65, 0.6), np.full(65, 0.3))
    k = np.full(40, 5)
    p, _ = weights.mixed(f1, f2, f3, k, k, 40)
    unknown, _ = weights.mixed(0.0, 0.0, 0.0, 5, 5, 40)
    assert p.sum() + unknown == pytest.approx(1)


def test_packed_arrays_come_back():
    for values in (np.arange(1000, dtype=np.uint64) << np.uint64(40), np.empty(0, np.uint32), np.array([True, False])):
        assert np.array_equal(unpack(pack(values), values.dtype), values)


def test_edge_rows_twice_agree(spark):
    first, again = (whole_rows(score_documents(spark, edge_documents(spark))) for _ in range(2))
    assert first == again

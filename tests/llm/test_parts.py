"""The operators' inner parts against plain versions."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute_force as plain
from freshet.llm import fingerprints, mixing, packing, pii
from freshet.llm.crf import AROUND, Crf
from freshet.llm.byte_pieces import PieceIds, column_of, rows_of, slices
from freshet.llm.catalog import vocabulary_file
from freshet.llm.components import components
from freshet.llm.cover_tree import CoverTree, Links
from freshet.llm.embedding_links import _units, link_vectors
from freshet.llm.kd_shards import HEAVY, deal, kd_leaves, room_left, shard_documents
from freshet.llm.language_id import ngrams
from freshet.llm.minhash import BANDS, ROWS, band_keys, signatures
from freshet.llm.packing import best_two_fit
from freshet.llm.shingles import shingle_sets
from freshet.llm.token_files import pack_ranks, pack_rows, unpack_ranks, unpack_rows
from freshet.llm.tokens import WordIds, word_ids

SIGNS = "aAbé ßÉ' .,!\n\t  12 \x1c\x85́ İΣ<|>"


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_of_words_are_ids_of_whole_texts(name, spaces):
    rng = random.Random(3)
    texts = ["", " ", "  a  b \n c", "Hello's WORLD don't ,, x<|endoftext|> y", "ﬁ ½ 日本語 。"]
    texts += ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(3000)]
    encoder = word_ids(vocabulary_file(name), spaces)
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, got, expected in zip(texts, encoder.encode(texts, 9), whole, strict=True):
        assert got.tolist() == [*expected.ids, 9], text


def test_words_after_line_breaks_are_remembered(monkeypatch):
    """op10: a word before a line break hid the one after it, so both were looked up each time."""
    encoder = WordIds(vocabulary_file("byte_bpe_50k.json"), spaces=True)
    heads = ["One", "two's", "x.", "(three),", "dé", "\t", "1"]
    texts = [f"{a}\nThe {b}\nThe,\nThe {a}" for a in heads for b in heads]
    texts += ["\nThe", "The\n", "a \nThe", "a\n\nThe b\nThe", "a\n The", "a\r\nThe"]
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, got, expected in zip(texts, encoder.encode(texts, 9), whole, strict=True):
        assert got.tolist() == [*expected.ids, 9], text
    looked_up = []
    monkeypatch.setattr(encoder, "_part", lambda part: looked_up.append(part) or b"")
    encoder.encode(["x one\nThe two\nThe"], 9)
    assert "The" not in looked_up


def test_words_with_a_closing_sign_are_remembered():
    """op10: a word with a comma was put together anew each time it came."""
    encoder = WordIds(vocabulary_file("byte_bpe_50k.json"), spaces=True)
    text = "Plain words, often met. words, met. Größe, words"
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(3):
        assert encoder.encode([text], 9)[0].tolist() == [*whole, 9]
    assert {"words,", "met.", "often", "words"} <= set(encoder)


def columns_ids(encoder, texts, end_id, most):
    data, begins = rows_of(pa.array(texts, pa.string()))
    for at, to in slices(begins, most):
        ids, places = encoder.encode(
            data[begins[at] : begins[to]], begins[at : to + 1] - begins[at], end_id
        )
        yield from (part.tolist() for part in np.split(ids, places[1:-1]))


@pytest.mark.parametrize("signs", [SIGNS, "ab' .,\n1é", "a \n\t\xa0\u2003\u3000×”П日'sé٣"])
def test_ids_of_pieces_are_ids_of_whole_texts(signs):
    rng = random.Random(7)
    texts = ["", " ", "\n", "a ", "a\n", "x\n\ny", "a  b\r\n c", "He's 12th, x<|endoftext|>y!", "a" * 90]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(4000)]
    encoder = PieceIds(vocabulary_file("byte_bpe_50k.json"))
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for most in (1, 5000, 1 << 20):  # pieces met in earlier slices are remembered
        found = columns_ids(encoder, texts, 9, most)
        for text, got, expected in zip(texts, found, whole, strict=True):
            assert got == [*expected.ids, 9], text
    assert list(columns_ids(encoder, [None, "", None], 9, 10)) == [[9]] * 3
    assert list(columns_ids(encoder, [], 9, 10)) == []


def test_a_slice_looks_each_piece_up_once(monkeypatch):
    """op10: every word of every text was looked up, and anew with each sign after it."""
    encoder = PieceIds(vocabulary_file("byte_bpe_50k.json"))
    looked_up, look_up = [], encoder._look_up
    monkeypatch.setattr(encoder, "_look_up", lambda new: looked_up.extend(new) or look_up(new))
    texts = [f"Größe{sign} met{sign}\nOften met{sign}" for sign in ",.;:!?)*&"] * 5
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for _ in range(3):
        found = list(columns_ids(encoder, texts, 9, 1 << 20))
        assert found == [[*expected.ids, 9] for expected in whole]
    # Once when new, once more in the second slice, which keeps them.
    assert sorted(looked_up) == sorted(["Größe", " met", "\n", "Often", *",.;:!?)*&"] * 2)


def test_pieces_of_the_last_generation_are_known(monkeypatch):
    monkeypatch.setattr("freshet.llm.byte_pieces.GENERATION", 3)
    encoder = PieceIds(vocabulary_file("byte_bpe_50k.json"))
    texts = ["some words that are often met"] * 2 + ["and some words that are not"] * 3
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for _ in range(4):
        found = list(columns_ids(encoder, texts, 9, 1))
        assert found == [[*expected.ids, 9] for expected in whole]
        assert len(encoder.known) <= 3 and len(encoder.old) <= 9
    assert encoder.old


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=9), max_size=9))
def test_packed_rows_are_rows_packed_alone(rows):
    begins = np.cumsum([0, *map(len, rows)])
    raw = np.array([x for row in rows for x in row], dtype=np.uint32)
    control, controls, data, packs = pack_rows(raw, begins)
    assert unpack_rows(control, data, begins).tolist() == raw.tolist()
    alone = [pack_ranks(np.array(row, dtype=np.uint32)) for row in rows]
    assert column_of(control, controls).to_pylist() == [c for c, _ in alone]
    assert column_of(data, packs).to_pylist() == [d for _, d in alone]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=60))
def test_ranks_come_back(ranks):
    raw = np.array(ranks, dtype=np.uint32)
    control, data = pack_ranks(raw)
    assert len(control) == -(-len(ranks) // 4)
    assert unpack_ranks(control, data, len(ranks)).tolist() == ranks


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=20))
def test_plan_has_a_place_for_every_piece(counts):
    plan = best_two_fit(counts, 50)
    filled = np.zeros((plan.sequences, 51), dtype=int)
    for length, n in counts.items():
        for nth in range(n):
            line = np.flatnonzero((plan.length == length) & (plan.first <= nth))[-1]
            within = nth - plan.first[line]
            sequence = plan.sequence[line] + within // plan.each[line]
            offset = plan.offset[line] + within % plan.each[line] * length
            filled[sequence, offset : offset + length] += 1
    assert filled[:, 50].sum() == 0 and filled.max(initial=0) <= 1
    assert filled.sum() == sum(k * n for k, n in counts.items())


def test_two_documents_replace_the_smallest():
    # Greedy fills 60 + 30; its gap of 10 and the 30 hold 25 + 15 exactly.
    plan = best_two_fit({60: 1, 30: 1, 25: 1, 15: 1}, 100)
    first = sorted(plan.length[plan.sequence == 0].tolist())
    assert first == [15, 25, 60]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1.2@-+ (5)%9\n", max_size=60))
def test_rules_equal_plain_patterns(text):
    assert pii.base_spans(text) == plain.base_spans(text)


def test_field_learns_its_table_and_adds_spans():
    field = pii.trained_field()
    for line in pii.LABELLED:
        shapes, labels = pii.labelled_sequence(line)
        assert field.decode([shapes])[0].tolist() == labels.tolist(), line
    text = "ask (614) 555-0190 or tim @ example.org, not 2023-05-06"
    ((base, spans),) = pii.all_spans([text], field)
    assert base == [] and pii.written(spans) == "phone:4:18,email:22:39"
    assert pii.masked(text, spans) == "ask [PHONE] or [EMAIL], not 2023-05-06"


def test_decoding_in_batches_equals_one_by_one():
    rng = np.random.default_rng(0)
    field = pii.trained_field()
    many = [rng.integers(1, 2 * len(pii.SHAPES), n) for n in rng.integers(0, 30, 50)]
    for one, labels in zip(many, field.decode(many), strict=True):
        assert labels.tolist() == (field.decode([one])[0].tolist() if len(one) else [])


def test_decoding_finds_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    n_shapes, n_labels = 5, 3
    field = Crf(
        rng.normal(size=(len(AROUND), n_shapes + 1, n_labels)), rng.normal(size=(n_labels, n_labels))
    )
    many = [rng.integers(1, n_shapes + 1, n) for n in (1, 2, 3, 5, 6, 6)]

    def score(shapes, path):
        total = sum(field.step[a, b] for a, b in itertools.pairwise(path))
        for at, label in enumerate(path):
            for k, away in enumerate(AROUND):
                inside = 0 <= at + away < len(shapes)
                total += field.emit[k, shapes[at + away] if inside else 0, label]
        return total

    for shapes, labels in zip(many, field.decode(many), strict=True):
        paths = itertools.product(range(n_labels), repeat=len(shapes))
        assert tuple(labels.tolist()) == max(paths, key=lambda path: score(shapes, path))


def _planted(rng):
    """Personal data that no rule finds: form, kind, text."""
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda: "".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(3, 9)))
    body = "4" + digits(14)
    card = next(body + c for c in "0123456789" if pii.luhn(body + c))
    four = [card[k : k + 4] for k in range(0, 16, 4)]
    host = [str(rng.randint(1, 255)) for _ in range(4)]
    other = str.maketrans("0123456789", rng.choice(["０１２３４５６７８９", "٠١٢٣٤٥٦٧٨٩"]))
    return [
        ("spelt", 0, f"{word()}.{word()} (at) {word()} (dot) org"),
        ("bare", 0, f"{word()} at {word()} dot com"),
        ("brackets", 0, f"{word()} [at] {word()} [dot] net"),
        ("blanks", 0, f"{word()} @ {word()}.example.org"),
        ("blanks", 1, " . ".join(host)),
        ("other digits", 1, ".".join(host).translate(other)),
        ("dots", 2, ".".join(four)),
        ("other digits", 2, " ".join(four).translate(other)),
        ("no plus", 3, f"({digits(3)}) {digits(3)}-{digits(4)}"),
        ("other digits", 3, f"+44 20 {digits(4)} {digits(4)}".translate(other)),
    ]


def test_field_finds_planted_variants(spark):
    rng, field = random.Random(1), pii.trained_field()
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = table.where("not text rlike '[0-9@]'").orderBy("doc_id").limit(60).collect()
    hits, tries = {}, {}
    for r in clean:
        words = r["text"].split(" ")
        for form, kind, planted in _planted(rng):
            at = rng.randint(0, len(words))
            left = "".join(w + " " for w in words[:at])
            ((base, spans),) = pii.all_spans([f"{left}{planted} {' '.join(words[at:])}"], field)
            key = (form, kind)
            tries[key] = tries.get(key, 0) + 1
            hits[key] = hits.get(key, 0) + ((len(left), kind, len(left) + len(planted)) in spans)
            assert base == []
        assert pii.all_spans([r["text"]], field) == [([], [])]
    assert all(hits[key] >= 0.8 * tries[key] for key in tries), (hits, tries)


def test_slices_find_what_lies_on_their_borders():
    field = pii.trained_field()
    text = "word " * (pii.CORE - 5) + "ring (614) 555-0190 now " + "word " * 900
    for k in range(12):
        moved = text[5 * k :]
        start = moved.index("(")
        assert pii.all_spans([moved], field) == [([], [(start, 3, start + 14)])]


def test_tokens_are_runs_and_signs():
    starts, ends, shapes = pii.tokens("Ab c12 ３٤-_\u0301 at DOT")
    assert [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)] == [
        *((0, 2), (3, 4), (4, 6), (7, 9), (9, 10), (10, 11), (11, 12), (13, 15), (16, 19))
    ]
    names = [pii.SHAPES[(n - 1) // 2] for n in shapes.tolist()]
    assert names == ["Xx3", "x1", "d2", "d2", "-", "_", "?", "at", "dot"]
    assert [int(n - 1) % 2 for n in shapes] == [0, 0, 1, 0, 1, 1, 1, 0, 0]
    assert [len(x) for x in pii.tokens("")] == [0, 0, 0]


def test_field_finds_nothing_in_plain_text():
    field = pii.trained_field()
    texts = ["a b c " * 50, "on 2024-01-15 at 12:30 we had 3,141 of 10", "v1.2.3 id 4876179212", ""]
    assert all(spans == [] for _, spans in pii.all_spans(texts, field))


def test_long_runs_stay_linear():
    field = pii.trained_field()
    for text in ("a" * 300_000, "1" * 300_000, "x@" * 5000):
        pii.all_spans([text], field)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbÉé \n\t\x0b", max_size=60), max_size=6))
def test_shingle_sets_have_plain_sizes_and_overlaps(texts):
    found = shingle_sets(texts)
    expected = [plain.shingle_set(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in expected]
    for a, x in zip(found, expected, strict=True):
        for b, y in zip(found, expected, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_signatures_estimate_the_overlap():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    parts = [rng.integers(0, 1 << 63, 50, dtype=np.uint64) for _ in range(2)]
    sets = [np.unique(np.concatenate([common, p])) for p in parts]
    x, y = signatures(sets, BANDS * ROWS)
    assert np.mean(x == y) == pytest.approx(300 / 400, abs=0.1)
    keys = band_keys(np.stack([x, y]))
    assert (keys[0] == keys[1]).any() and len(np.unique(keys[0])) == BANDS
    assert (signatures([np.empty(0, np.uint64)], 4) == 0xFFFFFFFF).all()


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in components(spark, frame).collect()}
    nodes = {n for link in links[:-1] for n in link}
    assert found == plain.grouped(links[:-1], sorted(nodes))


@pytest.mark.parametrize("spread", [0.02, 0.1, 1.0])
def test_dual_traversal_finds_every_pair(spread):
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.normal(size=(12, 16))
    points = centres[rng.integers(0, 12, 900)] + spread * rng.normal(size=(900, 16))
    points /= np.linalg.norm(points, axis=1)[:, None]
    ids, copies = np.arange(900) * 3, rng.integers(1, 4, 900)
    halves = np.split(np.arange(900), [500])
    trees = [CoverTree.of(points[h]) for h in halves]
    for tree in trees:
        for (first, last, *_, centre), radius in zip(tree.nodes, tree.radius, strict=True):
            away = np.linalg.norm(tree.points[first:last] - tree.points[centre], axis=1)
            assert away.max() <= radius + 1e-7
    partners = dict.fromkeys(ids.tolist(), 0)
    links = []
    for a, b in ((0, 0), (0, 1), (1, 1)):
        x, y = halves[a], halves[b]
        found = Links(trees[a], trees[b], copies[x], copies[y], 0.98).find().found(ids[x], ids[y])
        for i, n, least in found:
            partners[i] += n
            links.append((i, least))
    near = points @ points.T >= 0.98
    np.fill_diagonal(near, False)
    assert [partners[i] for i in ids.tolist()] == (near @ copies).tolist()
    pairs = [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(near), strict=True)]
    assert plain.grouped(links, ids.tolist()) == plain.grouped(pairs, ids.tolist())


def test_fingerprints_of_equal_edited_and_other_texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(500)]
    one, other = (" ".join(rng.choices(words[k : k + 250], k=400)) for k in (0, 250))
    code = fingerprints.digest(one.encode())
    assert fingerprints.likeness(code, code) == 1.0
    assert (fingerprints.from_text(fingerprints.to_text(code)) == code).all()
    close = fingerprints.digest(one.replace(words[3], words[400], 1).encode())
    far = fingerprints.digest(other.encode())
    assert fingerprints.likeness(code, close) > 0.9 > fingerprints.likeness(code, far)
    assert fingerprints.bucket_counts(b"abcdefg").sum() == 3 * len(fingerprints.TRIPLETS)


def test_ngrams_stay_within_words():
    a, b = ord("a"), ord("b")
    found = ngrams("A1b").tolist()
    shift = 1 << 21
    expected = [a, b]
    expected += [1 * shift + a, a * shift + 1, 1 * shift + b, b * shift + 1]
    expected += [(1 * shift + a) * shift + 1, (1 * shift + b) * shift + 1]
    assert sorted(found) == sorted(expected)
    assert len(ngrams("123 ...")) == 0


def test_kd_tree_equals_a_plain_one(spark):
    rng = random.Random(9)
    points = [
        ((rng.randint(0, 9) ** 2, rng.choice([3, 500]), k), rng.randrange(1 << 32), rng.randint(1, 90))
        for k in range(300)
    ]
    room = [1.0, 2.0, 0.0, 1.5, 1.0, 1.0, 0.5, 3.0]
    rows = [(*dims, mix, size, 1) for dims, mix, size in points]
    frame = spark.createDataFrame(rows, "a long, b long, c long, mix long, size long, node long")
    placed = kd_leaves(frame, ["a", "b", "c"], room).collect()
    assert {((r["a"], r["b"], r["c"]), r["mix"]): r["leaf"] for r in placed} == plain.kd_tree(points, room)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), max_size=40), st.integers(0, 5000))
def test_heavy_points_leave_room_for_the_rest(sizes, rest):
    dealt, loads = deal([(str(k), 0, size) for k, size in enumerate(sizes)], 8)
    assert sorted(key for key, *_ in dealt) == sorted(str(k) for k in range(len(sizes)))
    assert [sum(sizes[int(k)] for k, _, s in dealt if s == shard) for shard in range(8)] == loads
    room = room_left(loads, rest)
    assert sum(room) == pytest.approx(rest)
    filled = [a + b for a, b in zip(loads, room, strict=True) if b > 0]
    assert not filled or max(filled) - min(filled) < 1e-6 <= min(filled) + 1e-3


def test_groups_of_equal_texts_share_a_shard_if_they_fit(spark):
    texts = ["x" * 60] * 400 + [f"{k} " + "y" * (k % 70) for k in range(500)]
    texts += [text for k in range(30) for text in [f"group {k}" * 5] * (k % 6 + 2)] + [None, "", None]
    rows = [(k, text, "en", f"s{k % 3}") for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    shards, load = {}, [0] * 16
    for r in shard_documents(spark, docs, 16).collect():
        shards.setdefault(texts[r["doc_id"]] or "", set()).add(r["shard"])
        load[r["shard"]] += r["size"]
    assert len(shards.pop("x" * 60)) > 1  # more than half of all bytes
    assert all(len(found) == 1 for found in shards.values())
    assert max(load) - min(load) <= sum(load) / 16 / HEAVY * 2


@pytest.mark.parametrize("steps", [60, 2, 0])
def test_tilts_equal_plain_bisection(spark, monkeypatch, steps):
    monkeypatch.setattr(mixing, "STEPS", steps)
    rng = random.Random(2)
    counts = {
        s: {rng.randint(1, 4000): rng.randint(1, 30) for _ in range(40)} for s in ("a", "b", "c", "d")
    }
    words = {s: sum(size * n for size, n in x.items()) for s, x in counts.items()}
    wanted = {s: share * words[s] for s, share in zip(words, (0.02, 0.7, 1.3, 1.97), strict=True)}
    rows = [(True, s, size, n) for s, x in counts.items() for size, n in x.items()]
    sized = spark.createDataFrame(rows, "named boolean, source string, size long, docs long")
    goals = [(True, s, words[s], wanted[s]) for s in words]
    goals = spark.createDataFrame(
        goals, "named boolean, source string, source_size long, target double"
    )
    found = {r["source"]: r["tilt"] for r in mixing.balance(spark, sized, goals, 2).collect()}
    for s, sizes in counts.items():
        top = max(sizes)

        def taken(tilt, sizes=sizes, top=top):
            return sum(min(2, np.exp(min(tilt * k / top, 50))) * k * n for k, n in sizes.items())

        low, high = -1e6, 1e6
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if taken(middle) < wanted[s] else (low, middle)
        assert taken(found[s]) == pytest.approx(wanted[s], rel=2e-6)
        assert found[s] == pytest.approx(low, rel=1e-3, abs=1e-4)


def test_targets_that_cannot_be_met_exactly_end(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    monkeypatch.setattr(mixing, "NEAR", 0.0)
    sized = spark.createDataFrame([(True, "a", 7, 3)], "named boolean, source string, size long, docs long")
    goals = spark.createDataFrame(
        [(True, "a", 21, 10.1)], "named boolean, source string, source_size long, target double"
    )
    (found,) = mixing.balance(spark, sized, goals, 2).collect()
    # Sums have six decimal places.
    assert 21 * np.exp(found["tilt"]) == pytest.approx(10.1, abs=1e-6) and not found["off"]


def test_very_large_and_very_small_vectors_link(spark):
    base = np.array([[3.0, 4.0, 0.5], [-1.0, 2.0, 2.0]])
    assert (_units(base * 2.0**900) == _units(base)).all()
    rows = [(k, 1, (base[k % 2] * scale).tolist()) for k, scale in enumerate([1, 1, 1e200, 1e-200, 1e-300, 1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in link_vectors(spark, frame).collect()}
    assert found == {0: (2, 0), 2: (2, 0), 4: (2, 0), 1: (2, 1), 3: (2, 1), 5: (2, 1)}


def test_packing_hands_few_texts_to_a_worker(spark, monkeypatch):
    """pipeline: whole batches of ten thousand texts lay in the workers beside what earlier stages left."""
    setting, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, stage = spark.conf.get(setting), packing.staged

    def spied(session, *rest):
        seen.append(int(session.conf.get(setting)))
        return stage(session, *rest)

    monkeypatch.setattr(packing, "staged", spied)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = packing.pack_documents(spark, docs, vocabulary_file("word_bpe_49k.json")).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == [(1, 3), (2, 1)]
    assert seen == [packing.HANDED] and spark.conf.get(setting) == before

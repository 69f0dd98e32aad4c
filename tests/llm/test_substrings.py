"""Repeated passages: shifts, edges, and planted copies."""

import random
import re
import string
from collections import defaultdict

import numpy as np
from edge_rows import TEXTS, edge_documents
from freshet.llm.substring_dedup import AMONG, GEAR, LEAST, MOST, anchors, cut_points, gear_hashes
from freshet.llm.substring_dedup import repeated_passages, words_of


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def test_cuts_cover_the_text_and_move_with_it():
    rng = random.Random(1)
    raw = words(rng, 2000).encode()
    ends = cut_points(raw)
    sizes = [b - a for a, b in zip([0, *ends], ends, strict=False)]
    assert ends[-1] == len(raw) and max(sizes) <= MOST and min(sizes[:-1]) >= LEAST
    shifted = {e - 7 for e in cut_points(b"prefix " + raw)}
    assert len(shifted & set(ends)) > 0.9 * len(ends)
    assert cut_points(b"") == [] and cut_points(b"abc") == [3]


def test_texts_cut_together_have_the_anchors_they_have_alone():
    """op6: texts were cut one by one, which took more time than its budget."""
    rng = random.Random(4)
    texts = [None, "", " ", "a", "a " * 19, "a " * 20, " a" * 21, "x" * 5000, "é\n" * 300]
    texts += ["".join(rng.choices("ab é\t", k=rng.randint(0, 300))) for _ in range(300)]
    texts += [words(rng, 70_000), words(rng, 30)]
    assert [x[3].tolist() for x in anchors(["", "a b", None])] == [[], [], []]
    for text, (raw, starts, ends, at) in zip(texts, anchors(texts), strict=True):
        codes = np.frombuffer((text or "").encode(), dtype=np.uint8)
        assert raw == codes.tobytes()
        for got, expected in zip((starts, ends), words_of(codes), strict=True):
            assert got.tolist() == expected.tolist()
        hashes = gear_hashes(codes)[ends - 1].tolist()
        held = {len(hashes) - 1} if hashes else set()
        for k in range(AMONG, len(hashes) + 1):
            held.add(min(range(k - AMONG, k), key=lambda w: (hashes[w], -w)))
        assert at.tolist() == sorted(w for w in held if w >= 19)


def test_gear_hashes_see_sixteen_bytes():
    codes = np.random.default_rng(5).integers(0, 256, 200, dtype=np.uint8)
    plain = [
        sum(int(GEAR[codes[i - k]]) << k for k in range(min(16, i + 1))) & 0xFFFF for i in range(200)
    ]
    assert gear_hashes(codes).tolist() == plain


def test_planted_passages_are_found_and_others_left(spark):
    rng = random.Random(2)
    passage = words(rng, 80)
    rows = [(i, f"{words(rng, 60 + i)} {passage if i < 3 else ''} {words(rng, 50)}", "en", "s") for i in range(8)]
    found = repeated_passages(spark, edge_documents(spark, rows)).collect()
    assert {r["doc_id"] for r in found} == {0, 1, 2}
    for r in found:
        inside = rows[r["doc_id"]][1].encode()[r["start"] : r["end"]]
        assert inside in passage.encode() and r["n_words"] >= 20
        assert (r["dropped_bytes"] == 0) == (r["doc_id"] == 0)


def test_edge_rows_and_empty_table(spark):
    found = repeated_passages(spark, edge_documents(spark)).collect()
    assert {r["doc_id"] for r in found} <= {i for i, *_ in TEXTS}
    assert 10 in {r["doc_id"] for r in found}  # one phrase over and over
    assert repeated_passages(spark, edge_documents(spark, [])).collect() == []


def repeats_by_brute_force(texts, least=20):
    """Per text, the word spans covered by ``least`` words that occur at several places."""
    ends = [[(m.start(), m.end()) for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", t)] for t in texts]
    at = defaultdict(list)
    for i, (text, words_) in enumerate(zip(texts, ends, strict=True)):
        for k in range(least - 1, len(words_)):
            at[text[words_[k - least + 1][0] : words_[k][1]]].append((i, k))
    spans = defaultdict(list)
    for i, k in sorted(x for found in at.values() if len(found) > 1 for x in found):
        start, end = ends[i][k - least + 1][0], ends[i][k][1]
        if spans[i] and start < spans[i][-1][1]:
            spans[i][-1] = (spans[i][-1][0], end, spans[i][-1][2], k)
        else:
            spans[i].append((start, end, k - least + 1, k))
    return {(i, a, b, last - first + 1) for i, found in spans.items() for a, b, first, last in found}


def test_every_passage_of_39_words_is_found_to_its_ends(spark):
    rng = random.Random(3)
    rows = []
    for n in (39, 50, 51, 55, 60):
        for longest in (1, 4, 6, 9):
            for _ in range(12):
                some = lambda k: " ".join(
                    "".join(rng.choices(string.ascii_letters, k=rng.randint(1, longest))) for _ in range(k)
                )
                passage = some(n)
                for _ in range(2):
                    rows.append((len(rows), f"{some(rng.randint(5, 60))} {passage} {some(40)}", "en", "s"))
    found = repeated_passages(spark, edge_documents(spark, rows)).collect()
    have = {(r["doc_id"], r["start"], r["end"], r["n_words"]) for r in found}
    whole = repeats_by_brute_force([text.encode() for _, text, *_ in rows])
    assert len(whole) >= len(rows) and {x for x in whole if x[3] >= 39} <= have
    assert have <= whole


def test_places_with_different_partners_and_own_copies(spark):
    rng = random.Random(4)
    a, b, c = (words(rng, 45) for _ in range(3))
    texts = [f"{a} {words(rng, 9)}", f"{a} {b}", f"{words(rng, 9)} {b} {c}", f"{c} {words(rng, 3)} {c}"]
    rows = [(i, text, "en", "s") for i, text in enumerate(texts)]
    found = repeated_passages(spark, edge_documents(spark, rows)).collect()
    have = {(r["doc_id"], r["start"], r["end"], r["n_words"]) for r in found}
    assert have == repeats_by_brute_force([text.encode() for text in texts])
    dropped = {(r["doc_id"], r["start"]): r["dropped_bytes"] for r in found}
    again = len(texts[3]) - len(c)
    assert dropped[0, 0] == 0 and dropped[1, 0] == len(a)
    assert dropped[3, 0] == len(c) and dropped[3, again] == len(c)

"""Scores by a trigram model with deleted interpolation.

The probability of a word is a mix of its maximum-likelihood estimates after two words,
after one, and alone, and of a uniform share for unknown words::

    P1(w)    = a * c(w) / N         + (1 - a) / (V + 1)
    P2(w|v)  = b[k] * c(vw) / c(v)  + (1 - b[k]) * P1(w)      k: bucket of c(v)
    P3(w|uv) = d[k] * c(uvw) / c(uv) + (1 - d[k]) * P2(w|v)   k: bucket of c(uv)

A bucket is the number of binary digits of the context's count; a context that was never
seen has none and leaves all to the shorter one. The weights are learned by expectation-
maximisation on part of the training documents with counts from which these are deleted;
the scores then use the counts of all training documents.

Texts are cut into words once and staged in slices of whole documents. Every slice asks
for the counts of its distinct n-grams, by their keys, dealt over buckets; a bucket adds
up what all slices have of its keys and answers each with the totals. So a slice holds
all it needs for its scores, and no count is held anywhere else. Requests are sorted
arrays of keys, as differences, compressed. N-grams are told apart by 56 bits: of ten
billion, one in seven million shares its key and is counted with another. Slices and buckets are bounded by
``SLICE_TOKENS`` and ``BUCKET_TOKENS``; a slice asks every bucket, so raise both with the
memory of the workers: 50 million tokens take about 2 GB and suit 100 TB of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.shingles import _slices, _word_hashes, mix
from freshet.llm.staging import arrow_rows, ship_code, staged

SLICE_TOKENS = 700_000  # a longer document is a slice of its own
BUCKET_TOKENS = 1_500_000  # whose n-grams one bucket gets, about
SLICES = 4  # a worker takes at once
BUCKETS = 65  # of context counts: none, then one per binary digit
GAIN = 1e-4  # bits a token: learning stops when a turn gains less
LEAST_WEIGHT = 1e-6

KEPT, DELETED, TEST = 0, 1, 2  # documents: counted, counted and learned weights on, neither

END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
LOW_BITS = np.uint64(255)  # of a key: the number of words it is for
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)

SLICE_SCHEMA = (
    "slice long, kind int, n_docs long, n_tokens long, doc_ids binary, valid binary, "
    "lengths binary, words binary, places binary"
)
REQUEST_SCHEMA = "slice long, kind int, bucket int, keys binary, counts binary"
REPLY_SCHEMA = (
    "slice long, kind int, bucket int, totals binary, kept binary, n_words long, n_kept_words long"
)


def pack(values: np.ndarray) -> bytes:
    """An array as compressed planes of its bytes, after its length."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(raw: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    planes = pa.decompress(raw[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    octets = np.frombuffer(planes, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(octets.T).reshape(-1).view(dtype)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words of the texts, A-Z in lower case, and how many each has."""
    hashes, counts = [], []
    for part in _slices([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]):
        words, starts = _word_hashes(np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8))
        ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in part]))
        hashes.append(words)
        counts.append(np.diff(ends, prepend=0))
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def _sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents (doc_id, whether it is one, kind, text) as slices of one kind each."""
    place = TaskContext.get().partitionId() << 32
    waiting: dict[int, list] = {KEPT: [], DELETED: [], TEST: []}
    made = 0

    def closed(kind: int) -> pd.DataFrame:
        nonlocal made
        ids, valid, hashes, counts = (np.concatenate(x) for x in zip(*waiting[kind], strict=True))
        waiting[kind].clear()
        words, places = np.unique(hashes & ~LOW_BITS, return_inverse=True)
        made += 1
        line = (
            place + made - 1, kind, len(ids), len(hashes) + len(ids), pack(ids), pack(valid),
            pack(counts), pack(np.diff(words, prepend=np.uint64(0))), pack(places.astype(np.uint32)),
        )
        return pd.DataFrame([line], columns=SLICE_SCHEMA.replace(",", "").split()[::2])

    def tokens(kind: int) -> int:
        return sum(len(hashes) + len(ids) for ids, _, hashes, _ in waiting[kind])

    for rows in batches:
        for kind, group in rows.groupby("kind"):
            texts = group["text"].tolist()
            ids, valid = group["doc_id"].to_numpy(), group["valid"].to_numpy()
            # A few texts at once, so that a slice is not much larger than asked for.
            sizes = np.cumsum([len(t or "") + 1 for t in texts]) // (2 * SLICE_TOKENS)
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
                at = slice(part[0], part[-1] + 1)
                hashes, counts = word_hashes(texts[at])
                waiting[kind].append((ids[at], valid[at], hashes, counts.astype(np.int64)))
                if tokens(kind) >= SLICE_TOKENS:
                    yield closed(kind)
    for kind, held in waiting.items():
        if held:
            yield closed(kind)


@dataclass
class Grams:
    """The n-grams of a slice, by position: keys of one, two and three words, and where documents start."""

    keys: list[np.ndarray]
    starts: np.ndarray

    @classmethod
    def of(cls, words: bytes, places: bytes, lengths: bytes) -> "Grams":
        distinct = np.cumsum(unpack(words, np.uint64), dtype=np.uint64)
        counts = unpack(lengths, np.int64)
        ends = np.cumsum(counts)
        token = np.insert(distinct[unpack(places, np.uint32)], ends, END)
        starts = np.concatenate([[0], np.cumsum(counts + 1)[:-1]]).astype(np.int64)
        first = np.zeros(len(token), dtype=bool)
        first[starts] = True
        before = np.where(first, START, np.roll(token, 1))
        second = np.roll(first, 1) & ~first
        earlier = np.where(first | second, START, np.roll(token, 2))
        pair = mix(before * FACTORS[0] + token)
        triple = mix(mix(earlier * FACTORS[1] + before) * FACTORS[0] + token)
        keys = (mix(token), pair, triple)
        return cls([k & ~LOW_BITS | np.uint64(n) for n, k in enumerate(keys, start=1)], starts)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys in order, each once, and how often they occur."""
        keys = np.sort(np.concatenate(self.keys))
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[at], np.diff(at, append=len(keys))

    def context(self, counts: np.ndarray, documents: int) -> np.ndarray:
        """The counts of the positions before, those of a document's first being ``documents``."""
        out = np.roll(counts, 1)
        out[self.starts] = documents
        return out


def _asked(buckets: int):
    """Requests of a slice: its distinct keys and their counts, cut by ranges of keys."""
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples(index=False):
                keys, counts = Grams.of(row.words, row.places, row.lengths).distinct()
                cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
                lines = []
                for bucket, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if start < end:
                        told = pack(counts[start:end].astype(np.uint32)) if row.kind != TEST else None
                        delta = np.diff(keys[start:end], prepend=np.uint64(0))
                        lines.append((row.slice, row.kind, bucket, pack(delta), told))
                yield pd.DataFrame(lines, columns=["slice", "kind", "bucket", "keys", "counts"])

    return run


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: what all slices have of its keys, told to each that asked."""
    asked = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in rows["keys"]]
    keys = np.sort(np.concatenate(asked))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    places = [np.searchsorted(keys, k) for k in asked]
    del asked
    totals = {KEPT: np.zeros(len(keys), np.uint64), DELETED: np.zeros(len(keys), np.uint64)}
    for kind, at, counts in zip(rows["kind"], places, rows["counts"], strict=True):
        if kind != TEST:
            totals[kind][at] += unpack(counts, np.uint32)
    kept = totals[KEPT]
    both = kept + totals[DELETED]
    word = keys & LOW_BITS == 1
    out = pd.DataFrame(
        {
            "slice": rows["slice"],
            "kind": rows["kind"],
            "bucket": rows["bucket"],
            "totals": [pack(both[at]) for at in places],
            "kept": [pack(kept[at]) if kind == DELETED else None for kind, at in zip(rows["kind"], places, strict=True)],
            "n_words": 0,
            "n_kept_words": 0,
        }
    )
    # The bucket's known words are told once, with its first answer.
    out.loc[out.index[0], "n_words"] = int((both[word] > 0).sum())
    out.loc[out.index[0], "n_kept_words"] = int((kept[word] > 0).sum())
    return out


@dataclass
class Corpus:
    """What all estimates share: documents, tokens and distinct words counted."""

    documents: int
    tokens: int
    words: int


def _counted(grams: Grams, answers: pd.DataFrame, column: str) -> list[np.ndarray]:
    """The counts of a slice's words, pairs and triples, by position."""
    told = np.concatenate([unpack(x, np.uint64) for x in answers.sort_values("bucket")[column]])
    keys = np.concatenate(grams.keys)
    order = np.argsort(keys)
    keys = keys[order]
    counts = np.empty(len(keys), dtype=np.uint64)
    counts[order] = told[np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]]))]
    return np.split(counts, 3)


def _ratios(grams: Grams, counts: list[np.ndarray], corpus: Corpus) -> tuple[np.ndarray, ...]:
    """Per position the estimates of one, two, three words, and the buckets of both contexts."""
    one, two, three = counts
    before = grams.context(one, corpus.documents)
    pair = grams.context(two, corpus.documents)
    estimates = [one / max(1, corpus.tokens), two / np.maximum(before, 1), three / np.maximum(pair, 1)]
    digits = [np.frexp(x.astype(np.float64))[1].astype(np.uint8) for x in (before, pair)]
    return (*estimates, *digits)


@dataclass
class Weights:
    """Weights of the single word, and by bucket of the pair and of the triple."""

    one: float
    two: np.ndarray
    three: np.ndarray

    @classmethod
    def even(cls) -> "Weights":
        half = np.full(BUCKETS, 0.5)
        half[0] = 0
        return cls(0.5, half, half.copy())

    def mixed(self, f1, f2, f3, k2, k3, words: int):
        """The three mixes, and the shares of the estimate of highest order in each."""
        own = [self.one * f1, self.two[k2] * f2, self.three[k3] * f3]
        p1 = own[0] + (1 - self.one) / (words + 1)
        p2 = own[1] + (1 - self.two[k2]) * p1
        p3 = own[2] + (1 - self.three[k3]) * p2
        return p3, (own[0] / p1, own[1] / p2, own[2] / p3)

    def after(self, sums: np.ndarray) -> "Weights":
        """New weights from the expected counts: won and all, of each weight."""
        won, of = sums.reshape(2, -1)
        old = np.concatenate([[self.one], self.two, self.three])
        new = np.where(of > 0, won / np.where(of > 0, of, 1), old)
        new = np.clip(np.round(new, 6), LEAST_WEIGHT, 1 - LEAST_WEIGHT)
        two, three = new[1 : BUCKETS + 1], new[BUCKETS + 1 :]
        two[0] = three[0] = 0
        return Weights(float(new[0]), two, three)


def _expected(weights: Weights, words: int):
    """Expected counts of a task's positions, then the sum of their log2 probabilities."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(2 * (2 * BUCKETS + 1) + 2)
        for rows in batches:
            for row in rows.itertuples(index=False):
                f1, f2, f3 = (unpack(x, np.float32).astype(np.float64) for x in (row.f1, row.f2, row.f3))
                k2, k3 = unpack(row.k2, np.uint8), unpack(row.k3, np.uint8)
                p, (s1, s2, s3) = weights.mixed(f1, f2, f3, k2, k3, words)
                left3 = 1 - s3
                left2 = left3 * (1 - s2)
                by = [(k2, BUCKETS, left3 * s2, left3), (k3, BUCKETS, s3, np.ones_like(s3))]
                won, of = [[(left2 * s1).sum()]], [[left2.sum()]]
                for k, n, w, o in by:
                    won.append(np.bincount(k, w, n))
                    of.append(np.bincount(k, o, n))
                sums += np.concatenate([*won, *of, [np.log2(p).sum(), len(p)]])
        yield pd.DataFrame({"k": np.arange(len(sums)), "s": sums})

    return run


def learned_weights(learned_on: DataFrame, words: int) -> Weights:
    """Expectation-maximisation over staged estimates; likelihood grows until it gains too little."""
    weights, last = Weights.even(), None
    while True:
        told = learned_on.mapInPandas(_expected(weights, words), "k int, s double")
        rows = told.groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").collect()  # some 260
        sums = np.array([r["s"] for r in rows])
        if not len(sums) or not sums[-1]:
            return weights
        now = sums[-2] / sums[-1]
        if last is not None and now - last < GAIN:
            return weights
        weights, last = weights.after(sums[:-2]), now


def _estimated(corpus: Corpus):
    """The estimates of a slice of deleted documents, from the counts without them.

    Fifteen binary digits of each are kept, enough for weights of six decimals' use.
    """

    def run(slices: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = slices.iloc[0]
        grams = Grams.of(row["words"], row["places"], row["lengths"])
        f1, f2, f3, k2, k3 = _ratios(grams, _counted(grams, answers, "kept"), corpus)
        short = (f.astype(np.float32).view(np.uint32) & ~np.uint32(LOW_BITS) for f in (f1, f2, f3))
        line = [pack(f) for f in short] + [pack(k) for k in (k2, k3)]
        return pd.DataFrame([line], columns=["f1", "f2", "f3", "k2", "k3"])

    return run


def _scored(corpus: Corpus, weights: Weights):
    """Every document of a slice, from the counts of all training documents."""

    def run(slices: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = slices.iloc[0]
        grams = Grams.of(row["words"], row["places"], row["lengths"])
        counts = _counted(grams, answers, "totals")
        p, _ = weights.mixed(*_ratios(grams, counts, corpus), corpus.words)
        base = (counts[0] + 0.5) / (corpus.tokens + 0.5 * (corpus.words + 1))
        ids, valid = unpack(row["doc_ids"], np.int64), unpack(row["valid"], bool)
        return pd.DataFrame(
            {
                "doc_id": pd.Series(ids, dtype="Int64").where(valid, pd.NA),
                "held_out": bool(row["kind"] == TEST),
                "n_tokens": unpack(row["lengths"], np.int64) + 1,
                "n_known": np.add.reduceat(counts[0] > 0, grams.starts, dtype=np.int64),
                "train_tokens": corpus.tokens,
                "base_score": np.add.reduceat(np.log10(base), grams.starts),
                "score": np.add.reduceat(np.log10(p), grams.starts),
            }
        )

    return run


def score_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents whose crc32(doc_id) % 5 is not 1, the weights from those where
    it is 4. A null doc_id counts as an empty one. A null, empty or blank text is the end
    token alone. Rows that repeat are scored, and learned from, each; other columns are
    not read; an empty table gives no row. Without training documents every token has
    probability 1 of being unknown; without documents to learn the weights on, they are
    one half each.
    """
    ship_code(spark)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5
    kind = F.when(fold == 1, TEST).when(fold == 4, DELETED).otherwise(KEPT)
    rows = documents.select(
        # Never null, as pandas would make the ids of a batch with nulls floating-point numbers.
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("valid"),
        kind.alias("kind"),
        "text",
    )
    slices = staged(spark, rows.mapInPandas(_sliced, SLICE_SCHEMA), "lm-slices")
    sizes = {
        r["kind"]: r
        for r in slices.groupBy("kind").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t")).collect()
    }
    documents_of, tokens_of = (
        {k: sizes[k][c] if k in sizes else 0 for k in (KEPT, DELETED, TEST)} for c in "dt"
    )
    buckets = -(-sum(tokens_of.values()) // BUCKET_TOKENS) or 1
    asked = slices.select("slice", "kind", "words", "places", "lengths")
    asked = asked.mapInPandas(_asked(buckets), REQUEST_SCHEMA)
    answers = asked.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_answered, REPLY_SCHEMA)
    with arrow_rows(spark, SLICES):
        answers = staged(spark, answers, "lm-answers")
    words, kept_words = answers.agg(F.sum("n_words"), F.sum("n_kept_words")).first()
    kept = Corpus(documents_of[KEPT], tokens_of[KEPT], kept_words or 0)
    trained = Corpus(
        documents_of[KEPT] + documents_of[DELETED], tokens_of[KEPT] + tokens_of[DELETED], words or 0
    )

    def both(select, kind=None):
        pair = (slices, answers) if kind is None else (x.where(F.col("kind") == kind) for x in (slices, answers))
        left, right = pair
        return left.groupBy("slice").cogroup(right.select("slice", "bucket", select).groupBy("slice"))

    estimated = both("kept", DELETED).applyInPandas(
        _estimated(kept), "f1 binary, f2 binary, f3 binary, k2 binary, k3 binary"
    )
    learned_on = staged(spark, estimated, "lm-estimates", compression="zstd")
    with arrow_rows(spark, SLICES):
        weights = learned_weights(learned_on, kept.words)
    if not trained.tokens:
        weights = replace(weights, one=0.0)
    return both("totals").applyInPandas(
        _scored(trained, weights),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )

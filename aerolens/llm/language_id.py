"""Language identification (operator 2): averaged hashed subword embeddings
with a linear softmax, trained by stochastic gradient descent in numpy.

A text's subwords are the runs of 2, 3 and 4 bytes of its lower-cased letters
and single blanks, hashed into ``buckets``; the text is the average of their
embeddings. Probabilities are calibrated by a temperature fitted on rows kept
back from training.

Rejection is calibrated as well. A softmax over a few languages leans to one of
them whatever the text is, so what is asked is how familiar the text's subwords
are: the mean log-likelihood of its buckets in the language it was given, as a
deviation from that language's kept-back rows that allows for the text's length.
At most the share ``false_reject`` of kept-back rows lies below the threshold. It
is put halfway between that deviation and the one above which 5 % of the same
rows lie if their own language is taken away, where the latter is lower. With
fewer than ``LEAST_KEPT`` rows kept back only texts without letters are rejected.

Training reads a bounded sample of labelled rows: at most ``max_rows``, spread
over the languages, chosen by a hash of the id, one text for each id and
language, whole texts. What comes to the driver is their bucket counts. A
language with no row in the sample cannot be predicted. Prediction looks at
whole texts, in numpy, inside the scan.

Null or empty texts and texts without a letter get ``und`` with score 0. With
no labelled row at all (as in an empty table), every row is ``und``. Repeated
rows and repeated ids each give their own row; in training, rows of one id and
language count once. Very long texts are read whole. Columns other than id, text
and language are not read; ``accepted`` passes them on whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolens.llm.common import Block, blocks, column, documents, give_back, map_rows, place, text_array

UNKNOWN = "und"
BUCKETS = 1 << 15
SIZES = (2, 3, 4)
#: Rows kept back from which on rejection is calibrated.
LEAST_KEPT = 40
#: Added to each bucket's count; subwords of a text that count as one independent
#: observation, as they overlap; subwords of a text that count at most in training.
SMOOTH, OVERLAP, MOST = 0.1, 3, 2000

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def subwords(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of a block and the row of each."""
    data = _LETTERS[block.data]
    blank = data == 0
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    row = np.repeat(np.arange(block.rows, dtype=np.int32), np.diff(block.ends))[keep]
    data = data[keep].astype(np.uint32)
    found, rows = [], []
    code = data
    for size in range(2, max(SIZES) + 1):
        if len(data) < size:
            break
        code = code[:-1] << np.uint32(8) | data[size - 1 :]
        if size in SIZES:
            hashed = (code ^ np.uint32(size * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x85EBCA77)
            same = row[: len(code)] == row[size - 1 :]
            found.append((hashed >> np.uint32(17))[same])
            rows.append(row[: len(code)][same])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(found), np.concatenate(rows)


def has_letter(block: Block, row: int) -> bool:
    part = block.data[block.ends[row] : block.ends[row + 1]]
    if (_LETTERS[part] & 0x80 == 0)[_LETTERS[part] > 0].any():
        return True
    return any(map(str.isalpha, part.tobytes().decode("utf-8", "replace")))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # what each bucket adds to each language
    bias: np.ndarray
    temperature: float
    familiar: np.ndarray  # log-likelihood of each bucket in each language
    usual: np.ndarray  # for each language mean, variance of a subword, variance between texts
    reject_below: float  # deviation from the usual

    def probabilities(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        logits = (sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)

    def deviation(self, mean: np.ndarray, n: np.ndarray, language: np.ndarray) -> np.ndarray:
        """How far a text's mean log-likelihood lies from its language's, in
        standard deviations for texts of ``n`` subwords."""
        middle, each, between = self.usual[language].T
        return (mean - middle) / np.sqrt(each * OVERLAP / np.maximum(n, 1) + between)


def _counts(docs: DataFrame) -> DataFrame:
    """lang, fold, and the buckets of each text with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, many = [], []
            for block in blocks(text_array(batch)):
                bucket, row = subwords(block)
                key, n = np.unique(row.astype(np.int64) * BUCKETS + bucket, return_counts=True)
                cut = np.searchsorted(key, np.arange(block.rows + 1) * BUCKETS)
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    held.append((key[a:b] % BUCKETS).astype("<u2").tobytes())
                    many.append(n[a:b].astype("<u4").tobytes())
            at = batch.schema.get_field_index
            yield pa.RecordBatch.from_arrays(
                [batch.column(at("lang")), batch.column(at("fold")), pa.array(held, pa.binary()), pa.array(many, pa.binary())],
                ["lang", "fold", "buckets", "counts"],
            )

    return docs.mapInArrow(count, "lang string, fold int, buckets binary, counts binary")


def train(
    df: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = 1200,
    dimensions: int = 16,
    epochs: int = 12,
    rate: float = 0.5,
    seed: int = 7,
    false_reject: float = 0.005,
) -> Model:
    """Fits the model on at most ``max_rows`` labelled rows for which
    ``usable`` (an expression over ``doc_id``) holds. ``false_reject`` is the
    share of texts in learned languages that may be rejected."""
    labelled = df.select(
        column(df, id_col).cast("long").alias("doc_id"),
        column(df, text_col).cast("string").alias("text"),
        column(df, lang_col).cast("string").alias("lang"),
    )
    labelled = labelled.where("lang is not null and text is not null and doc_id is not null")
    if usable is not None:
        labelled = labelled.where(usable)
    # The sample is chosen on narrow, distinct rows: of each language a few times
    # its share by a hash threshold, then that share exactly.
    seen = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("doc_id").alias("ids"))
    seen = seen.orderBy(F.desc("n"), "lang").limit(max_rows).collect()
    languages = [r["lang"] for r in seen]
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, np.zeros((BUCKETS, 0)), np.zeros((0, 3)), -np.inf)
    each = max(1, max_rows // len(languages))
    few = {r["lang"]: min(1.0, 4 * each / max(r["ids"], 1)) for r in seen}
    top = (1 << 63) - 1
    edges = ((F.lit(lang), F.lit(min(int(part * top), top)).cast("long")) for lang, part in few.items())
    below = F.create_map(*(x for edge in edges for x in edge))
    draw = F.xxhash64("doc_id", F.lit(seed))
    near = labelled.where(F.shiftrightunsigned(draw, 1) <= below[F.col("lang")])
    named = near.groupBy("lang", "doc_id").agg(F.first(draw).alias("draw"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    chosen = named.withColumn("place", place).where(F.col("place") <= each).select("lang", "doc_id")
    # Rows that share an id and a language are one example, so the bound holds for
    # any table; the list broadcast has max_rows rows at most.
    rows = labelled.join(F.broadcast(chosen), ["lang", "doc_id"])
    rows = rows.groupBy("lang", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(5)).cast("int").alias("fold")
    sample = _counts(rows.select("lang", fold, "text")).collect()
    languages = sorted({r["lang"] for r in sample})
    examples = []
    for r in sorted(sample, key=lambda r: (r["lang"], bytes(r["buckets"]), bytes(r["counts"]))):
        bucket = np.frombuffer(r["buckets"], "<u2").astype(np.int64)
        if len(bucket):
            n = np.frombuffer(r["counts"], "<u4").astype(np.float32)
            examples.append((bucket, n / n.sum(), languages.index(r["lang"]), r["fold"], float(n.sum())))
    return _fit(examples, languages, dimensions, epochs, rate, seed, false_reject)


def _fit(examples, languages, dimensions, epochs, rate, seed, false_reject) -> Model:
    draw = np.random.default_rng(seed)
    embed = draw.uniform(-1, 1, (BUCKETS, dimensions)).astype(np.float32) / dimensions
    weight = np.zeros((dimensions, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    fitted = [x for x in examples if x[3] != 0] or examples
    steps = epochs * len(fitted)
    for k in range(epochs):
        for i, e in enumerate(draw.permutation(len(fitted))):
            bucket, share, label, *_ = fitted[e]
            step = rate * (1 - (k * len(fitted) + i) / steps)
            mean = share @ embed[bucket]
            logits = mean @ weight + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = weight @ p
            weight -= step * np.outer(mean, p)
            bias -= step * p
            # Scaled up: each bucket has but a small share of an average.
            embed[bucket] -= (step * len(bucket) ** 0.5) * share[:, None] * back
    table = embed @ weight
    kept_back = [x for x in examples if x[3] == 0] or fitted
    logits = np.array([share @ table[bucket] + bias for bucket, share, *_ in kept_back]).reshape(-1, len(languages))
    labels = np.array([x[2] for x in kept_back], np.int64)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), labels])) if len(z) else 0.0

    temperature = min((float(2.0**x) for x in np.arange(-6, 6.01, 0.25)), key=loss)
    familiar, usual, below = _familiarity(fitted, kept_back, len(languages), false_reject)
    return Model(tuple(languages), table.astype(np.float32), bias, temperature, familiar, usual, below)


def _familiarity(fitted, kept_back, many: int, false_reject: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Log-likelihoods of buckets by language, what is usual for each language's
    kept-back rows, and the deviation that the share ``false_reject`` of them exceeds."""
    held = np.zeros((BUCKETS, many))
    for bucket, share, label, _, n in fitted:
        held[bucket, label] += share * min(n, MOST)
    familiar = np.log((held + SMOOTH) / (held.sum(axis=0) + SMOOTH * BUCKETS))
    usual = np.ones((many, 3))
    seen = []  # language, mean, variance of a subword, subwords
    for bucket, share, label, _, n in kept_back:
        own = familiar[bucket, label]
        mean = float(share @ own)
        seen.append((label, mean, float(share @ (own - mean) ** 2), n))
    found = np.array(seen).reshape(-1, 4)
    for k in range(many):
        _, mean, each, n = found[found[:, 0] == k].T
        if len(mean):
            middle = np.average(mean, weights=np.minimum(n, 500))
            # Medians, as a text may be odd: of a normal deviate's square it is 0.455.
            spread = np.median((mean - middle) ** 2) / 0.455 - np.median(each * OVERLAP / n)
            usual[k] = middle, np.median(each), max(spread, 1e-4)
    if len(found) < LEAST_KEPT:
        return familiar.astype(np.float32), usual, -np.inf
    model = Model((), familiar, np.zeros(0), 1.0, familiar, usual, 0.0)
    below = float(np.quantile(model.deviation(found[:, 1], found[:, 3], found[:, 0].astype(int)), false_reject))
    # The same rows as if their language had not been learned: what is to go.
    strange = []
    for bucket, share, label, _, n in kept_back if many > 1 else ():
        means = share @ familiar[bucket]
        means[label] = -np.inf
        strange.append((means.argmax(), means.max(), n))
    if strange:
        other, mean, n = np.array(strange).T
        below = min(below, (below + float(np.quantile(model.deviation(mean, n, other.astype(int)), 0.95))) / 2)
    return familiar.astype(np.float32), usual, below


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and rejected, for every row."""
    kept = documents(df, id_col, text_col)
    return kept.mapInArrow(
        _predictor(model, ["doc_id"]), "doc_id long, lang_pred string, score double, rejected boolean"
    )


def accepted(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not rejected, with their own columns."""
    text = place(df.columns.index(text_col))
    return map_rows(df, _predictor(model, [], text, only_accepted=True))


def _predictor(model: Model, keep: list[str], text_col: str = "text", only_accepted: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, rejected = [], [], []
            for block in blocks(text_array(batch, text_col)):
                bucket, row = subwords(block)
                n = np.bincount(row, minlength=block.rows)
                sums = np.stack(
                    [np.bincount(row, model.table[bucket, k], block.rows) for k in range(len(model.languages))] or [n * 0.0],
                    axis=1,
                )
                if model.languages:
                    p = model.probabilities(sums, n)
                    best = p.argmax(axis=1)
                    mean = np.bincount(row, model.familiar[bucket, best[row]], block.rows) / np.maximum(n, 1)
                    far = model.deviation(mean, n, best) < model.reject_below
                else:
                    p, best, far = sums, n * 0, n >= 0
                for r in range(block.rows):
                    known = bool(model.languages) and has_letter(block, r)
                    langs.append(model.languages[best[r]] if known else UNKNOWN)
                    scores.append(min(1.0, float(p[r, best[r]])) if known else 0.0)
                    rejected.append(not known or bool(far[r]))
            if only_accepted:
                yield batch.filter(pa.array([not x for x in rejected], pa.bool_()))
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*keep, "lang_pred", "score", "rejected"],
            )
        give_back()

    return run

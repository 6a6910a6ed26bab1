"""Language of a text by error-correcting output codes.

Every language gets a codeword; bit ``j`` splits the languages in two, and a binary
classifier over byte n-grams predicts it: the log-odds of each n-gram under the languages
on either side (equal weight per language). A text's margins are the mean log-odds of its
n-grams; decoding adds up a logistic loss per bit, weighted by how well that bit separates
the languages it was learned from, and takes the codeword with the least loss. If the
runner-up is close the answer is flagged as ambiguous.

Counts are learned from every labelled training row: tasks count the n-grams of their own
texts and send one row per language and n-gram bucket. The model is a table of ``BUCKETS``
x bits numbers, whatever the size of the corpus.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import by_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 14
GRAM = 3
SMOOTH = 0.5
MOST_EXHAUSTIVE = 5  # languages; beyond, codewords are searched
SEED = 5
AMBIGUOUS = 0.2
CHUNK = 1 << 20
CELLS = 1 << 20
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def remainder(n: int) -> Column:
    """crc32 of the doc_id as text, modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def codewords(n: int) -> np.ndarray:
    """Rows of +1/-1, one per language: all ways to split few languages in two; for more, the
    best of seeded random codes by the least distance between two codewords."""
    if n <= MOST_EXHAUSTIVE:
        columns = [(1, *c) for c in product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(columns or [(1,) * n], dtype=np.int8).T
    bits, rng = int(np.ceil(10 * np.log2(n))), np.random.default_rng([SEED, n])
    best, most = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        code = code[:, np.abs(code.sum(0, dtype=int)) < n]
        agree = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(agree, -bits)
        if (far := code.shape[1] - agree.max()) > most:
            best, most = code, far
    return best


def _grams(text: bytes) -> Iterator[np.ndarray]:
    """Bucket of each byte n-gram of a text, a chunk at a time."""
    data = np.frombuffer(b" " + text.lower() + b" ", dtype=np.uint8)
    for at in range(0, len(data) - GRAM + 1, CHUNK):
        b = data[at : at + CHUNK + GRAM - 1].astype(np.uint32)
        code = b[:-2] * np.uint32(0x01000193) ^ b[1:-1] * np.uint32(0x9E3779B1) ^ b[2:] * np.uint32(0x85EBCA6B)
        yield (code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - 14)


def _count(batch: pa.RecordBatch) -> Iterator[dict]:
    langs = batch.column("lang").to_pylist()
    sums: dict[str, np.ndarray] = {}
    for lang, text in zip(langs, batch.column("text").to_pylist(), strict=True):
        total = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
        for grams in _grams(text):
            total += np.bincount(grams, minlength=BUCKETS)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield {"lang": pa.array([lang] * len(at), pa.string()), "bucket": at.astype(np.int32), "n": total[at]}


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    odds: np.ndarray  # buckets x bits
    weight: np.ndarray  # of each bit

    def decode(self, margins: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Probability-like scores per language from mean margins of ``n`` n-grams; a slice of
        rows at a time, so that rows x languages x bits stays within ``CELLS``."""
        strength = margins * np.sqrt(n)[:, None]
        step = max(1, CELLS // max(1, self.code.size))
        out = np.zeros((len(margins), len(self.code)))
        for at in range(0, len(margins), step):
            loss = np.logaddexp(0, -strength[at : at + step, None, :] * self.code[None]) @ self.weight
            p = np.exp(loss.min(1, keepdims=True) - loss)
            out[at : at + step] = p / p.sum(1, keepdims=True)
        return out


def learn(docs: DataFrame) -> Model:
    """Fit on all rows of ``docs (lang, text)`` that have both."""
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.col("text").cast("binary").alias("text"))
    # As many rows as languages times buckets come to the driver.
    counts = by_batch(rows, _count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counts.column("lang").to_pylist(), dtype=object)
    langs = sorted(set(names))
    if not langs:
        return Model([], np.zeros((0, 1)), np.zeros((BUCKETS, 1), dtype=np.float32), np.zeros(1))
    table = np.full((len(langs), BUCKETS), SMOOTH)
    row = np.searchsorted(np.array(langs, dtype=object), names)
    table[row, counts.column("bucket").to_numpy()] += counts.column("n").to_numpy()
    p = table / table.sum(1, keepdims=True)
    code = codewords(len(langs))
    odds = np.zeros((BUCKETS, code.shape[1]))
    for j in range(code.shape[1]):
        plus, minus = code[:, j] > 0, code[:, j] < 0
        if minus.any():
            odds[:, j] = np.log(p[plus].mean(0)) - np.log(p[minus].mean(0))
    apart = np.maximum((p @ odds) * code, 0).min(0) + 1e-6
    return Model(langs, code, odds.astype(np.float32), apart / apart.sum() * len(apart))


def _predictor(model: Model):
    def predict(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column("text").to_pylist()
        margins, n = np.zeros((len(texts), model.odds.shape[1])), np.ones(len(texts))
        known = np.zeros(len(texts), dtype=bool)
        for i, text in enumerate(texts):
            if not text or not model.langs or not (LETTER.search(text[:64].decode("utf-8", "ignore")) or LETTER.search(text.decode("utf-8", "replace"))):
                continue
            known[i], total, size = True, np.zeros(BUCKETS, dtype=np.int64), 0
            sums = np.zeros(model.odds.shape[1])
            for grams in _grams(text):
                size += len(grams)
                if len(grams) < BUCKETS:
                    sums += model.odds[grams].sum(0, dtype=np.float64)
                else:
                    total += np.bincount(grams, minlength=BUCKETS)
            if total.any():
                sums += total @ model.odds.astype(np.float64)
            margins[i], n[i] = sums / max(1, size), max(1, size)
        if model.langs:
            p = model.decode(margins, n)
            best = p.argmax(1)
            score = p[np.arange(len(texts)), best]
            second = np.sort(p, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(len(texts))
        else:
            best, score, second = np.zeros(len(texts), dtype=int), np.zeros(len(texts)), np.zeros(len(texts))
        yield {
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "lang_pred": pa.array([model.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
            "score": np.where(known, score, 0.0),
            "ambiguous": known & (score - second < AMBIGUOUS),
        }

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, ambiguous``.

    Learned from the rows with a language whose crc32(doc_id) modulo 4 is not 2. Texts that
    are null or have no letter, and all texts if nothing could be learned, are ``und`` with
    score 0. Of languages with equal scores the first by name is taken. A null doc_id is neither held out nor learned from. Repeated rows stay; an
    empty table gives no rows. Only doc_id, text and lang are read, and lang only to learn.
    """
    model = learn(docs.filter(remainder(4) != 2))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id",
        F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
        F.col("text").cast("binary").alias("text"),
    )
    return by_batch(
        rows, _predictor(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )

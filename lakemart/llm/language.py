"""Language identification by error-correcting output codes.

Every language has a codeword; one binary classifier over character n-grams predicts each of its bits. The language
whose codeword costs the least loss over all bits wins, and a close second one marks the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import stored

#: Labelled texts that are learned from, shared evenly by the languages; the driver gets 16 kB for each.
SAMPLE_TEXTS = 4000
BUCKETS = 4096
#: ASCII bytes that are no letters become spaces.
LETTERS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))
#: Bytes of a text that are turned into n-grams at a time.
STEP = 1 << 20


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def features(text: str) -> np.ndarray:
    """Square roots of the counts of hashed 2- and 3-byte n-grams of the lower-cased text, of length 1."""
    data = b" " + text.lower().encode().translate(LETTERS) + b" "
    counts = np.zeros(BUCKETS)
    for k in range(0, len(data), STEP):
        raw = np.frombuffer(data[k:k + STEP + 2], np.uint8).astype(np.uint32)
        if len(raw) < 3:
            break
        pair = raw[:-1] * np.uint32(0x9E3779B1) + raw[1:] * np.uint32(0x85EBCA6B)
        triple = (pair[:-1] ^ (pair[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE35) + raw[2:] * np.uint32(0x27D4EB2F)
        for code in (pair[:-1], triple):
            counts += np.bincount((code * np.uint32(0x165667B1)) >> np.uint32(20), minlength=BUCKETS)
    # Two spaces in a row say nothing about the language.
    counts[(32 * (0x9E3779B1 + 0x85EBCA6B) * 0x165667B1 & 0xFFFFFFFF) >> 20] = 0
    root = np.sqrt(counts)
    return (root / max(1.0, np.linalg.norm(root))).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 per language: all distinct splits up to five languages, else the best of random codes."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        masks = np.arange(1, 2 ** (n - 1))
        return np.where(masks[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    bits = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(seed)
    best, most = None, -1
    for _ in range(200):
        code = np.where(rng.random((n, bits)) < 0.5, 1.0, -1.0)
        apart = (bits - code @ code.T) / 2 + bits * np.eye(n)
        if apart.min() > most and (np.abs(code.sum(axis=0)) < n).all():
            best, most = code, apart.min()
    return best


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: one column per bit, the last row is the bias; ``code``: one row per language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray

    def predict(self, text: str | None, margin: float = 0.2) -> tuple[str, float, bool]:
        """Language, score (0 to 1) and whether the second best is within ``margin`` of the score."""
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        margins = features(text) @ self.weights[:-1] + self.weights[-1]
        # Logistic loss of each bit against each codeword: confident bits weigh more than doubtful ones.
        loss = np.logaddexp(0, -self.code * margins).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(share.argmax())
        second = np.partition(share, -2)[-2] if len(share) > 1 else 0.0
        return self.languages[best], float(share[best]), bool(share[best] - second < margin)


def train(x: np.ndarray, languages: list[str], seed: int = 7, rounds: int = 150, decay: float = 1e-4) -> LanguageModel:
    """Logistic regressions of all bits at once by Adam over the whole sample; languages weigh the same."""
    names = sorted(set(languages))
    code = codewords(len(names), seed)
    row = np.array([names.index(v) for v in languages], int)
    target = code[row]
    weight = (1 / np.bincount(row, minlength=len(names))[row])[:, None] / max(1, len(names))
    w = np.zeros((x.shape[1] + 1, code.shape[1]), np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1 if len(names) > 1 else 1):
        pull = (-target * weight / (1 + np.exp(target * (x @ w[:-1] + w[-1])))).astype(np.float32)
        gradient = np.vstack([x.T @ pull, pull.sum(axis=0)]) + decay * w
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        w -= 0.5 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return LanguageModel(names, code, w)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: a quarter, by crc32 of the id's text; null counts as empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """A model of the languages in ``lang``, from texts that are not held out and have a letter.

    Each language gives its share of ``sample_texts`` (one at least): the rows with the smallest hashes of doc_id and
    text. A bound on the hash, from the language's number of rows, leaves few more than that to be put in order.
    Features are made on the executors.
    """
    hashed = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("hash"))
    counts = stored(hashed.groupBy("lang").agg(F.count("*").alias("rows"), F.min("hash").alias("first")),
                    "language-counts")
    each = max(1, sample_texts // max(1, counts.count()))
    share = F.least(F.lit(1.0), F.lit(each + 5 * each**0.5 + 5) / F.col("rows"))
    bound = F.greatest(F.col("first"), ((share - 0.5) * 2.0**64).cast("long"))
    near = hashed.join(counts.select("lang", bound.alias("bound")), "lang").where("hash <= bound")
    by_hash = Window.partitionBy("lang").orderBy("hash")
    sample = near.withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= each).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, features(text).tobytes()) for lang, text in
                    zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) if has_letter(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["lang", "features"])

    rows = sample.mapInArrow(run, "lang string, features binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["features"]))
    x, names = np.empty((len(rows), BUCKETS), np.float32), [r["lang"] for r in rows]
    for k in range(len(rows) - 1, -1, -1):
        x[k] = np.frombuffer(rows.pop()["features"], np.float32)
    return train(x, names)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row of ``docs``; only the text is looked at.

    Null texts and texts without a letter are "und" with score 0. Very long texts are read whole, in steps. Without a
    single labelled text every document is "und". Repeated rows are treated alike; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch["text"]]
            language, score, ambiguous = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(language, pa.string()),
                                              pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                                             ["doc_id", "lang_pred", "score", "ambiguous"])

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = source.select("doc_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
                        F.lit(True).alias("ambiguous")).schema
    return source.mapInArrow(run, out)


def language_report(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")

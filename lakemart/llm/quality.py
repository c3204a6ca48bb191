"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, documents go by posterior."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakemart.llm.common import cut, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
#: Each rule's measure votes bad at or over the first bound and good at or under the second; between them it abstains.
RULES = {
    "symbols": (0.1, 0.02),        # symbols by word
    "repeats": (0.5, 0.1),         # share of words in repeated three-word windows
    "dup_lines": (0.5, 0.1),       # share of lines that repeat an earlier one
    "upper": (0.4, 0.1),           # share of ASCII letters that are capitals
    "other": (0.35, 0.25),         # share of characters that are no letters
    "marks": (0.3, 0.05),          # exclamation marks by word
    "open_lines": (0.6, 0.1),      # share of lines that end without a mark
    "long_words": (12.0, 9.0),     # characters by word
}
GOOD, ABSTAIN, BAD = "0", "1", "2"
#: Each vote's chance before any data, for good and for bad documents, and its weight as a share of the corpus.
PRIOR = np.array([[0.75, 0.24, 0.01], [0.25, 0.25, 0.5]])
PRIOR_WEIGHT = 0.02


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    # Pairs are numbered anew, so that three words make a number below the square of n.
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The counts, then one vote per rule as a string."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    raw = np.frombuffer(data, np.uint8)
    counts = np.bincount(raw, minlength=256)
    points = len(data) - int(counts[0x80:0xC0].sum())
    chars = points - int(counts[list(SPACES)].sum())
    symbols = int(counts[list(SYMBOLS)].sum())
    seen: set[bytes] = set()
    lines = dup = open_lines = 0
    for line in data.split(b"\n"):
        if stripped := line.rstrip(SPACES):
            lines += 1
            open_lines += stripped[-1] not in b".!?\"':;)"
            dup += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    capitals = int(counts[65:91].sum())
    ascii_letters = capitals + int(counts[97:123].sum())
    letters = ascii_letters + int(counts[0xC0:].sum())
    values = (symbols / max(1, n), repeats / max(1, n), dup / max(1, lines), capitals / max(1, ascii_letters),
              1 - letters / max(1, points), int(counts[33]) / max(1, n), open_lines / max(1, lines), chars / max(1, n))
    votes = "".join(BAD if v >= bad else GOOD if v <= good else ABSTAIN
                    for v, (bad, good) in zip(values, RULES.values(), strict=True))
    return n, chars, symbols, dup, repeats, votes if n else ABSTAIN * len(RULES)


STATS = StructType([*(StructField(c, LongType()) for c in COUNTS), StructField("votes", StringType())])


@F.arrow_udf(STATS)
def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        columns = list(zip(*(measure(t.as_py()) for t in texts), strict=True)) or [[]] * (len(COUNTS) + 1)
        yield pa.StructArray.from_arrays(
            [pa.array(c, pa.string() if k == len(COUNTS) else pa.int64()) for k, c in enumerate(columns)],
            names=[*COUNTS, "votes"])


def stats(text: Column) -> Column:
    """A struct of the counts and ``votes``, one digit per rule: 0 good, 1 abstains, 2 bad. Null counts as empty."""
    return _measured(text.cast("string"))


@dataclass(frozen=True)
class VoteModel:
    """``prior``: log odds of good; ``weights``: what each rule's vote adds to them."""

    prior: float
    weights: list[list[float]]

    def posterior(self, votes: Column) -> Column:
        odds = F.lit(self.prior)
        for k, by_vote in enumerate(self.weights):
            odds += F.element_at(F.array(*map(F.lit, by_vote)), F.substring(votes, k + 1, 1).cast("int") + 1)
        return 1 / (1 + F.exp(-odds))

    def accuracies(self) -> dict[str, float]:
        """How much more likely each rule's bad vote is for bad documents than for good ones."""
        return {name: float(np.exp(-w[int(BAD)])) for name, w in zip(RULES, self.weights, strict=True)}


def fit(patterns: dict[str, int], rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over the numbers of documents by vote pattern.

    Every rule has its own chances of each vote for good and for bad documents. The prior counts keep the two classes
    apart where a corpus has next to no bad documents; they grow with it, so results do not depend on its size.
    """
    total = float(sum(patterns.values()))
    votes = np.array([[int(v) for v in p] for p in patterns], int).reshape(-1, len(RULES))
    count = np.array(list(patterns.values()), float)
    weight = max(1.0, PRIOR_WEIGHT * total)
    bad = np.where((votes == int(BAD)).any(axis=1), 0.9, 0.05)
    while True:
        each = np.stack([count * (1 - bad), count * bad])
        share = (each.sum(axis=1) + weight) / (total + 2 * weight)
        seen = np.stack([(each[:, :, None] * (votes == v)).sum(axis=1) for v in range(3)], axis=-1)
        chance = (seen + weight * PRIOR[:, None, :]) / (each.sum(axis=1)[:, None, None] + weight)
        gain = np.log(chance[0]) - np.log(chance[1])
        odds = np.log(share[0] / share[1]) + gain[np.arange(len(RULES)), votes].sum(axis=1)
        before, bad = bad, 1 / (1 + np.exp(np.clip(odds, -500, 500)))
        rounds -= 1
        if not rounds or not len(bad) or np.abs(bad - before).max() < 1e-9:
            return VoteModel(float(np.log(share[0] / share[1])), gain.tolist())


def fit_votes(measured: DataFrame, votes: str = "votes") -> VoteModel:
    """The model of all rows; the driver sees one count per vote pattern, 3 to the number of rules at most."""
    return fit({r[0]: r[1] for r in measured.groupBy(votes).count().orderBy(votes).collect()})


def _base_failed(s: str = "") -> Column:
    n, repeats = F.col(f"{s}n_words"), F.col(f"{s}n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def quality_report(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, base_failed, kept, posterior and votes for every row of ``docs``.

    Null, empty and white-space texts have no words: all rules abstain and they fail as too short. Repeated rows are
    counted as often as they come; whole texts are read; further columns are not; an empty table gives no rows.
    """
    measured = cut(docs.select("doc_id", stats(F.col("text")).alias("s")).select("doc_id", "s.*"))
    model = fit_votes(measured)
    return (measured.withColumn("base_failed", _base_failed())
            .withColumn("posterior", model.posterior(F.col("votes")))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
            .select("doc_id", *COUNTS, "base_failed", "kept", "posterior", "votes"))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_report` keeps, unchanged; edge cases as there.

    Texts are measured once: votes are written with the rows that pass the base rules, and the model then picks among these.
    """
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")
    measured = docs.select(row, stats(docs["text"]).alias("s"))
    written = stored(measured.select(F.when(~_base_failed("s."), F.col("row")).alias("row"), "s.votes"), "quality-votes")
    model = fit_votes(written)
    return written.where(F.col("row").isNotNull() & (model.posterior(F.col("votes")) >= threshold)).select("row.*")

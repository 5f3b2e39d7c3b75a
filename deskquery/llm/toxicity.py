"""Toxic passages by maximum-scoring segment search.

Tokens, by the whole word or by how they begin, get the log odds of toxic
against other labelled documents, with an informative Dirichlet prior from both together; those whose log odds stand out
from their own error, also when every pair of neighbours counts once (so that
copies weigh nothing), are the toxic tokens, and all others count a small loss.
One linear scan of a text finds every maximal-scoring segment, that is every
passage that is denser in toxic tokens than its surroundings. Segment scores
follow an extreme-value law on ordinary text: its decay solves
sum(p * exp(decay * score)) = 1 over the tokens of ordinary documents. The scores
of a document's significant segments add up to an expected number of such
passages in ordinary text of its length, and the document's score is the chance
that ordinary text has none.

Cases: null, empty and wordless texts score 0; texts of any length work, in time
linear in the text and memory proportional to one batch; repeated rows are
scored alike; without labels of both classes every score is 0; an empty table
gives an empty result; ids are whole numbers (others raise), and a null id is
scored and never fitted on; other columns are not carried, so they cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices

LOSS = -0.5  # of a token that is not toxic
STANDS_OUT = 3.0  # standard errors above zero, of a candidate by documents
CERTAIN = 5.0  # and of a toxic token by distinct surroundings
PRIOR = 50.0  # pseudo-documents of the prior
TOP = 6.0  # no token scores more
STEMS = (4, 5, 6, 7)  # letters of a token's beginning
K = 0.1  # of the extreme-value law
SIGNIFICANT = 0.05
_KEPT = 200_000
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def marks(word: str) -> list[str]:
    """What a token may be toxic by: the whole word, or how it begins, since stems take endings."""
    return [f"{word} ", *(word[:k] for k in STEMS if len(word) >= k)]


class Model:
    """scores of toxic marks and the decay of the extreme-value law; no scores: nothing is toxic."""

    def __init__(self, scores: dict[str, float], decay: float):
        self.scores, self.decay = scores, decay
        self.known: dict[str, float | None] = {}

    def of(self, word: str) -> float | None:
        """The token's score, the largest of its marks; None if it is not toxic."""
        if len(self.known) > _KEPT:
            self.known.clear()
        found = self.known[word] = max((self.scores[m] for m in marks(word) if m in self.scores), default=None)
        return found

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        """(score, start, end) of every maximal segment, in order (Ruzzo and Tompa)."""
        known = self.known
        found: list[list] = []  # [sum before, sum after, start, end]
        total, last = 0.0, 0
        for i, w in enumerate(words):
            s = known[w] if w in known else self.of(w)
            if s is None:
                continue
            total += LOSS * (i - last)
            last = i + 1
            before, total, start = total, total + s, i
            while found:
                j = len(found) - 1
                while j >= 0 and found[j][0] >= before:
                    j -= 1
                if j < 0 or found[j][1] >= total:
                    break
                before, start = found[j][0], found[j][2]
                del found[j:]
            found.append([before, total, start, i + 1])
        return [(b - a, s, e) for a, b, s, e in found]

    def chance(self, score: float, n: int) -> float:
        """Expected number of segments of that score in n tokens of ordinary text."""
        return K * n * math.exp(-self.decay * score)

    def score(self, text: str | None) -> float:
        words = tokens(text)
        found = [s for s, _, _ in self.segments(words)]
        if not found:
            return 0.0
        n = len(words)
        strong = [s for s in found if self.chance(s, n) < SIGNIFICANT] or [max(found)]
        return math.exp(-min(self.chance(sum(strong), n), 700.0))

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """Significant segments as (first token, end, score)."""
        words = tokens(text)
        return [(s, e, x) for x, s, e in self.segments(words) if self.chance(x, len(words)) < SIGNIFICANT]


def count(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """token (a mark) and the number of labelled documents of either class that hold it, n0 and n1; the empty token counts the documents, a space their tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in seen)], ["token", "n0", "n1"])

        for b in slices(batches, 0):
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = tokens(text)
                seen[label].update({m for w in set(words) for m in marks(w)})
                seen[label].update({"": 1, " ": len(words)})
            if len(seen[0]) + len(seen[1]) > _KEPT:
                yield out()
                seen[0].clear()
                seen[1].clear()
        yield out()

    return _labelled(docs, labelled).mapInArrow(run, "token string, n0 long, n1 long").groupBy("token").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labelled: DataFrame) -> Model:
    """The model of the labelled documents. labelled: doc_id and label, of bounded size, which bounds the tokens too."""
    counts = cut(count(docs, labelled))
    totals = {r.token: r for r in counts.filter(F.col("token").isin("", " ")).collect()}
    if "" not in totals or not totals[""].n0 or not totals[""].n1:
        return Model({}, 1.0)
    d0, d1 = totals[""].n0, totals[""].n1
    rows = counts.filter(~F.col("token").isin("", " ")).withColumns(_odds(F.col("n0"), F.col("n1"), d0, d1)).filter((F.col("delta") > 1) & (F.col("delta") > STANDS_OUT * F.col("error")))
    candidates = [r.token for r in rows.select("token").collect()]
    # Copies of one toxic document make all its words look toxic. In distinct surroundings they count once.
    told = contexts(docs, labelled, frozenset(candidates)).withColumns(_odds(F.col("n0"), F.col("n1"), d0, d1))
    toxic = [(r.token, min(r.delta, TOP), r.n0) for r in told.filter((F.col("delta") > 1) & (F.col("delta") > CERTAIN * F.col("error"))).collect()]
    ordinary = max(1, totals[" "].n0)
    return Model({t: s for t, s, _ in toxic}, _decay([(s, (n0 + 0.5) / ordinary) for _, s, n0 in toxic]))


def _odds(n0, n1, d0: int, d1: int) -> dict:
    """Log odds ratio of holding a token and its standard error, with PRIOR pseudo-documents that hold it as often as all documents do."""
    prior = PRIOR * (n0 + n1) / (d0 + d1)
    odds = lambda y, d: F.log((y + prior) / F.greatest(d + PRIOR - y - prior, F.lit(1.0)))
    return {"delta": odds(n1, d1) - odds(n0, d0), "error": F.sqrt(1 / (n1 + prior) + 1 / (n0 + prior))}


def contexts(docs: DataFrame, labelled: DataFrame, candidates: frozenset[str]) -> DataFrame:
    """Per candidate token: the distinct words with their neighbours that it marks in the labelled documents of either class, n0 and n1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 0):
            found = set()
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = ["", *tokens(text), ""]
                found.update((m, label, " ".join(words[i : i + 3])) for i, w in enumerate(words[1:-1]) for m in marks(w) if m in candidates)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string()))], ["token", "label", "around"])

    rows = _labelled(docs, labelled).mapInArrow(run, "token string, label int, around string").distinct()
    return rows.groupBy("token").agg(F.count(F.when(F.col("label") == 0, 1)).alias("n0"), F.count(F.when(F.col("label") == 1, 1)).alias("n1"))


def _labelled(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).join(F.broadcast(labelled), "doc_id").select("text", F.col("label").cast("int"))


def _decay(chances: list[tuple[float, float]]) -> float:
    """The positive root of sum(p * exp(x * score)) = 1 over toxic tokens and the loss of all others."""
    rest = 1 - sum(p for _, p in chances)
    at = lambda x: sum(p * math.exp(x * s) for s, p in chances) + rest * math.exp(x * LOSS) - 1
    if not chances or sum(s * p for s, p in chances) + rest * LOSS >= 0:
        return 1e-3
    low, high = 1e-6, 1e-3
    while at(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if at(mid) < 0 else (low, mid)
    return low


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(t) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")

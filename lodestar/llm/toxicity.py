"""Toxicity by weak supervision.

Many weak voters look at a text: lexicon voters (a whole word, or any word
with a given beginning) proposed from a bounded sample of training rows, and
pattern voters (several different terms, terms close together, no term at
all). A lexicon voter that does not fire abstains. A generative label model
estimates, by expectation maximisation over the votes alone, how often each
voter fires on either class, and from the votes' correlations within a class
how much of each voter's vote is its own: voters that always fire together
share one vote. A linear classifier learns the resulting posteriors; its
scores are brought to the scale of the labels (one slope, one shift), and it
scores all rows. The two classes are sampled apart; each sampled row weighs
as many labelled rows of its class as it stands for, so prior, purity of
terms and scale are those of all training rows, whatever the sample's bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialise, without
from lodestar.llm.quality import held_out

#: After lower-casing, ASCII other than letters ends words.
LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
BEGINNINGS = (4, 5, 6)
N_PATTERNS = 4
#: Likelihood ratio that a term must reach: well beyond what the best of some
#: millions of terms reaches by chance.
TELLING = 30.0
AT_ONCE = 256                     # texts that a worker takes and hands on at a time


def normal(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").lower().encode().translate(LETTERS).split()) + b" "


def terms_of(text: str | None) -> set[bytes]:
    """What lexicon voters may look for in a text: " word " or " begin"."""
    out = set()
    for w in set(normal(text).decode().split(" ")):
        if len(w) > 2:
            out.add(f" {w} ".encode())
            out.update(f" {w[:n]}".encode() for n in BEGINNINGS if len(w) > n)
    return out


class Voters:
    """All voters' votes on a text, in one scan."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            self.automaton.add_word(t.decode("latin-1"), i)
        if terms:
            self.automaton.make_automaton()

    def votes(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(self.terms) + N_PATTERNS)
        if self.terms:
            data = normal(text).decode("latin-1")
            found = list(self.automaton.iter(data))
            if found:
                at = np.array([e - len(self.terms[i]) + 1 for e, i in found])
                out[[i for _, i in found]] = 1
                words = np.unique(at)
                kinds = len({data[a:a + 5] for a in words.tolist()})
                n = data.count(" ") - 1
                out[-N_PATTERNS:] = (0, kinds > 1, len(words) > 1, len(words) * 50 >= n)
                return out
        out[-N_PATTERNS] = 1                                # no term at all
        return out


def label_model(votes: np.ndarray, first: np.ndarray, prior: float, rounds: int = 12,
                weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Posterior of toxicity of each row of ``votes`` (0: abstains). ``first``:
    posteriors to start from; ``weight``: of the rows. Voters that all but always agree share a vote
    from the start; what voters share within a class beyond that is estimated
    from a first fit's posteriors and settles the shares of the second."""
    same = correlations(votes, weight * np.ones(len(votes)))
    share = 1 / (same > 0.8).sum(1)
    for _ in range(2):
        p = first
        for _ in range(rounds):
            w1, w0 = weight * p, weight * (1 - p)
            a1 = (w1 @ votes + 0.5 * prior) / (w1.sum() + 1)    # fires on toxic / clean rows
            a0 = (w0 @ votes + 0.5 * (1 - prior)) / (w0.sum() + 1)
            logit = np.log(prior / (1 - prior)) + votes @ (share * np.log(a1 / a0))
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        tied = np.maximum(correlations(votes, weight * p), correlations(votes, weight * (1 - p)))
        share = np.minimum(share, 1 / np.where(tied > 0.5, tied, 0).sum(1))
    return p


def correlations(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Between voters, over rows of these weights; 1 with themselves."""
    c = votes - weight @ votes / max(weight.sum(), 1e-9)
    cov = (c * weight[:, None]).T @ c
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    out = cov / np.outer(sd, sd)
    np.fill_diagonal(out, 1)
    return out


def fit_linear(x: np.ndarray, target: np.ndarray, rounds: int = 300, ridge: float = 1e-4,
               rate: float = 0.1, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Logistic regression on soft targets, rows weighted by ``weight`` (1 on
    average); the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (s - target)) / len(x) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def covering(votes: np.ndarray, least: int = 3, twice: int = 4) -> list[int]:
    """Terms (columns, most telling first) that fire on ``least`` toxic rows or
    more where fewer than ``twice`` terms before them do. Words that toxic rows
    share only because they are near copies of each other stay out."""
    kept, heard = [], np.zeros(len(votes))
    for j, fires in enumerate(votes.T):
        if (fires * (heard < twice)).sum() >= least:
            kept.append(j)
            heard += fires
    return kept


class Model:
    def __init__(self, terms: list[bytes], weights: np.ndarray):
        self.terms, self.weights = terms, weights


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` in blocks of AT_ONCE rows, so that no more is held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _blocks(batches):
        terms = [sorted(terms_of(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["y", "terms"])


def _votes(terms: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(terms)
        for batch in _blocks(batches):
            fired = [np.flatnonzero(voters.votes(t.as_py())).astype(np.int32)
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fired, pa.list_(pa.int32()))], names=["y", "fired"])
    return run


def train(docs: DataFrame, labels: DataFrame, toxic_sample: int = 4000, clean_sample: int = 8000,
          lexicon: int = 300, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model | None:
    """Fit on at most ``toxic_sample`` and ``clean_sample`` labelled training
    rows, with at most ``lexicon`` lexicon voters. An id labelled both ways
    counts as toxic. None if either class, or any telling term, is missing."""
    y = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
         .filter("id is not null and y is not null").filter(~held_out("id"))
         .groupBy("id").agg(F.max("y").alias("y")))
    every = {int(r["y"]): r["count"] for r in y.groupBy("y").count().collect()}
    order = [F.xxhash64(F.lit(21), "id"), F.col("id")]
    chosen = (y.filter("y = 1").orderBy(*order).limit(toxic_sample)
              .unionByName(y.filter("y = 0").orderBy(*order).limit(clean_sample)))
    texts = materialise(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id").filter("text is not null")
        .groupBy("text").agg(F.max("y").cast("int").alias("y"))         # copies count once
        .select("y", "text"), "voters")
    counts = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        return None
    share = n1 / (n1 + n0)
    # labelled rows that a row of the sample stands for
    w1, w0 = max(1.0, every[1] / toxic_sample), max(1.0, every[0] / clean_sample)
    prior = n1 * w1 / (n1 * w1 + n0 * w0)
    toxic, clean = F.col("toxic"), F.col("clean")
    n = toxic + clean
    # likelihood ratio of the term's toxic share against the sample's
    telling = 2 * (toxic * F.log(toxic / (n * share))
                   + F.when(clean > 0, clean * F.log(clean / (n * (1 - share)))).otherwise(0.0))
    found = (texts.mapInArrow(_terms, "y int, terms array<binary>")
             .select("y", F.explode("terms").alias("term")).groupBy("term")
             .agg(F.sum("y").cast("double").alias("toxic"),
                  F.sum(1 - F.col("y")).cast("double").alias("clean"))
             .filter((toxic >= 3) & (toxic * w1 / (toxic * w1 + clean * w0) >= 0.97))
             .withColumn("telling", telling).filter(F.col("telling") >= TELLING)
             .orderBy(F.desc("telling"), "term").limit(lexicon).collect())
    terms = [bytes(r["term"]) for r in found]
    if not terms:
        return None

    def voted() -> tuple[np.ndarray, np.ndarray]:
        rows = texts.mapInArrow(_votes(terms), "y int, fired array<int>").toArrow()
        votes = np.zeros((rows.num_rows, len(terms) + N_PATTERNS))
        for i, fired in enumerate(rows.column("fired").to_pylist()):
            votes[i, fired] = 1
        return votes, np.array(rows.column("y").to_pylist(), float)

    votes, y = voted()
    terms = [terms[j] for j in covering(votes[y == 1, :len(terms)])]
    votes, y = voted()
    order = np.lexsort((y, *votes.T[::-1]))                 # rows come in any order
    votes, y = votes[order], y[order]
    heard = votes[:, :len(terms)].any(1)
    weight = np.where(y == 1, w1, w0)
    weight = weight / weight.mean()
    p = label_model(votes, np.where(heard, 0.9, 0.05), prior, weight=weight)
    weights = fit_linear(votes, p, weight=weight)
    z = votes @ weights[:-1] + weights[-1]
    a, b = fit_linear(z[:, None], y, ridge=1e-3, weight=weight)     # to the scale of the labels
    return Model(terms, np.append(a * weights[:-1], a * weights[-1] + b))


def score(docs: DataFrame, model: Model | None, text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1, higher: toxic
    likelier) and ``predicted`` (1 if score >= threshold). Input columns of
    these names are replaced. Whole texts are scored; a null text scores as
    an empty one; equal texts score alike; without a model (a class or all
    telling terms missing) every score is 0."""
    out = without(docs, "score", "predicted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.terms) if model else None
        for batch in _blocks(batches):
            column = batch.column(batch.schema.names.index(text_col))
            s = np.zeros(len(column))
            if model and len(column):
                z = np.array([(voters.votes(t.as_py()) * model.weights[:-1]).sum() for t in column])
                s = 1 / (1 + np.exp(-np.clip(z + model.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"])

    return out.mapInArrow(run, f"{fields}, score double, predicted int")

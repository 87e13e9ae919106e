"""Toxicity by weak supervision: many voters, a generative model of their votes, and a linear classifier.

Voters. Lexicon voters are words and word beginnings mined from labelled rows: all those in at least LEAST toxic documents whose
share among toxic documents is LIFT times that among others, counted by partial aggregation over the labelled rows. Pattern
voters look at the form of a text (shouting, runs of "!", address in the second person beside an insult).

Label model. The class of a document is not observed; given it, the votes are a tree: a voter votes by its own rate in
the class (its accuracy) and, where it hangs on another voter, by a log odds ratio with that one's vote (their correlation,
shared by both classes), so that voters that go together do not count twice. Edges are the spanning forest of greatest
mutual information within the classes, of those beyond the chi-square bound EDGE. All is fitted by expectation maximisation on the
votes alone; labels are no voters. They give the share of the class, and, as PSEUDO pseudo-documents, the rates that voters begin with.

Classifier. A logistic regression on the votes and their number, trained on the posterior labels; its weights score every
whole text in one narrow pass. LEAST, LIFT and the penalty were chosen by cross-validation on rows that may be learned from.

The labelled sample has at most SAMPLE rows, which bounds what comes to the driver; every voter that qualifies is kept. Votes are lists of those that vote,
mutual information is made a voter at a time, and the classifier is fitted by conjugate gradients: memory grows with the votes and the voters, never with
pairs of voters.

Cases: null and empty texts have no votes; labels other than 0 and 1, or null, are not learned from; of several labels of one id
the least counts; without both classes the score is the share of the one, or a half without any; repeated rows are each
scored; other columns are passed through, but for score and n_votes, which are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import record, remainder, slices, stored, table
from reciprospark.llm.rules import labelled

SAMPLE, LIFT, LEAST, BEGINS, PSEUDO, EDGE, PENALTY = 20_000, 24.0, 4, (4, 5, 6, 7), 20.0, 10.83, 1e-4
PATTERNS = ("p_shouting", "p_exclaims", "p_second_person", "p_stars")
_SECOND = frozenset(("you", "your", "du", "dein", "tu", "toi", "usted", "eres"))
_KNOWN = 100_000
_CUT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes) -> set[str]:
    """Lower-cased words without ASCII punctuation."""
    return set(text.translate(_CUT).decode().lower().split())


def terms_of(word: str) -> list[str]:
    """A word as a whole, and its beginnings, marked by a star."""
    return [word, *[word[:n] + "*" for n in BEGINS if len(word) > n]]


def patterns(text: bytes, words: set[str]) -> tuple[float, ...]:
    letters = sum(map(len, words)) or 1
    upper = len(text) - len(text.translate(None, bytes(range(65, 91))))
    return (float(2 * upper > len(text) > 0), float(text.count(b"!!") > 2), float(bool(words & _SECOND) and letters < 400), float(text.count(b"**") > 2))


def mined(sample: DataFrame) -> list[str]:
    """Terms of the sample (text, y) that go with the toxic class, strongest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            both: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(texts, batch.column("y").to_pylist(), strict=True):
                both[int(y)].update({x for w in words_of(t) for x in terms_of(w)})
            names = list(both[0].keys() | both[1].keys())
            yield record(pa.schema([("term", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]), [names, [both[0][n] for n in names], [both[1][n] for n in names]])

    sizes = sample.groupBy().agg(F.sum(1 - F.col("y")).alias("clean"), F.sum("y").alias("toxic")).first()
    if not sizes.toxic or not sizes.clean:
        return []
    found = sample.select("text", "y").mapInArrow(run, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("toxic") + 0.1) / (sizes.toxic + 0.2) / ((F.col("clean") + 0.1) / (sizes.clean + 0.2))
    strength = F.log(share) * F.sqrt("toxic")
    rows = found.where((F.col("toxic") >= LEAST) & (share >= LIFT)).orderBy(strength.desc(), "term").collect()  # terms of the bounded sample
    kept: dict[str, int] = {}
    begins: set[str] = set()  # kept beginnings
    under: dict[str, int] = {}  # the most toxic rows of a kept term that begins so
    for r in rows:  # a longer term adds nothing to a kept beginning of it, nor a beginning to a kept term that has its documents
        stem = r.term.rstrip("*")
        longer = any(stem[:n] in begins for n in range(1, len(stem) + 1))
        same = r.term.endswith("*") and under.get(stem, 0) >= 0.8 * r.toxic
        if not longer and not same:
            kept[r.term] = r.toxic
            if r.term.endswith("*"):
                begins.add(stem)
            for n in range(1, len(stem) + 1):
                under[stem[:n]] = max(under.get(stem[:n], 0), r.toxic)
    return list(kept)


@dataclass
class Voters:
    terms: list[str]
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.at = {t: k for k, t in enumerate(self.terms)}

    @property
    def size(self) -> int:
        return len(self.terms) + len(PATTERNS)

    def votes(self, text: bytes) -> np.ndarray:
        """The voters that vote, ascending."""
        words, known = words_of(text), self.known
        out: set[int] = set()
        for w in words:
            if (hit := known.get(w)) is None:
                if len(known) >= _KNOWN:
                    known.clear()
                hit = known[w] = tuple(self.at[t] for t in terms_of(w) if t in self.at)
            out.update(hit)
        out.update(len(self.terms) + k for k, x in enumerate(patterns(text, words)) if x)
        return np.array(sorted(out), dtype=np.int32)


class Votes:
    """A matrix of votes as lists of the voters that vote in each row: its size is that of the votes there are."""

    def __init__(self, rows: list[np.ndarray], size: int) -> None:
        counts = np.array([len(r) for r in rows], dtype=np.int64)
        self.n, self.size = len(rows), size
        self.voter = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), counts)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(self.voter, kind="stable")
        self._rows_of, self._ends = self.row[order], np.concatenate([[0], np.cumsum(np.bincount(self.voter, minlength=size))])

    @classmethod
    def of(cls, v: np.ndarray) -> Votes:
        return cls([np.flatnonzero(r) for r in v], v.shape[1])

    def by_voter(self, weight: np.ndarray) -> np.ndarray:
        """Of each voter the weight of the rows that it votes in."""
        return np.bincount(self.voter, weights=weight[self.row], minlength=self.size)

    def by_row(self, value: np.ndarray) -> np.ndarray:
        """Of each row the sum of its voters' values."""
        return np.bincount(self.row, weights=value[self.voter], minlength=self.n)

    def beside(self, k: int, weight: np.ndarray) -> np.ndarray:
        """Of each voter the weight of the rows that it and voter k vote in."""
        rows = self._rows_of[self._ends[k] : self._ends[k + 1]]
        counts = self.starts[rows + 1] - self.starts[rows]
        places = np.repeat(self.starts[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(rows) else np.zeros(0, np.int64)
        return np.bincount(self.voter[places], weights=np.repeat(weight[rows], counts), minlength=self.size)

    def above(self, parent: np.ndarray) -> np.ndarray:
        """Of each vote, whether the voter's parent votes in that row too."""
        up = parent[self.voter]
        keys = self.row * self.size + self.voter  # ascending
        wanted = self.row * self.size + up
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return (up >= 0) & (keys[at] == wanted) if len(keys) else np.zeros(0, bool)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class LabelModel:
    """prior: log odds of the toxic class; parent: the voter that each one hangs on, or -1; alone: log odds of a vote while the
    parent does not vote, for the clean and the toxic class; together: what a vote of the parent adds, in both."""

    prior: float
    parent: np.ndarray
    alone: np.ndarray
    together: np.ndarray

    def odds(self, v: Votes) -> np.ndarray:
        """Log odds of the toxic class. As if nobody voted; then what a vote changes for those that hang on it, and for itself."""
        above = v.above(self.parent)
        out = np.full(v.n, self.prior)
        for sign, alone in zip((-1, 1), self.alone, strict=True):
            without, beside = (np.clip(logistic(x), 1e-7, 1 - 1e-7) for x in (alone, alone + self.together))
            hang = np.flatnonzero(self.parent >= 0)
            moved = np.bincount(self.parent[hang], weights=(np.log1p(-beside) - np.log1p(-without))[hang], minlength=v.size)
            p = np.where(above, beside[v.voter], without[v.voter])
            out += sign * (np.log1p(-without).sum() + np.bincount(v.row, weights=moved[v.voter] + np.log(p) - np.log1p(-p), minlength=v.n))
        return out


class Information:
    """Mutual information of pairs of voters within the classes, a row of it at a time; toxic, clean: what each row of votes counts in them."""

    def __init__(self, v: Votes, toxic: np.ndarray, clean: np.ndarray) -> None:
        self.v, self.parts, self.rows = v, [], (toxic + clean).sum()
        for w in (toxic, clean):
            total = w.sum() + 1e-9
            self.parts.append((w, total, v.by_voter(w) / total))

    def of(self, k: int) -> np.ndarray:
        """Of voter k with every voter."""
        out = np.zeros(self.v.size)
        for w, total, rate in self.parts:
            both, a, b = self.v.beside(k, w) / total, rate[k], rate
            for p, expected in ((both, a * b), (a - both, a * (1 - b)), (b - both, (1 - a) * b), (1 - a - b + both, (1 - a) * (1 - b))):
                ok = (p > 1e-12) & (expected > 1e-300)
                out += total / self.rows * np.where(ok, p * np.log(np.where(ok, p, 1) / np.where(ok, expected, 1)), 0)
        return out


def forest(information: Callable[[int], np.ndarray], size: int, n: int) -> np.ndarray:
    """The parents of the spanning forest of greatest information over n rows, without edges under the bound. information: of one voter with each of size voters."""
    parent, left = np.full(size, -1), np.ones(size, dtype=bool)
    best, by = np.full(size, -1.0), np.full(size, -1)
    for _ in range(size):
        k = int(np.argmax(np.where(left, best, -2.0)))
        left[k] = False
        parent[k] = by[k] if 2 * n * best[k] >= EDGE else -1
        found = information(k)
        closer = left & (found > best)
        best[closer], by[closer] = found[closer], k
    return parent


def _alone(rate: np.ndarray, above: np.ndarray, together: np.ndarray) -> np.ndarray:
    """The log odds of a vote without the parent's that give a voter its rate, the parent's rate being above."""
    low, high = np.full(len(rate), -40.0), np.full(len(rate), 40.0)
    for _ in range(50):
        x = (low + high) / 2
        less = above * logistic(x + together) + (1 - above) * logistic(x) < rate
        low, high = np.where(less, x, low), np.where(less, high, x)
    return x


def label_model(v: Votes, rates: tuple[np.ndarray, np.ndarray], share: float, weight: np.ndarray | None = None, rounds: int = 60) -> tuple[LabelModel, np.ndarray]:
    """Expectation maximisation over votes v, from the voters' rates in the clean and the toxic class and the share of the latter.
    weight: how many rows vote so (1). The model, and the posterior of each row."""
    weight = np.ones(v.n) if weight is None else weight
    prior = float(np.log(share / (1 - share)))
    model = LabelModel(prior, np.full(v.size, -1), np.stack([np.log(r / (1 - r)) for r in rates]), np.zeros(v.size))
    q = logistic(model.odds(v))
    for number in range(rounds):
        toxic, clean = weight * q, weight * (1 - q)
        parent = forest(Information(v, toxic, clean).of, v.size, weight.sum()) if number in (0, 5, 15) else model.parent
        has, up = parent >= 0, np.maximum(parent, 0)
        votes = v.by_voter(toxic)
        on = np.bincount(v.voter, weights=toxic[v.row] * v.above(parent), minlength=v.size)
        under = np.where(has, votes[up], 0)
        a, b, c, d = on + 0.5, under - on + 0.5, votes - on + 0.5, toxic.sum() - under - votes + on + 0.5
        together = np.where(has, np.clip(np.log(a * d / (b * c)), -6, 6), 0)
        base = [(v.by_voter(w) + PSEUDO * rate) / (w.sum() + PSEUDO) for w, rate in zip((clean, toxic), rates, strict=True)]
        alone = np.stack([_alone(b, np.where(has, b[up], 0), together) for b in base])
        model = LabelModel(prior, parent, alone, together)
        last, q = q, logistic(model.odds(v))
        if number > 16 and np.abs(q - last).max() < 1e-4:
            break
    return model, q


class Inputs:
    """What the classifier sees of votes: each of them, the saturating number of lexicon votes, and a bias; as a linear map and its transpose."""

    def __init__(self, v: Votes, terms: int) -> None:
        n = v.by_row((np.arange(v.size) < terms).astype(float))
        self.v, self.more = v, np.stack([np.log1p(n), np.minimum(n, 1), np.ones(v.n)], axis=1)
        self.size = v.size + 3

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.v.by_row(w[:-3]) + self.more @ w[-3:]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([self.v.by_voter(r), r @ self.more])

    def squares(self, r: np.ndarray) -> np.ndarray:
        """The diagonal of the normal matrix with row weights r."""
        return np.concatenate([self.v.by_voter(r), r @ self.more**2])


def linear(x: Inputs, q: np.ndarray, weight: np.ndarray | None = None, penalty: float = PENALTY, rounds: int = 50) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps, each solved by conjugate gradients, so no matrix of all pairs of voters is made;
    weight: how many rows each one stands for (1). The last weight is the bias."""
    weight = np.ones(len(q)) if weight is None else weight
    w = np.zeros(x.size)
    ridge = np.full(x.size, penalty * weight.sum())
    ridge[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x.times(w), -30, 30)))
        curve = weight * (p * (1 - p) + 1e-6)
        step = conjugate(lambda s, curve=curve: x.back(curve * x.times(s)) + ridge * s, x.back(weight * (q - p)) - ridge * w, x.squares(curve) + ridge)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def conjugate(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, diagonal: np.ndarray, exact: float = 1e-10) -> np.ndarray:
    """The solution of a positive definite system given by its product, by conjugate gradients scaled with its diagonal."""
    x, r = np.zeros_like(right), right.copy()
    z = r / diagonal
    d, rz, enough = z.copy(), r @ z, exact**2 * max(right @ (right / diagonal), 1e-300)
    for _ in range(10 * len(right) + 100):
        if rz <= enough:
            break
        along = product(d)
        step = rz / (d @ along)
        x, r = x + step * d, r - step * along
        z = r / diagonal
        rz, last = r @ z, rz
        d = z + rz / last * d
    return x


@dataclass(frozen=True)
class Model:
    terms: list[str]
    weights: np.ndarray

    def scores(self, votes: Votes) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(Inputs(votes, len(self.terms)).times(self.weights), -30, 30)))


def learned(docs: DataFrame, labels: DataFrame, keep: Column, limit: int = SAMPLE) -> Model:
    sample = stored(labelled(docs, labels, "toxic", keep, limit).select("text", "y", "doc_id"), "sample")
    terms = mined(sample)
    voters = Voters(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            votes = [voters.votes(t).astype(">i4").tobytes() for t in texts]
            yield record(pa.schema([("h", pa.int64()), ("y", pa.float64()), ("votes", pa.binary())]), [batch.column("h"), batch.column("y"), votes])

    rows = sample.select(F.xxhash64("doc_id").alias("h"), "text", "y").mapInArrow(run, "h long, y double, votes binary").orderBy("h", "y", "votes").limit(limit)
    rows = rows.groupBy("votes").agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).orderBy("votes").toPandas()  # rows that vote alike are one, with a weight
    toxic, weight = rows["toxic"].to_numpy(float), rows["n"].to_numpy(float)
    share = float(toxic.sum() / weight.sum()) if len(rows) else 0.5
    if not terms or share in (0.0, 1.0):
        return Model([], np.concatenate([np.zeros(len(PATTERNS) + 2), [np.log((share + 1e-3) / (1 - share + 1e-3))]]))
    v = Votes([np.frombuffer(bytes(x), dtype=">i4") for x in rows["votes"]], voters.size)
    rates = tuple((v.by_voter(w) + 0.1) / (w.sum() + 0.2) for w in (weight - toxic, toxic))
    _, posterior = label_model(v, rates, share, weight)
    return Model(terms, linear(Inputs(v, len(terms)), posterior, weight))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and n_votes in place of text."""
    kept = docs.select(*[c for c in docs.columns if c not in ("score", "n_votes")])
    own = [c for c in kept.columns if c != "text"]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"] + ["score double, n_votes long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.terms)
        for batch, texts in slices(batches):
            rows = [voters.votes(t) for t in texts]
            schema = pa.schema([*[batch.schema.field(c) for c in own], ("score", pa.float64()), ("n_votes", pa.int64())])
            yield record(schema, [*[batch.column(c) for c in own], model.scores(Votes(rows, voters.size)), np.array([len(r) for r in rows], dtype=np.int64)])

    return kept.mapInArrow(run, fields)


def op10_weak_supervision(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learned(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    found = scored(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_votes")

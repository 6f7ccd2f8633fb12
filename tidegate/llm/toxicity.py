"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Terms are words and the first bytes of words. Those that go with the label toxic
   in the labelled rows form lexicons: one voter for each kind of term and band of
   strength votes "toxic" if the text has one of its terms, and abstains otherwise.
   Pattern voters look at the text's shape. Two voters vote "clean": where no lexicon
   and where no pattern fires. The label itself is one more voter.
2. The label model is a mixture of two classes in which voters vote on their own. EM
   estimates the classes' share and each voter's accuracies; correlations that are
   left among voters of one class are estimated next, and a voter counts the less the
   more it repeats others; then EM runs again.
3. A logistic regression on the presence of terms and patterns is fitted to the
   posterior labels, and scores every text of the table.

The model is fitted on at most SAMPLE labelled rows (a documented bound; chosen by a
hash of doc_id) and has at most TERMS terms, so it is small enough for the driver and
for every task. Scoring reads whole texts of all rows.

Defined results: null and empty texts get the score of a text without any term; with
no labelled row, or of one class only, every text gets the smoothed share of toxic
labels; a document with several labels counts as toxic if one says so; rows that
repeat get a row each; labels without doc_id or with other values are left out.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.language import fold
from tidegate.llm.tasks import map_texts
from tidegate.llm.text import SliceHashes, Words, byte_arrays, mix, signed, unsigned
from tidegate.session import settle

SAMPLE = 20_000  # labelled rows to learn from
TERMS = 2048  # of the model
PREFIXES = (3, 4, 5, 6)  # bytes of a word's beginning
LEAST_TOXIC = 5  # documents that have a term
LEAST_RATIO = 4.0  # how much likelier a term is in toxic documents
BANDS = 4  # lexicons of one kind of term
THRESHOLD = 0.7
ROUNDS = 40  # of EM
STEPS, PENALTY = 2000, 2e-5  # of the regression
SHAPES = 3
ABSTAIN, CLEAN, TOXIC = 0, 1, 2


def term_hashes(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By kind: the hash and the text of each occurrence of a term. Kind 0 is the whole word."""
    yield 0, mix(words.hashes, 71), words.owner
    sizes = words.stops - words.starts
    slices = SliceHashes(words.data)
    for kind, length in enumerate(PREFIXES, 1):
        at = np.flatnonzero(sizes > length)
        yield kind, mix(slices.of(words.starts[at], words.starts[at] + length), 71 + kind), words.owner[at]


def distinct_terms(words: Words, member) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """`term_hashes` once for each text, with the number of occurrences; only those that `member` lets through."""
    for kind, hashes, owner in term_hashes(words):
        if member is not None:
            at = np.flatnonzero(member(hashes))
            hashes, owner = hashes[at], owner[at]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        yield kind, hashes[at], owner[at], np.diff(np.append(at, len(hashes)))


def densities(words: Words, owner: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    """How thick a term lies in its text, on a logarithmic scale."""
    return np.log1p(50 * occurrences / (np.diff(words.first)[owner] + 20))


def shapes(texts: pa.Array) -> np.ndarray:
    """Text by pattern: mostly capitals; repeated exclamation marks; signs within words."""
    data, offsets = byte_arrays(texts)

    def counts(hit: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(hit)))[offsets])

    upper = (data >= ord("A")) & (data <= ord("Z"))
    lower = (data >= ord("a")) & (data <= ord("z"))
    letter = upper | lower
    twice, masked = np.zeros(len(data), bool), np.zeros(len(data), bool)
    if len(data) > 2:
        twice[1:] = (data[1:] == ord("!")) & (data[:-1] == ord("!"))
        masked[1:-1] = letter[:-2] & np.isin(data[1:-1], list(b"*@$#")) & letter[2:]
    capitals = counts(upper)
    return np.stack([(capitals > counts(lower)) & (capitals >= 8), counts(twice) >= 3, counts(masked) >= 1], axis=1)


@dataclass
class Model:
    """A linear classifier over the presence and density of terms, sorted by hash, and over patterns."""

    terms: np.ndarray
    presence_weights: np.ndarray
    density_weights: np.ndarray
    shape_weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        total = self.bias + shapes(texts) @ self.shape_weights
        if len(self.terms):
            words = Words(texts)
            for _, hashes, owner, occurrences in distinct_terms(words, member_of(self.terms)):
                at = np.searchsorted(self.terms, hashes)
                weight = self.presence_weights[at] + self.density_weights[at] * densities(words, owner, occurrences)
                total += np.bincount(owner, weight, len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def member_of(terms: np.ndarray):
    """Which hashes are among the sorted `terms`; a table of 2 ** 16 bits spares most searches."""
    hint = np.zeros(1 << 16, bool)
    hint[terms & np.uint64(0xFFFF)] = True

    def member(hashes: np.ndarray) -> np.ndarray:
        out = hint[hashes & np.uint64(0xFFFF)]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(terms, hashes[at]), len(terms) - 1)
        out[at] = terms[place] == hashes[at]
        return out

    return member


def labelled_texts(documents: DataFrame, labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    """`toxic` and `text` of at most SAMPLE labelled documents outside the fold that is held out."""
    usable = labels.filter("doc_id is not null and toxic in (0, 1)").filter(fold(F.col("doc_id"), folds) != held_out)
    ids = usable.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    ids = settle(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "labels")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(ids), "doc_id")  # SAMPLE rows of two numbers
    return settle(rows.select(F.col("label").alias("toxic"), "text"), "labelled", compact=True)


def choose_terms(sample: DataFrame, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, kind and log ratio of the terms that go with toxic texts, by hash."""

    def count(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        toxic = rows.column("toxic").to_numpy()
        for kind, hashes, owner, _ in distinct_terms(Words(texts), None):
            found, number = np.unique(hashes, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), kind), pa.int32()),
                    pa.array(signed(found)),
                    pa.array(np.bincount(number, toxic[owner], len(found)).astype(np.int64)),
                    pa.array(np.bincount(number, minlength=len(found)).astype(np.int64)),
                ],
                ["kind", "term", "toxic", "n"],
            )

    counts = map_texts(sample, count, "kind int, term bigint, toxic bigint, n bigint").groupBy("kind", "term").agg(
        F.sum("toxic").alias("toxic"), F.sum("n").alias("n")
    )
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (n_clean + 1))
    best = (
        counts.filter(F.col("toxic") >= LEAST_TOXIC).withColumn("ratio", F.log(ratio))
        .filter(F.col("ratio") >= float(np.log(LEAST_RATIO)))
        .orderBy(F.desc(F.col("ratio") * F.col("toxic")), "term").limit(TERMS).toPandas()
    )
    terms = unsigned(best["term"].to_numpy(np.int64))
    order = np.argsort(terms)
    return terms[order], best["kind"].to_numpy()[order], best["ratio"].to_numpy(float)[order]


def learn(documents: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> Model:
    sample = labelled_texts(documents, labels, folds, held_out)
    counted = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counted.get(1, 0), counted.get(0, 0)
    base = Model(np.empty(0, np.uint64), np.empty(0), np.empty(0), np.zeros(SHAPES), float(np.log((n_toxic + 0.5) / (n_clean + 9.5))))
    if not n_toxic or not n_clean:
        return base
    terms, kinds, ratios = choose_terms(sample, n_toxic, n_clean)
    if not len(terms):
        return base

    def present(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        found = [
            (np.searchsorted(terms, hashes), owner, densities(words, owner, occurrences))
            for _, hashes, owner, occurrences in distinct_terms(words, member_of(terms))
        ]
        columns, owner, density = (np.concatenate(parts) for parts in zip(*found))
        order = np.argsort(owner, kind="stable")
        bounds = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts))))), pa.int32())
        shape = shapes(texts) @ (1 << np.arange(SHAPES))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("toxic"),
                pa.array(shape, pa.int32()),
                pa.ListArray.from_arrays(bounds, pa.array(columns[order], pa.int32())),
                pa.ListArray.from_arrays(bounds, pa.array(density[order])),
            ],
            ["toxic", "shape", "terms", "densities"],
        )

    # A row for each labelled text, so at most SAMPLE, unless ids repeat in the documents.
    rows = map_texts(sample, present, "toxic int, shape int, terms array<int>, densities array<double>").toPandas()
    toxic = rows["toxic"].to_numpy()
    shape = (rows["shape"].to_numpy()[:, None] >> np.arange(SHAPES)) & 1
    owner = np.repeat(np.arange(len(rows)), rows["terms"].map(len).to_numpy())
    columns = np.concatenate([*rows["terms"], np.empty(0)]).astype(np.int64)
    density = np.concatenate([*rows["densities"], np.empty(0)])
    posterior = label_model(votes(toxic, shape, owner, columns, kinds, ratios))
    at, shape_kind = np.nonzero(shape)
    entries = (
        np.concatenate([owner, owner, at]),
        np.concatenate([columns, columns + len(terms), shape_kind + 2 * len(terms)]),
        np.concatenate([np.ones(len(columns)), density, np.ones(len(at))]),
    )
    weights, bias = fit(posterior, entries, 2 * len(terms) + SHAPES)
    return Model(terms, weights[: len(terms)], weights[len(terms) : 2 * len(terms)], weights[2 * len(terms) :], bias)


def votes(toxic, shape, owner, columns, kinds, ratios) -> np.ndarray:
    """Texts by voters; the last voter is the label."""
    bands = np.zeros(len(kinds), np.int64)
    for kind in np.unique(kinds):
        of = np.flatnonzero(kinds == kind)
        bands[of[np.argsort(-ratios[of], kind="stable")]] = np.arange(len(of)) * BANDS // len(of)
    lexicons = np.zeros((len(toxic), (len(PREFIXES) + 1) * BANDS), np.int64)
    lexicons[owner, kinds[columns] * BANDS + bands[columns]] = TOXIC
    lexicons = lexicons[:, lexicons.any(axis=0)]
    calm = np.stack([~lexicons.any(axis=1), ~shape.any(axis=1)], axis=1) * CLEAN
    return np.concatenate([lexicons, shape * TOXIC, calm, np.where(toxic == 1, TOXIC, CLEAN)[:, None]], axis=1)


def label_model(votes: np.ndarray) -> np.ndarray:
    """The probability that each text is toxic."""
    count, voters = votes.shape
    seen = np.stack([votes == choice for choice in (ABSTAIN, CLEAN, TOXIC)], axis=2).astype(float)
    trust = np.ones(voters)
    posterior = np.where(votes[:, -1] == TOXIC, 0.95, 0.05)
    for stage in range(2):
        for _ in range(ROUNDS):
            likely = []
            for weight in (1 - posterior, posterior):
                rates = (np.einsum("n,nvc->vc", weight, seen) + 0.1) / (weight.sum() + 0.3)
                likely.append(np.log(rates))
            share = np.clip(posterior.mean(), 1e-6, 1 - 1e-6)
            odds = np.log(share / (1 - share)) + np.einsum("nvc,vc,v->n", seen, likely[1] - likely[0], trust)
            posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if stage == 0:
            trust = 1 / (1 + np.clip(correlations(seen, posterior), 0, 1).sum(axis=1))
            trust[-1] = 1.0  # the label is no repetition of other voters
    return posterior


def correlations(seen: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """How voters go together within the classes, beyond what the classes explain."""
    fired = 1 - seen[:, :, ABSTAIN]
    total = np.zeros((fired.shape[1],) * 2)
    for weight in (1 - posterior, posterior):
        mass = weight.sum() + 1e-9
        rest = fired - (weight @ fired) / mass
        cover = (rest * weight[:, None]).T @ rest / mass
        scale = np.sqrt(np.diag(cover)) + 1e-6
        total += cover / scale[:, None] / scale * (mass / len(posterior))
    np.fill_diagonal(total, 0)
    return total


def fit(posterior: np.ndarray, entries: tuple, width: int) -> tuple[np.ndarray, float]:
    """Logistic regression with probabilities as targets, by accelerated gradient steps.

    `entries`: rows, columns and values of the sparse feature matrix.
    """
    rows, columns, values = entries
    count = len(posterior)

    def times(vector: np.ndarray) -> np.ndarray:
        return np.bincount(rows, vector[columns] * values, count) + vector[-1]

    def back(vector: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(columns, vector[rows] * values, width), vector.sum())

    top = np.ones(width + 1)
    for _ in range(30):  # the largest curvature
        top = back(times(top / np.linalg.norm(top)))
    step = 1 / (0.3 * np.linalg.norm(top) / count + PENALTY)
    weights = np.zeros(width + 1)
    ahead, speed = weights.copy(), 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-np.clip(times(ahead), -50, 50))) - posterior
        slope = back(error) / count
        slope[:-1] += PENALTY * ahead[:-1]
        new = ahead - step * slope
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        if (new - weights) @ slope > 0:  # restart where momentum leads uphill
            ahead, faster = new.copy(), 1.0
        else:
            ahead = new + (speed - 1) / faster * (new - weights)
        weights, speed = new, faster
    return weights[:-1], float(weights[-1])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """`documents` with the column `toxicity` last, which takes the place of one of that name."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        scores = pa.array(sent.value.score(texts))
        yield pa.RecordBatch.from_arrays([*rows.columns, scores], [*rows.schema.names, "toxicity"])

    kept = documents.drop("toxicity")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_texts(kept, run, f"{schema}, toxicity double")


def score_documents(documents: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = map_scores(rows, learn(documents, labels, folds, held_out))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )


def map_scores(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and toxicity alone, so that texts do not come back from Python."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        scores = pa.array(sent.value.score(texts))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), scores], ["doc_id", "toxicity"])

    return map_texts(rows, run, "doc_id bigint, toxicity double")


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not predict to be toxic, with their columns."""
    names = {name: "text" if name == "text" else f"own {i}" for i, name in enumerate(documents.columns)}
    own = documents.select(*[F.col(f"`{name}`").alias(alias) for name, alias in names.items()])
    clean = score(own, learn(documents, labels)).filter(F.col("toxicity") < THRESHOLD)
    return clean.select(*[F.col(f"`{alias}`").alias(name) for name, alias in names.items()])

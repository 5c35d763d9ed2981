"""Toxicity by a classifier chain: linear models of one category after the other, each seeing the earlier probabilities."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import query, table

# labelled documents that the models are fitted on, at most; a seeded draw chooses them
SAMPLE_ROWS = 6000
SEED = "tox-1"
# order of the chain
CATEGORIES = ("low_quality", "toxic", "severe")
FOLDS = 5
# a term is a word or the first letters of words; the sampled documents a term must occur in, and its least
# distance from chance in deviations
PREFIXES = (5, 6, 7)
MIN_DOCUMENTS, MIN_Z = 5, 4.0
# least share of right verdicts on out-of-fold probabilities; a category that never reaches it is never said
MIN_PRECISION, NEVER = 0.5, 2.0
RIDGE, ROUNDS = 1.0, 30

_WORDS = re.compile(r"\w+")
_SAMPLE = "doc_id long, fold int, low_quality int, toxic int, severe int, words map<string, int>, shape array<double>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("fold", pa.int32()), ("low_quality", pa.int32()), ("toxic", pa.int32()), ("severe", pa.int32()),
    ("words", pa.map_(pa.string(), pa.int32())), ("shape", pa.list_(pa.float64()))])


def features(text: str) -> tuple[Counter, list[float]]:
    """The lower-case words of a text with their counts, and measures of its shape."""
    words = _WORDS.findall(text.lower())
    counts = Counter(words)
    n, chars = max(1, len(words)), max(1, len(text))
    upper = sum(map(str.isupper, text))
    signs = chars - sum(map(str.isalnum, text)) - sum(map(str.isspace, text))
    lines = text.split("\n")
    return counts, [
        math.log1p(len(words)), len(counts) / n, sum(map(len, words)) / n, upper / chars, signs / chars,
        len(set(lines)) / len(lines), sum(map(str.isdigit, text)) / chars,
    ]


def terms_of(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def newton_step(x: np.ndarray, curve: np.ndarray, ridge: np.ndarray, slope: np.ndarray, share: float) -> np.ndarray:
    """Solves (x' diag(curve) x + diag(ridge)) step = slope by conjugate gradients, until `share` of the slope is left.

    Each turn reads x twice, where the whole matrix of a step would take a product of x with itself.
    """
    scale = np.einsum("ij,ij,i->j", x, x, curve, optimize=False) + ridge
    step, left = np.zeros_like(slope), slope.copy()
    near = left / scale
    way, now = near.copy(), left @ near
    least = share * share * now
    for _ in range(2 * len(slope)):
        if now <= least or now == 0:
            break
        image = x.T @ (curve * (x @ way)) + ridge * way
        long = now / (way @ image)
        step += long * way
        left -= long * image
        near = left / scale
        before, now = now, left @ near
        way = near + now / before * way
    return step


def fit_linear(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps, halved until they help; the last weight is the free term. One class alone gives its base rate."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(x.shape[1])
    weights[-1] = logit((y.sum() + 0.5) / (len(y) + 1))
    if y.min(initial=1) == y.max(initial=0):
        return weights
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6

    def loss(w):
        odds = x @ w
        return np.logaddexp(0, odds).sum() - y @ odds + (ridge * w * w).sum() / 2

    now, steepest = loss(weights), 0.0
    for _ in range(ROUNDS):
        p = sigmoid(x @ weights)
        slope = x.T @ (y - p) - ridge * weights
        # far from the optimum a rough step does, near it the steps get as exact as they must
        steepest = max(steepest, steep := float(np.abs(slope).max()))
        if not steep:
            break
        step = newton_step(x, np.maximum(p * (1 - p), 1e-12), ridge, slope, max(1e-10, min(0.1, steep / steepest)))
        # a whole step far from the optimum may run away, above all with few positives
        while (then := loss(weights + step)) > now and np.abs(step).max() >= 1e-8:
            step /= 2
        weights, now = weights + step, then
        if np.abs(step).max() < 1e-8:
            break
    return weights


class Sample:
    """The terms of some documents as arrays: for each entry its document, term and count."""

    def __init__(self, words: list[Counter], shape: list[list[float]], chosen: list[str] | None = None):
        index = {t: i for i, t in enumerate(chosen)} if chosen is not None else {}
        docs, terms, counts = [], [], []
        for row, own in enumerate(words):
            found = Counter()
            for word, n in own.items():
                for term in terms_of(word):
                    if chosen is None or term in index:
                        found[index.setdefault(term, len(index))] += n
            docs += [row] * len(found)
            terms += found.keys()
            counts += found.values()
        self.names = list(index)
        self.docs, self.terms, self.counts = np.array(docs, np.int64), np.array(terms, np.int64), np.array(counts, float)
        self.many = np.array([max(1, own.total()) for own in words], float)
        self.shape = np.array(shape, float).reshape(len(words), 7)

    def telling(self, rows: np.ndarray, y: np.ndarray) -> list[int]:
        """Terms whose share of the positive documents is furthest from their share of the others, in deviations.

        Of terms that occur in the same documents only the first counts. `rows` says which documents to look at.
        """
        ones, zeros = int(y[rows].sum()), int((1 - y[rows]).sum())
        if not ones or not zeros:
            return []
        inside = rows[self.docs]
        of, size = self.terms[inside], len(self.names)
        n, positive = np.bincount(of, minlength=size), np.bincount(of, y[self.docs[inside]], size)
        mark = np.random.default_rng(0).random(len(rows))
        same = np.round(np.bincount(of, mark[self.docs[inside]], size), 9)
        share = n / (ones + zeros)
        apart = positive / ones - (n - positive) / zeros
        z = np.abs(apart) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / ones + 1 / zeros))
        fit = sorted((t for t in np.flatnonzero((n >= MIN_DOCUMENTS) & (z >= MIN_Z))), key=lambda t: (-z[t], self.names[t]))
        known, out = set(), []
        for t in fit:
            if same[t] not in known:
                known.add(same[t])
                out.append(int(t))
        return out

    def matrix(self, chosen: list[int], earlier: np.ndarray, scale: tuple) -> np.ndarray:
        """Presence and density (log of the count in a thousand words) of chosen terms, scaled shape, log odds of the
        earlier categories and, of several, of all of them together."""
        place = np.full(len(self.names) + 1, -1)
        place[chosen] = np.arange(len(chosen))
        at = place[self.terms] if len(self.terms) else self.terms
        x = np.zeros((len(self.many), len(chosen)))
        x[self.docs[at >= 0], at[at >= 0]] = self.counts[at >= 0]
        density = np.log1p(1000 * x / self.many[:, None]) / 4
        together = earlier.prod(1, keepdims=True) if earlier.shape[1] > 1 else earlier[:, :0]
        return np.hstack([x > 0, density, (self.shape - scale[0]) / scale[1], logit(earlier), logit(together)])


def fit_category(sample: Sample, rows: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> dict:
    """The linear model of one category, fitted on the documents where `rows` is true."""
    shape = sample.shape[rows]
    scale = (shape.mean(0), shape.std(0) + 1e-6) if len(shape) else (np.zeros(7), np.ones(7))
    chosen = sample.telling(rows, y)
    weights = fit_linear(sample.matrix(chosen, earlier, scale)[rows], y[rows])
    return {"terms": [sample.names[t] for t in chosen], "at": chosen, "mean": list(scale[0]), "std": list(scale[1]), "weights": list(weights)}


def predict_category(model: dict, sample: Sample, chosen: list[int], earlier: np.ndarray) -> np.ndarray:
    x = sample.matrix(chosen, earlier, (np.array(model["mean"]), np.array(model["std"])))
    weights = np.array(model["weights"])
    return sigmoid(x @ weights[:-1] + weights[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of the best F1 on out-of-fold probabilities, halfway to the next lower one, among those of at
    least MIN_PRECISION; NEVER if there is none."""
    order = np.argsort(-p, kind="stable")
    hits, flagged = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    last = np.append(np.diff(p[order]) != 0, True)[:len(y)]  # equal probabilities get one verdict
    f1 = np.where(last & (hits >= MIN_PRECISION * flagged), 2 * hits / (flagged + y.sum()), 0) if len(y) and y.any() else np.zeros(1)
    at = int(np.argmax(f1))
    if not f1[at]:
        return NEVER
    following = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float((p[order[at]] + following) / 2)


def fit_chain(rows: list[dict]) -> dict:
    """One model per category in order. Later models see out-of-fold probabilities of the earlier ones, as at prediction
    time they see probabilities of texts the earlier models do not know."""
    rows = sorted(rows, key=lambda r: r["doc_id"])
    sample = Sample([Counter(dict(r["words"])) for r in rows], [r["shape"] for r in rows])
    fold = np.array([r["fold"] for r in rows], dtype=int)
    earlier, chain = np.zeros((len(rows), 0)), {}
    for category in CATEGORIES:
        y = np.array([r[category] for r in rows], dtype=float)
        out = np.full(len(rows), 0.5)
        for k in range(FOLDS):
            held = fold == k
            if held.any() and not held.all():
                model = fit_category(sample, ~held, earlier, y)
                out[held] = predict_category(model, sample, model["at"], earlier)[held]
        chain[category] = fit_category(sample, fold >= 0, earlier, y) | {"threshold": best_threshold(out, y)}
        earlier = np.column_stack([earlier, out])
    return chain


def predict_chain(chain: dict, texts: list[str]) -> np.ndarray:
    """Probabilities of the categories, one row per text."""
    got = [features(t) for t in texts]
    names = sorted({t for model in chain.values() for t in model["terms"]})
    sample = Sample([g[0] for g in got], [g[1] for g in got], names)
    place = {t: i for i, t in enumerate(names)}
    earlier = np.zeros((len(texts), 0))
    for category in CATEGORIES:
        chosen = [place[t] for t in chain[category]["terms"]]
        earlier = np.column_stack([earlier, predict_category(chain[category], sample, chosen, earlier)])
    return earlier


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, fold, quality, toxic, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            words, shape = features((text or b"").decode("utf-8", "replace"))
            rows.append({"doc_id": doc, "fold": fold, "low_quality": 1 - quality, "toxic": toxic, "severe": toxic * (1 - quality),
                         "words": sorted(words.items()), "shape": shape})
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for batch in batches for r in batch.to_pylist()]
    yield pa.RecordBatch.from_pydict({"chain": [json.dumps(fit_chain(rows))]})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: str = SEED) -> dict:
    """The chain, fitted on at most `sample_rows` labelled documents.

    Label rows with a null are left out, of several rows for one document the least counts; documents are
    drawn by a seeded hash of the id, which also names the fold. The sample, bounded by `sample_rows`, is
    broadcast to find its texts and fitted in one task; the driver gets the models: the terms that
    the sample shows and two numbers for each. Without labelled documents every probability is one half and no
    verdict is given.
    """
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg(F.min(F.struct("quality", "toxic")).alias("l")).select("doc_id", "l.quality", "l.toxic")
    drawn = known.withColumn("draw", draw).orderBy("draw", "doc_id").limit(sample_rows)
    drawn = drawn.select(F.col("doc_id").alias("id"), "quality", "toxic", F.pmod(F.shiftright("draw", 8), F.lit(FOLDS)).cast("int").alias("fold"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("id")).select("doc_id", "fold", "quality", "toxic", "text")
    # ids that several documents bear
    sample = sample.mapInArrow(_sampled, _SAMPLE).dropDuplicates(["doc_id"])
    return json.loads(sample.repartition(1).mapInArrow(_fitted, "chain string").first()["chain"])


def scored(docs: DataFrame, chain: dict) -> DataFrame:
    """Probability and verdict per category of every row of `docs` (doc_id, text), whole texts; null is empty.

    Returns doc_id, p_<category> doubles and <category> booleans; repeated rows stay, other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            p = predict_chain(model.value, texts)
            columns = [pa.array(p[:, i]) for i in range(len(CATEGORIES))]
            flags = [pa.array(p[:, i] >= model.value[c]["threshold"]) for i, c in enumerate(CATEGORIES)]
            names = ["doc_id", *[f"p_{c}" for c in CATEGORIES], *CATEGORIES]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *flags], names=names)

    schema = ", ".join(["doc_id long", *[f"p_{c} double" for c in CATEGORIES], *[f"{c} boolean" for c in CATEGORIES]])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(predicted, schema)


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))

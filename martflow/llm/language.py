"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by gradient descent.

A text is the mean of the embeddings of its subwords, the byte sequences of three and four hashed to a fixed number
of buckets. As the softmax is linear, a trained model is one row of class scores per bucket, so a prediction is a mean
of looked-up rows. Part of the sample is kept back to calibrate, as whole texts and as a few of their subwords among as
many that were never learnt: a temperature makes the scores probabilities on both, and a threshold rejects
predictions that are too uncertain. A softmax can be sure of what it never learnt, so a text is also rejected if it has
no more of the predicted language's usual subwords than texts of the other languages have, with a margin for short texts.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bounded_sample, in_learning_part, map_columns

BUCKET_BITS = 15
WIDTH = 12
# Documents a model is fitted on, at most.
SAMPLE_ROWS = 3000
STEPS = 600
BATCH = 25
RATE = 8.0
# Share of the sample that calibrates. No score is rejected that comes as near as this to the lowest of a right prediction.
CALIBRATION_SHARE = 0.2
SPARED = 0.75
# Subwords drawn of a text for calibration, and of those that were never learnt.
DRAWN = 12
# A subword is usual in a language if so many, and this share, of its documents in the sample have it. A text's share of
# usual subwords has to reach the middle share of the other languages' documents and some more, but never more than
# this part of what all but a few of the language's documents reach without themselves. A short text is spared
# one over the root of its subwords, and twice that of its score. Languages with fewer documents in the sample reject nothing
# by their subwords, and samples with fewer to calibrate nothing by the score.
KNOWN_IN = 3
KNOWN_SHARE = 0.01
SURPLUS = 0.06
UNUSUAL = 0.01
COVERED = 0.8
LEAST_DOCUMENTS = 30
SEGMENT = 1 << 20
UNDETERMINED = "und"


@dataclass
class Model:
    """``scores`` holds a row per bucket and a column per language, with the bias and temperature applied.

    ``known`` says of each bucket in which languages it is usual, ``least`` has the lowest share of usual subwords by language.
    """

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    threshold: float
    known: np.ndarray
    least: np.ndarray


def _fold() -> np.ndarray:
    """ASCII letters in lower case, all else of ASCII a space, other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for b in range(97, 123):
        table[b] = table[b - 32] = b
    return table


FOLD = _fold()


def buckets(text: str) -> np.ndarray:
    """Buckets of the subwords, of three and four bytes, whose second byte belongs to a word."""
    folded = FOLD[np.frombuffer(f" {text.lower()}  ".encode(), np.uint8)].astype(np.uint32)
    three = folded[:-3] | folded[1:-2] << 8 | folded[2:-1] << 16
    four = three | folded[3:] << 24
    inside = folded[1:-2] != 32
    shift = np.uint32(32 - BUCKET_BITS)
    return np.concatenate(
        [(three[inside] * np.uint32(2654435761)) >> shift, (four[inside] * np.uint32(2246822519)) >> shift]
    )


def segments(text: str):
    """A very long text in parts, so that memory stays bounded."""
    return (text[at : at + SEGMENT] for at in range(0, len(text), SEGMENT))


def has_letter(text: str) -> bool:
    import regex

    return regex.search(r"\p{L}", text) is not None


def _profiles(rows: DataFrame) -> DataFrame:
    """label, buckets, counts: the subwords of whole texts, no more entries than there are buckets."""

    def start():
        def apply(columns):
            out = {"label": columns["label"], "buckets": [], "counts": []}
            for text in columns["text"]:
                total = np.zeros(1 << BUCKET_BITS, np.int64)
                for part in segments(text):
                    total += np.bincount(buckets(part), minlength=len(total))
                found = np.flatnonzero(total)
                out["buckets"].append(found.astype(np.uint32).tobytes())
                out["counts"].append(total[found].astype(np.float32).tobytes())
            return out

        return apply

    return map_columns(rows, "label string, buckets binary, counts binary", start)


def train(docs: DataFrame, key: str = "doc_id", rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most ``rows`` documents with a language, none of them held out. None if there is no such document.

    The bounded sample is fitted in one task, so that only the model reaches the driver.
    """
    labelled = docs.where(in_learning_part(F.col(key)) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = bounded_sample(labelled.select(F.col(key).alias("_key")).distinct(), "_key", rows)
    picked = labelled.join(F.broadcast(chosen), F.col(key) == F.col("_key"), "left_semi")
    sample = _profiles(picked.select(F.col("lang").alias("label"), "text").limit(4 * rows)).coalesce(1)

    def run(batches):
        import pyarrow as pa

        profiles = []
        for batch in batches:
            labels, found, counts = (batch.column(k) for k in range(3))
            profiles += zip(labels.to_pylist(), found.to_pylist(), counts.to_pylist())
        profiles = sorted(p for p in profiles if p[1])
        if profiles:
            model = fit(profiles)
            columns = {
                "languages": [model.languages],
                "scores": [model.scores.tobytes()],
                "bias": [model.bias.tobytes()],
                "threshold": [model.threshold],
                "known": [np.packbits(model.known).tobytes()],
                "least": [model.least.tolist()],
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = (
        "languages array<string>, scores binary, bias binary, threshold double, known binary, least array<double>"
    )
    fitted = sample.mapInArrow(run, schema).first()
    if fitted is None:
        return None
    languages = list(fitted["languages"])
    scores = np.frombuffer(bytes(fitted["scores"]), np.float32).reshape(-1, len(languages))
    known = np.unpackbits(np.frombuffer(bytes(fitted["known"]), np.uint8)).astype(bool).reshape(scores.shape)
    least = np.array(fitted["least"])
    return Model(languages, scores, np.frombuffer(bytes(fitted["bias"])), fitted["threshold"], known, least)


def fit(profiles: list[tuple[str, bytes, bytes]]) -> Model:
    """Gradient descent over label and subword counts of each text."""
    random = np.random.default_rng(7)
    languages = sorted({label for label, _, _ in profiles})
    targets = np.array([languages.index(label) for label, _, _ in profiles])
    indices = [np.frombuffer(b, np.uint32) for _, b, _ in profiles]
    counts = [np.frombuffer(c, np.float32) for _, _, c in profiles]
    sizes = [float(c.sum()) for c in counts]
    weights = [c / c.sum() for c in counts]
    order = random.permutation(len(profiles))
    kept_back = max(1, int(len(order) * CALIBRATION_SHARE)) if len(order) > 5 else 0
    calibration, training = order[:kept_back], order[kept_back:]
    embeddings = random.normal(0, 0.1, (1 << BUCKET_BITS, WIDTH))
    linear = random.normal(0, 0.1, (WIDTH, len(languages)))
    bias = np.zeros(len(languages))
    done = 0
    while done < STEPS:
        random.shuffle(training)
        for at in range(0, len(training), BATCH):
            batch = training[at : at + BATCH]
            rate = max(0.01, RATE * (1 - done / STEPS))
            done += 1
            index = np.concatenate([indices[i] for i in batch])
            weight = np.concatenate([weights[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(indices[i]) for i in batch])
            used, inverse = np.unique(index, return_inverse=True)
            mixing = np.zeros((len(batch), len(used)))
            np.add.at(mixing, (row, inverse), weight)
            hidden = mixing @ embeddings[used]
            error = _softmax(hidden @ linear + bias)
            error[np.arange(len(batch)), targets[batch]] -= 1
            error /= len(batch)
            back = error @ linear.T
            linear -= rate * hidden.T @ error
            bias -= 0.1 * rate * error.sum(axis=0)
            embeddings[used] -= rate * 10 * (mixing.T @ back)
    scores = embeddings @ linear
    raw = np.array([weights[i] @ scores[indices[i]] + bias for i in calibration]).reshape(-1, len(languages))
    unlearnt = np.ones(1 << BUCKET_BITS, bool)
    for i in training:
        unlearnt[indices[i]] = False
    strange = np.flatnonzero(unlearnt)
    thin = []
    for i in calibration:
        drawn = random.choice(indices[i], DRAWN, p=weights[i] / weights[i].sum(dtype=np.float64))
        among = np.concatenate([drawn, random.choice(strange, DRAWN)]) if len(strange) else drawn
        thin.append(scores[among].mean(axis=0) + bias)
    both = np.concatenate([raw, np.array(thin).reshape(-1, len(languages))])
    temperature, threshold = calibrate(both, np.tile(targets[calibration], 2), [sizes[i] for i in calibration])
    known, least = coverage([(targets[i], indices[i], weights[i], sizes[i]) for i in range(len(profiles))], len(languages))
    return Model(languages, (scores / temperature).astype(np.float32), bias / temperature, threshold, known, least)


def coverage(texts: list[tuple[int, np.ndarray, np.ndarray, float]], languages: int) -> tuple[np.ndarray, np.ndarray]:
    """The usual buckets by language, and for each language the share of them below which a text is rejected.

    ``texts`` are language, buckets, their weights and the number of subwords. A text's own occurrence does not make a
    subword usual to it.
    """
    having = np.zeros((1 << BUCKET_BITS, languages), np.int64)
    documents = np.zeros(languages)
    for language, found, _, _ in texts:
        having[found, language] += 1
        documents[language] += 1
    needed = np.maximum(KNOWN_IN, KNOWN_SHARE * documents)
    known = having >= needed
    inside: list[list[float]] = [[] for _ in range(languages)]
    outside: list[list[float]] = [[] for _ in range(languages)]
    for language, found, weight, size in texts:
        inside[language].append(float(weight[having[found, language] - 1 >= needed[language]].sum()) + spared(size))
        for other in range(languages):
            if other != language:
                outside[other].append(float(weight[known[found, other]].sum()))
    least = np.zeros(languages)
    for language in range(languages):
        if documents[language] >= LEAST_DOCUMENTS:
            least[language] = COVERED * float(np.quantile(inside[language], UNUSUAL))
            if outside[language]:
                least[language] = min(least[language], float(np.median(outside[language])) + SURPLUS)
    return known, least


def spared(size: float) -> float:
    """The share that a text of so many subwords may lack, as a few say little."""
    return 1 / max(1.0, size) ** 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def calibrate(raw: np.ndarray, targets: np.ndarray, sizes: list[float] | None = None) -> tuple[float, float]:
    """The temperature of the least log loss, and the score up to which a prediction is rejected.

    That is well below the score of every right prediction of a whole text, which are the first rows if ``sizes``
    tells how many subwords they have. Too few of them give no threshold.
    """
    if not len(raw):
        return 1.0, 0.0
    rows = np.arange(len(raw))

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(raw / t)[rows, targets], 1e-12)).mean()

    temperature = float(min(np.geomspace(0.1, 10, 60), key=loss))
    found = _softmax(raw / temperature)
    whole = len(raw) if sizes is None else len(sizes)
    best = found.max(axis=1)[:whole] + (0 if sizes is None else np.array([2 * spared(n) for n in sizes]))
    right = best[found.argmax(axis=1)[:whole] == targets[:whole]]
    return temperature, float(SPARED * right.min()) if whole >= LEAST_DOCUMENTS and len(right) else 0.0


def _predictor(fitted: Model | None):
    """The prediction for one text: language, score, and whether it is rejected."""

    def one(text: str | None) -> tuple[str, float, bool]:
        if fitted is None or text is None or not has_letter(text):
            return UNDETERMINED, 0.0, True
        total, usual, count = np.zeros(len(fitted.languages)), np.zeros(len(fitted.languages)), 0
        for part in segments(text):
            found = buckets(part)
            total += fitted.scores[found].sum(axis=0, dtype=np.float64)
            count += len(found)
            usual += fitted.known[found].sum(axis=0)
        chances = _softmax((total / max(count, 1) + fitted.bias)[None, :])[0]
        best = int(chances.argmax())
        unusual = usual[best] / max(count, 1) + spared(count) < fitted.least[best]
        unsure = chances[best] + 2 * spared(count) <= fitted.threshold
        return fitted.languages[best], float(chances[best]), bool(unsure or unusual)

    return one


def _shared(docs: DataFrame, model: Model | None):
    # Broadcast as plain values, as executors may lack the class.
    return docs.sparkSession.sparkContext.broadcast(model and astuple(model))


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """key, lang_pred, score, rejected of every row, from its whole text alone.

    A text that is null or without a letter is ``und`` with score 0 and rejected; so is every text if there is no model.
    Rows may repeat, very long texts are read whole in parts, other columns are not read, and an empty table
    gives an empty result. Of languages with the same score the first in order is predicted.
    """
    shared = _shared(docs, model)

    def start():
        one = _predictor(Model(*shared.value) if shared.value else None)

        def apply(columns):
            found = [one(text) for text in columns["text"]]
            names = ("lang_pred", "score", "rejected")
            return {"key": columns["key"]} | {name: [f[i] for f in found] for i, name in enumerate(names)}

        return apply

    schema = "key long, lang_pred string, score double, rejected boolean"
    return map_columns(docs.select(F.col(key).alias("key"), "text"), schema, start)


def with_language(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all columns; a missing language is filled in."""
    shared = _shared(docs, model)
    place, name = docs.columns.index(text), docs.columns.index(lang)

    def run(batches):
        import pyarrow as pa

        one = _predictor(Model(*shared.value) if shared.value else None)
        for batch in batches:
            found = [one(value) for value in batch.column(place).to_pylist()]
            given = batch.column(name).to_pylist()
            columns = list(batch.columns)
            filled = [g if g is not None else f[0] for g, f in zip(given, found)]
            columns[name] = pa.array(filled, batch.schema.field(name).type)
            whole = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield whole.filter(pa.array([not f[2] for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

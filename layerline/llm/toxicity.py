"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in its words (and their first four letters), and 0 where none of
them tells anything; a document is toxic unless none of its sentences is, or for another reason:
``1 - (1 - leak) * prod(1 - p)``, a noisy-or. So a long clean text is not worse than a short one. The weights are learnt from
document labels alone, by full-batch Adam on the noisy-or likelihood; afterwards the sentence
probabilities locate what offends.

The fit uses a bounded sample: of each label at most ``Settings.sample`` documents, those with the
least hash of their key, none over ``Settings.sample_bytes`` and all together at most
``Settings.sample_total`` bytes of text. Tasks turn the sample's texts into features and count them; the
driver gets the counts of at most ``2 ** bits`` features, then the places of those that tell labels
apart, as arrays, and fits the weights. Scoring reads all documents in parallel; its model is one array of
``2 ** bits`` numbers, whatever the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import TwoAges, remainder
from layerline.operators.scale import materialize

THRESHOLD = 0.7

#: Sentence ends become line ends, other punctuation blanks, one for one.
CUTS = str.maketrans(
    {c: "\n" for c in ".!?。！？\r"} | {c: " " for c in ",;:\"'()[]{}<>|*_`~«»“”„‘’\t"}
)
WORD_CACHE = 300_000


@dataclass(frozen=True)
class Settings:
    sample: int = 3_000
    sample_bytes: int = 1 << 20
    sample_total: int = 64 << 20
    bits: int = 19
    #: A feature counts if it is in so many documents of the sample and its share among the toxic
    #: ones is higher by more standard errors than chance gives among all such features.
    least_documents: int = 3
    steps: int = 250
    rate: float = 0.2
    decay: float = 1e-5


@dataclass
class Model:
    weights: object  # numpy array; words, then prefixes
    bias: float
    leak: float  # the score without evidence


def _slots(word: str, bits: int) -> tuple[int, int]:
    lower = word.lower()
    half = 1 << (bits - 1)
    return (
        zlib.crc32(lower.encode("utf-8", "surrogatepass")) & (half - 1),
        half + (zlib.crc32(b"^" + lower[:4].encode("utf-8", "surrogatepass")) & (half - 1)),
    )


def _sentences(text: str, bits: int, known: dict[str, tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(number of features of each sentence, the features one after another); without words one sentence."""
    sizes, features = [], []
    for sentence in text.translate(CUTS).split("\n"):
        words = set(sentence.split())
        if words:
            own = set()
            for word in words:
                if word not in known:
                    if len(known) >= WORD_CACHE:
                        known.clear()
                    known[word] = _slots(word, bits)
                own.update(known[word])
            sizes.append(len(own))
            features += sorted(own)
    return sizes or [0], features


@dataclass
class Sample:
    """Labels, and where the telling features are: sentences without any are no evidence.

    Arrays: the label of each document; the features (slots); the feature (by its place) and the sentence of each
    occurrence; the document of each sentence.
    """

    labels: object
    features: object
    tokens: object
    sentence_of: object
    document_of: object


def _useful(in_toxic, in_clean, n_toxic: int, n_clean: int, settings: Settings):
    """Which features count, by presence in documents; the rest would only be memorised."""
    import numpy as np

    share = (in_toxic + in_clean) / (n_toxic + n_clean)
    error = np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_clean)) + 1e-12
    common = in_toxic + in_clean >= settings.least_documents
    least_errors = np.sqrt(2 * np.log(max(2, common.sum())))
    return common & (in_toxic / n_toxic - in_clean / n_clean >= least_errors * error)


def _telling(sizes, slots, features) -> tuple:
    """(features of each sentence that has some, those features by their place), from all of a document."""
    import numpy as np

    place = np.searchsorted(features, slots)
    place[place == len(features)] = 0
    here = features[place] == slots
    counts = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[here], minlength=len(sizes))
    return counts[counts > 0], place[here]


def _gathered(labels, documents: list[tuple], features) -> Sample:
    """A sample from (sizes, places) of each document."""
    import numpy as np

    sizes = [np.asarray(s, np.int64) for s, _ in documents]
    joined = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    tokens = [np.asarray(t, np.int64) for _, t in documents]
    return Sample(
        np.asarray(labels, np.float64),
        features,
        np.concatenate(tokens) if tokens else np.zeros(0, np.int64),
        np.repeat(np.arange(len(joined)), joined),
        np.repeat(np.arange(len(documents)), [len(s) for s in sizes]),
    )


def sample_of(rows: list[tuple[str, int]], settings: Settings = Settings()) -> Sample:
    """Of (text, label) rows at hand."""
    import numpy as np

    known: dict[str, tuple[int, int]] = {}
    labels = np.array([y for _, y in rows], np.float64)
    found = [_sentences(text or "", settings.bits, known) for text, _ in rows]
    found = [(np.array(sizes, np.int64), np.array(slots, np.int64)) for sizes, slots in found]
    features = np.zeros(0, np.int64)
    if len(rows) and labels.min() < labels.max():
        size = 1 << settings.bits
        counts = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
        for (_, slots), label in zip(found, labels):
            counts[int(label > 0)][np.unique(slots)] += 1
        in_clean, in_toxic = counts
        n_toxic = int((labels > 0).sum())
        features = np.flatnonzero(_useful(in_toxic, in_clean, n_toxic, len(rows) - n_toxic, settings))
    none = np.zeros(0, np.int64)
    told = [_telling(*d, features) if len(features) else (none, none) for d in found]
    return _gathered(labels, told, features)


def fit(sample: Sample | list[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """Weights from a sample, or from (text, label) rows. Without both labels, every score is the label there is."""
    import numpy as np

    if isinstance(sample, list):
        sample = sample_of(sample, settings)
    size = 1 << settings.bits
    labels, features, tokens = sample.labels, sample.features, sample.tokens
    sentence_of, document_of = sample.sentence_of, sample.document_of
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(size, np.float32), 0.0, float(len(labels) and labels[0]))
    # Documents without any evidence show the leak.
    silent = np.ones(len(labels), bool)
    silent[document_of] = False
    leak = min(0.5, (labels[silent].sum() + 0.5) / (silent.sum() + 1))

    if not len(features):
        return Model(np.zeros(size, np.float32), 0.0, float(leak))

    weights = np.zeros(len(features) + 1)
    weights[-1] = -4.0  # the bias
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    n = len(document_of)
    for step in range(1, settings.steps + 1):
        z = weights[-1] + np.bincount(sentence_of, weights[tokens], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(document_of, np.log1p(np.exp(np.clip(z, -30, 30))), minlength=len(labels))
        none -= np.log1p(-leak)
        # d(-log likelihood) / d(sum of softplus): 1 for a clean document, else -1 / (e^S - 1)
        pull = np.where(labels > 0, -1 / np.expm1(np.clip(none, 1e-9, 500)), 1.0)
        at = np.clip(pull[document_of] * p, -50, 50)
        slope = np.empty_like(weights)
        slope[:-1] = np.bincount(tokens, at[sentence_of], minlength=len(features)) / len(labels)
        slope[:-1] += settings.decay * weights[:-1]
        slope[-1] = at.sum() / len(labels)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights -= (
            settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        )
    table = np.zeros(size, np.float32)
    table[features] = weights[:-1]
    return Model(table, float(weights[-1]), float(leak))


class Scorer:
    """Log odds of the sentences of a text."""

    def __init__(self, model: Model, bits: int) -> None:
        self._weights, self._bias, self._leak, self._bits = model.weights, model.bias, model.leak, bits
        self._known = TwoAges(WORD_CACHE)

    def _weight(self, word: str) -> float:
        value = self._known.older(word)
        if value is None:
            a, b = _slots(word, self._bits)
            value = float(self._weights[a] + self._weights[b])
            if len(word) > 64:
                return value
        self._known.add(word, value)
        return value

    def _sum(self, words: list[str]) -> float:
        young, weight = self._known.young, self._weight
        return sum([young[w] if w in young else weight(w) for w in words])

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], list[float]]:
        """Spans (code points) and probabilities of the sentences with evidence."""
        import math

        spans, values, start = [], [], 0
        for sentence in text.translate(CUTS).split("\n"):
            words = sentence.split()
            if words:
                evidence = self._sum(words if len(words) < 4 else list(set(words)))
                if evidence:
                    z = self._bias + evidence
                    spans.append((start, start + len(sentence)))
                    values.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
            start += len(sentence) + 1
        return spans, values

    def document(self, probabilities: list[float]) -> float:
        """Noisy-or with the leak."""
        import math

        clean = sum([math.log1p(-min(p, 1 - 1e-12)) for p in probabilities])
        return 1 - (1 - self._leak) * math.exp(clean)


def _encoded(rows: DataFrame, bits: int) -> DataFrame:
    """Texts (the last column) as their sentences' features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known: dict[str, tuple[int, int]] = {}
        for batch in batches:
            sizes, slots = [], []
            for body in batch.column(4):
                own = _sentences(body.as_py() or "", bits, known)
                sizes.append(np.array(own[0], "<i4").tobytes())
                slots.append(np.array(own[1], "<i4").tobytes())
            columns = [*batch.columns[:4], pa.array(sizes, pa.binary()), pa.array(slots, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["order", "tie", "toxic", "bytes", "sizes", "slots"])

    return rows.mapInArrow(run, "order long, tie long, toxic int, bytes long, sizes binary, slots binary")


def _feature_counts(encoded: DataFrame, settings: Settings):
    """Arrow table (slot, toxic, clean): documents with each feature, those in enough documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        counts = np.zeros((2, 1 << settings.bits), np.int64)
        for batch in batches:
            for toxic, slots in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[toxic][np.unique(np.frombuffer(slots.as_buffer(), "<i4"))] += 1
        found = np.flatnonzero(counts.any(axis=0))
        arrays = [pa.array(v) for v in (found, counts[1][found], counts[0][found])]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", "toxic", "clean"])

    rows = encoded.select("toxic", "slots").mapInArrow(run, "slot long, toxic long, clean long")
    counts = rows.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # At most 2 ** bits rows.
    return counts.where(F.col("toxic") + F.col("clean") >= settings.least_documents).orderBy("slot").toArrow()


def training_sample(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Sample:
    """The sample, in an order that does not depend on the run.

    Rows whose crc32 of the key as text is 1 modulo 3 are held out. Labels other than 0 and 1 and
    null keys are not used; a key labelled twice counts as toxic if one label says so. Rows with equal keys and texts
    count once; of keys with several texts at most ``4 * sample`` rows count in all.
    """
    import numpy as np

    spark = documents.sparkSession
    own = (
        labels.where(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id"), 3) != 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("_toxic"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    chosen = [
        own.where(F.col("_toxic") == y).orderBy("_order", "doc_id").limit(settings.sample)
        for y in (0, 1)
    ]
    # At most 2 * sample keys, so the broadcast is bounded.
    listed = F.broadcast(chosen[0].union(chosen[1]))
    rows = documents.select("doc_id", "text").where(F.octet_length("text") <= settings.sample_bytes)
    rows = rows.join(listed, "doc_id").select(
        F.col("_order").alias("order"),
        F.xxhash64("text").alias("tie"),
        F.col("_toxic").alias("toxic"),
        F.octet_length("text").cast("long").alias("bytes"),
        "text",
    )
    columns = ["toxic", "bytes", "sizes", "slots"]
    once = _encoded(rows, settings.bits).groupBy("order", "tie").agg(F.any_value(F.struct(*columns)).alias("own"))
    encoded = materialize(once.select("order", "tie", *(f"own.{c}" for c in columns)), "toxicity-sample")
    first = encoded.select("order", "tie", "toxic", "bytes").orderBy("order", "tie").limit(4 * settings.sample).toArrow()
    inside = np.cumsum(first.column("bytes").to_numpy()) <= settings.sample_total
    first = first.filter(pa.array(inside))
    truth = first.column("toxic").to_numpy().astype(np.float64)
    nothing = np.zeros(0, np.int64)
    if not len(truth) or truth.min() == truth.max():
        return _gathered(truth, [(nothing, nothing)] * len(truth), nothing)
    last, tie = first.column("order")[-1].as_py(), first.column("tie")[-1].as_py()
    encoded = encoded.where((F.col("order") < last) | ((F.col("order") == last) & (F.col("tie") <= tie)))
    counts = _feature_counts(encoded, settings)
    slot, in_toxic, in_clean = (counts.column(n).to_numpy() for n in ("slot", "toxic", "clean"))
    n_toxic = int(truth.sum())
    features = slot[_useful(in_toxic, in_clean, n_toxic, len(truth) - n_toxic, settings)]
    shared = spark.sparkContext.broadcast(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = shared.value
        for batch in batches:
            sizes, places = [], []
            for a, b in zip(batch.column(2), batch.column(3)):
                told = (np.zeros(0), np.zeros(0))
                if len(features):
                    told = _telling(np.frombuffer(a.as_buffer(), "<i4"), np.frombuffer(b.as_buffer(), "<i4"), features)
                sizes.append(told[0].astype("<i4").tobytes())
                places.append(told[1].astype("<i4").tobytes())
            columns = [*batch.columns[:2], pa.array(sizes, pa.binary()), pa.array(places, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["order", "tie", "sizes", "places"])

    told = encoded.select("order", "tie", "sizes", "slots").mapInArrow(
        run, "order long, tie long, sizes binary, places binary"
    )
    # Features that tell labels apart, of texts of ``sample_total`` bytes at most.
    told = told.orderBy("order", "tie").toArrow()
    shared.destroy()
    found = [tuple(np.frombuffer(v, "<i4") for v in d) for d in zip(told.column("sizes").to_pylist(), told.column("places").to_pylist())]
    return _gathered(truth, found, features)


def score(
    documents: DataFrame,
    model: Model,
    *,
    bits: int = Settings.bits,
    key: str = "doc_id",
    text: str = "text",
    located: bool = False,
    least: float = 0.5,
) -> DataFrame:
    """key, score in [0, 1] of each row; ``located`` adds the offending sentences.

    ``offending`` lists start, stop (code points) and probability of each sentence at ``least`` or
    more. A null text counts as empty, an empty one gets the score of no evidence. Null keys and
    equal rows stay; other columns are ignored.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    spans_type = "array<struct<start:long,stop:long,probability:double>>"
    schema = f"`{key}` {kind}, score double" + (f", offending {spans_type}" if located else "")
    # 2 ** bits numbers, whatever the input
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.leak))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value), bits)
        shape = pa.list_(
            pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("probability", pa.float64())])
        )
        for batch in batches:
            scores, found = [], []
            for body in batch.column(1):
                spans, values = scorer.sentences(body.as_py() or "")
                scores.append(scorer.document(values))
                if located:
                    found.append([(a, b, p) for (a, b), p in zip(spans, values) if p >= least])
            columns = [batch.column(0), pa.array(scores, pa.float64())]
            if located:
                columns.append(pa.array(found, shape))
            yield pa.RecordBatch.from_arrays(columns, [key, "score", "offending"][: len(columns)])

    return rows.mapInArrow(run, schema)


def toxic_documents(
    documents: DataFrame,
    labels: DataFrame,
    *,
    settings: Settings = Settings(),
    located: bool = False,
) -> DataFrame:
    """doc_id, held_out, score, predicted (0 or 1) of every document, learnt from its labels.

    Without usable labels every score is 0; where no word tells labels apart, it is the
    share of toxic documents in the sample, one half at most. A null doc_id is not held out.
    """
    model = fit(training_sample(documents, labels, settings), settings)
    scored = score(documents, model, bits=settings.bits, located=located)
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *(["offending"] if located else []),
    )


def keep_clean(
    documents: DataFrame,
    model: Model,
    *,
    bits: int = Settings.bits,
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents scored below the threshold, as they are; a null text counts as empty.

    A filter in one pass: no verdicts are joined back.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.leak))
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value), bits)
        for batch in batches:
            clean = [
                scorer.document(scorer.sentences(body.as_py() or "")[1]) < threshold
                for body in batch.column(at)
            ]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)

"""Toxicity by a convolutional text classifier with thresholds calibrated by language.

The classifier (``cnn.TextCnn``) is fitted on every labelled row.  Few rows are fitted on the driver; for more, counts of buckets over all tasks start it, then each of at most
``MOST_LEARNERS`` tasks trains it in numpy on its own share of the rows, and the mean of what they learned is the model.  Every text is
scored whole.  The score depends on the text alone.  A fifth of the labelled rows is not fitted on.  All of these together give
the classifier's odds their scale, so that the cut ``DEFAULT_THRESHOLD`` is where a document is toxic with the probability ``CUT``, and
thresholds, one for each language with enough rows; the language never enters the score.  Their odds are counted in steps of
1 / ``STEPS``, so only counts of fixed size come together.

Defined results: null and empty texts, and texts without a word, get the score of a text in which
no filter responds; equal texts and repeated rows get equal scores; long texts are read whole; rows with a null language or one unseen among the
labelled rows get the default threshold; without labels of both kinds every score is 0.  An empty table gives an
empty result; columns named like those of the result are replaced, other columns of ``docs`` stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.llm.calibration import logistic_curve
from longrec.llm.cnn import Adagrad, TextCnn, bucket_counts, word_features
from longrec.llm.common import cut_lineage, ship
from longrec.llm.samples import labelled_rows, labelled_sample, score_column
from longrec.llm.words import passes

#: One in this many labelled rows calibrates the thresholds.
CALIBRATION = 5
#: Rows that a task learns from, at least, and tasks that learn, at most.
LEARNER_ROWS, MOST_LEARNERS = 8_000, 256
#: Rounds of a task over its rows.
ROUNDS = 4
#: Bytes of text that a task learns from at a time.
LEARNER_BYTES = 32 << 20
#: Buckets whose vectors are averaged together.
BLOCK_BUCKETS = 1 << 10
#: Steps that a unit of log odds is counted in.
STEPS = 512
#: Rows with label 1, and with label 0, that a language's own threshold needs.
LEAST_ROWS = 20
DEFAULT_THRESHOLD = 0.7
#: Probability that the default threshold stands for: a toxic document kept weighs about 1.8 times a clean one lost.
CUT = 0.36


@dataclass
class ToxicityModel:
    classifier: TextCnn | None
    thresholds: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    shift: float = 0.0

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.classifier is None:
            return np.zeros(len(offsets) - 1)
        return self._moved(self.classifier.scores(data, offsets))

    def _moved(self, p: np.ndarray) -> np.ndarray:
        return self._at(log_odds(p))

    def _at(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * odds + self.shift, -40, 40)))

    def calibrate(self, odds: np.ndarray, hits: np.ndarray, counts: np.ndarray | None = None) -> None:
        """The logistic curve through the classifier's odds, moved so that ``CUT`` comes to lie at the default threshold."""
        if 0 < hits.sum() < (len(hits) if counts is None else counts.sum()):
            slope, shift = logistic_curve(odds, hits, counts=counts)
            if slope > 0:
                self.slope, self.shift = slope, shift + float(log_odds(DEFAULT_THRESHOLD) - log_odds(CUT))

    def threshold(self, lang: Column) -> Column:
        """The threshold of each row's language."""
        result = F.lit(DEFAULT_THRESHOLD)
        for name, value in sorted(self.thresholds.items()):
            result = F.when(lang == name, F.lit(value)).otherwise(result)
        return result


def log_odds(p):
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return np.log(p) - np.log1p(-p)


def best_threshold(
    scores: np.ndarray, labels: np.ndarray, default: float = DEFAULT_THRESHOLD, counts: np.ndarray | None = None, highs: np.ndarray | None = None
) -> float:
    """The cut with the best F1; among equally good ones the nearest to the default.

    With ``counts``, each entry stands for as many rows with scores up to ``highs``, of which ``labels`` have label 1.
    """
    counts, highs = np.ones(len(scores)) if counts is None else counts, scores if highs is None else highs
    order = np.argsort(-scores, kind="stable")
    ranked = scores[order]
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + labels.sum())
    best = f1 == f1.max()
    low = np.append(highs[order][1:], 0)
    best &= ranked > low
    if not best.any():
        return default
    nearest = np.clip(default, low[best] + (ranked - low)[best] / 4, ranked[best] - (ranked - low)[best] / 4)
    return float(nearest[np.argmin(np.abs(nearest - default))])


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", max_rows: int = 8_000, max_bytes: int = 64 << 20,
) -> ToxicityModel:
    """Fit on all labelled rows: on the driver where they are at most ``max_rows`` with ``max_bytes`` of text, else by tasks."""
    named = (label_col, learn, id_col, text_col, lang_col)
    table = labelled_sample(docs, labels, *named, max_rows, max_bytes)
    if labelled_rows(docs.withColumn(text_col, F.lit("")), labels, *named).limit(max_rows + 1).count() == table.num_rows:
        return _fit_here(table)
    ship(docs.sparkSession)
    rows = cut_lineage(labelled_rows(docs, labels, *named))
    held = F.pmod("place", F.lit(CALIBRATION)) == 0
    fitted, rest = rows.where(~held), rows.where(held)
    n, ones = fitted.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        return ToxicityModel(None)
    model = ToxicityModel(trained(fitted, n, ones))
    counts = cut_lineage(counted_odds(rest, model.classifier))
    total = counts.groupBy("step").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"), F.sum("odds").alias("odds")).orderBy("step").toArrow()
    if total.num_rows:
        hits, weights = total["hits"].to_numpy().astype(float), total["n"].to_numpy().astype(float)
        model.calibrate(total["odds"].to_numpy() / weights, hits, weights)
    model.thresholds = dict(language_thresholds(counts, model))
    return model


def _fit_here(table: pa.Table) -> ToxicityModel:
    label = (table["label"].to_numpy() > 0).astype(np.float32)
    fitted = int(len(label) * (1 - 1 / CALIBRATION))
    if len(np.unique(label[:fitted])) < 2:
        return ToxicityModel(None)
    classifier = TextCnn()
    classifier.fit(_features(table["text"].slice(0, fitted), classifier.buckets), label[:fitted])
    rest, raw = table["text"].slice(fitted), np.zeros(len(label) - fitted)
    for first, end, data, offsets in passes(rest):
        raw[first:end] = classifier.scores(data, offsets)
    model = ToxicityModel(classifier)
    model.calibrate(log_odds(raw), label[fitted:])
    scores, langs = model._moved(raw), np.array(table["lang"].to_pylist(), object)[fitted:]
    for lang in sorted({x for x in langs if x is not None}):
        own = langs == lang
        positive = int(label[fitted:][own].sum())
        if min(positive, own.sum() - positive) >= LEAST_ROWS:
            model.thresholds[lang] = best_threshold(scores[own], label[fitted:][own])
    return model


def trained(rows: DataFrame, n: int, ones: int) -> TextCnn:
    """A classifier taught by all ``n`` rows, ``ones`` of them with label 1."""
    classifier = TextCnn()
    classifier.start(*counted_buckets(rows, classifier.buckets), n, float(ones))
    learn_everywhere(rows, classifier, n)
    return classifier


def _features(texts: pa.Array | pa.ChunkedArray, buckets: int) -> list[np.ndarray]:
    """The bucket numbers of each text."""
    found = []
    for _, _, data, offsets in passes(texts):
        numbers, first = word_features(data, offsets, buckets)
        found += np.split(numbers, first[1:-1])
    return found


def counted_buckets(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of ``rows``, and in how many with label 1, each bucket occurs."""

    def run(batches):
        seen, positive = np.zeros(buckets), np.zeros(buckets)
        for batch in batches:
            more, ones = bucket_counts(_features(batch.column("text"), buckets), batch.column("label").to_numpy(), buckets)
            seen += more
            positive += ones
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at]), pa.array(positive[at])], ["bucket", "seen", "positive"])

    counts = rows.select("label", "text").mapInArrow(run, "bucket long, seen double, positive double")
    table = counts.groupBy("bucket").agg(F.sum("seen").alias("seen"), F.sum("positive").alias("positive")).toArrow()
    seen, positive = np.zeros(buckets), np.zeros(buckets)
    seen[table["bucket"].to_numpy()], positive[table["bucket"].to_numpy()] = table["seen"].to_numpy(), table["positive"].to_numpy()
    return seen, positive


def learn_everywhere(rows: DataFrame, classifier: TextCnn, n: int) -> None:
    """Train ``classifier`` on all ``n`` rows: tasks learn from their own shares, in the order of ``place``, and the means of their parameters count.

    The vector of a bucket is the mean over the tasks that moved it; other parameters weigh by the rows of a task.
    """
    learners = min(MOST_LEARNERS, -(-n // LEARNER_ROWS))
    size = classifier.table.shape[1]

    def run(batches):
        model, texts, labels, held, taken = classifier, [], [], 0, 0
        state = Adagrad(model)

        def train() -> None:
            if texts:
                model.train(texts, np.array(labels, np.float32), state, ROUNDS)

        for batch in batches:
            texts += _features(batch.column("text"), model.buckets)
            labels += batch.column("label").to_pylist()
            held, taken = held + batch.column("text").nbytes, taken + batch.num_rows
            if held >= LEARNER_BYTES:
                train()
                texts, labels, held = [], [], 0
        train()
        if taken:
            dense = np.concatenate([p.ravel() for p in model.dense])
            moved = state.touched()
            parts = np.split(moved, np.searchsorted(moved, np.arange(BLOCK_BUCKETS, model.buckets, BLOCK_BUCKETS)))
            blocks = [(-1, taken, b"", dense.tobytes())]
            blocks += [(k, 1, p.astype(np.int32).tobytes(), model.table[p].tobytes()) for k, p in enumerate(parts) if len(p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*blocks, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                ["block", "weight", "places", "body"],
            )

    def mean(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        bodies = [np.frombuffer(b, np.float32).astype(float) for b in table["body"].to_pylist()]
        weights = table["weight"].to_pylist()
        if block < 0:
            places, body = b"", sum(b * w for b, w in zip(bodies, weights, strict=True)) / sum(weights)
        else:
            total, times = np.zeros((BLOCK_BUCKETS, size)), np.zeros(BLOCK_BUCKETS)
            for own, vectors in zip(table["places"].to_pylist(), bodies, strict=True):
                at = np.frombuffer(own, np.int32) - block * BLOCK_BUCKETS
                total[at] += vectors.reshape(-1, size)
                times[at] += 1
            at = np.flatnonzero(times)
            places, body = (at + block * BLOCK_BUCKETS).astype(np.int32).tobytes(), total[at] / times[at, None]
        return pa.table({"block": [block], "places": [places], "body": [body.astype(np.float32).tobytes()]})

    shares = rows.select("place", "label", "text").repartition(learners, "place").sortWithinPartitions("place", "label", "text")
    learned = cut_lineage(shares.mapInArrow(run, "block long, weight long, places binary, body binary"))
    for row in learned.groupBy("block").applyInArrow(mean, "block long, places binary, body binary").collect():
        body = np.frombuffer(row["body"], np.float32)
        if row["block"] >= 0:
            classifier.table[np.frombuffer(row["places"], np.int32)] = body.reshape(-1, size)
        else:
            ends = np.cumsum([p.size for p in classifier.dense])
            for parameter, part in zip(classifier.dense, np.split(body, ends[:-1]), strict=True):
                parameter[...] = part.reshape(parameter.shape)
    classifier.table[0] = 0


def counted_odds(rows: DataFrame, classifier: TextCnn) -> DataFrame:
    """(lang, step, n, hits, odds, low, high): rows and labels by steps of the classifier's odds, whose sum, least and greatest are kept."""
    scored = rows.select("lang", "label", score_column(rows, classifier, "text").alias("p"))
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), "p"))
    odds = scored.select("lang", "label", (F.log(p) - F.log1p(-p)).alias("odds"))
    return odds.groupBy("lang", F.floor(F.col("odds") * STEPS).alias("step")).agg(
        F.count("*").alias("n"), F.sum("label").alias("hits"), F.sum("odds").alias("odds"), F.min("odds").alias("low"), F.max("odds").alias("high")
    )


def language_thresholds(counts: DataFrame, model: ToxicityModel) -> list[tuple[str, float]]:
    """The best threshold of each language with enough rows of both labels."""
    sums = counts.where("lang is not null").groupBy("lang").agg(F.sum("hits").alias("ones"), (F.sum("n") - F.sum("hits")).alias("others"))
    enough = sums.where(F.least("ones", "others") >= LEAST_ROWS).select("lang")

    def best(table: pa.Table) -> pa.Table:
        low, high, hits, n = (table[c].to_numpy().astype(float) for c in ("low", "high", "hits", "n"))
        cut = best_threshold(model._at(low), hits, counts=n, highs=model._at(high))
        return pa.table({"lang": [table["lang"][0].as_py()], "cut": [cut]})

    found = counts.join(enough, "lang", "left_semi").groupBy("lang").applyInArrow(best, "lang string, cut double")
    return [(r["lang"], r["cut"]) for r in found.collect()]


def score(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", lang_col: str = "lang",
    score_name: str = "score", threshold_name: str = "threshold",
) -> DataFrame:
    """``docs`` with the score and the threshold of its language; columns of these names are replaced."""
    threshold = model.threshold(F.col(lang_col)) if lang_col in docs.columns else F.lit(DEFAULT_THRESHOLD)
    return docs.withColumns({score_name: score_column(docs, model, text_col), threshold_name: threshold})


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` below the threshold of their language, with the same columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    scored = score(docs.toDF(*names), model, at[text_col], at.get(lang_col, "none"))
    return scored.where("score < threshold").select(*names).toDF(*docs.columns)

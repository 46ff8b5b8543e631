"""Quality by Naive Bayes support vectors (``nbsvm``), fitted on a bounded sample of labelled rows.

Every text is scored whole, and the score depends on the text alone.  The last part of the sample is not fitted
on; it maps the margins to probabilities.

Defined results: null and empty texts have no n-gram and get the score of the bare intercept;
equal texts and repeated rows get equal scores; long texts are read whole; without labels of both kinds every score is 0.5.  An empty table gives
an empty result; a column named like the score is replaced, other columns of ``docs`` stay as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from longrec.llm.nbsvm import NbSvm, features
from longrec.llm.samples import labelled_sample, score_column
from longrec.llm.words import passes

#: Share of the sample that maps margins to probabilities.
CALIBRATION = 0.2


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = 8_000, max_bytes: int = 64 << 20, buckets: int = 1 << 18,
) -> NbSvm:
    """Fit on at most ``max_rows`` labelled rows and ``max_bytes`` of their texts."""
    table = labelled_sample(docs, labels, label_col, learn, id_col, text_col, None, max_rows, max_bytes)
    model = NbSvm(buckets)
    label = (table["label"].to_numpy() > 0).astype(np.int64)
    fitted = int(len(label) * (1 - CALIBRATION))
    if len(np.unique(label[:fitted])) < 2 or len(np.unique(label[fitted:])) < 2:
        return model
    texts, margins = [], np.zeros(len(label) - fitted)
    for first, end, data, offsets in passes(table["text"].slice(0, fitted)):
        row, bucket = features(data, offsets, buckets)
        texts += np.split(bucket, np.searchsorted(row, np.arange(1, end - first)))
    model.fit(texts, label[:fitted])
    for first, end, data, offsets in passes(table["text"].slice(fitted)):
        margins[first:end] = model.margins(data, offsets)
    model.calibrate(margins, label[fitted:])
    return model


def score(docs: DataFrame, model: NbSvm, text_col: str = "text", score_name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; a column of that name is replaced."""
    return docs.withColumn(score_name, score_column(docs, model, text_col))

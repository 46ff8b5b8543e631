"""Secrets in texts: candidates by patterns, false positives removed by a random forest.

Candidates are long runs of letters, digits and a few signs, and whatever stands after a secret's name and a sign of
assignment or as the password of an address, of any length and with any signs.  Each gets its length and make-up, its character
transitions under those of the whole corpus, the share that dictionary words cover, the path it was found
under and the words and signs around it.  The forest learns from labelled findings; its score of a
finding decides.  Transition counts and the dictionary cover every text; both have a fixed size.

Defined results: null and empty texts have no finding; a null path counts as empty; repeated rows have
their findings each; findings never overlap; without labelled findings of both kinds every score is 0.5;
an empty table gives an empty result; other columns are ignored.  The value itself is not
returned, only its first signs (four, or a third of a short one) and its SHA-256.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, ship, text_or_empty
from longrec.llm.forest import RandomForest
from longrec.llm.words import NON_WORD, Words, passes

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_/+.@-])[A-Za-z0-9_/+.@-]{12,}={0,2}")
LEAST_LETTERS = 20
#: A value after a secret's name: in quotes, or up to a blank or the next parameter.
NAMED = re.compile(
    r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?(?:[_-][a-z0-9]+){0,2}"
    r"[\"']?[ \t]*(?:=>|[=:]{1,2})[ \t]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'](?:(?![&;,](?:\w+=|[\"']))\S)*))"
)
#: Signs at the end of a value without quotes that belong to the text around it.
CLOSING = ".,;:)]}>\"'"
#: The password in scheme://user:password@host.
IN_ADDRESS = re.compile(r"://[^\s/:@]*:([^\s/\"'<>]+)@")
#: Characters a named value without a long run needs to teach the forest.
LEAST_TAUGHT = 8
#: Buckets (as a power of two) of the sketch of word counts behind the dictionary.
DICTIONARY_BITS = 16
#: Characters on each side that the neighbouring words come from.
AROUND = 48
THRESHOLD = 0.5

_KEYWORD = re.compile(r"(?i)(pass(word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?\W*$")
_TEST_PATH = re.compile(r"(?i)test|example|sample|fixture|mock|doc")
_CONFIG_PATH = re.compile(r"(?i)env|conf|secret|credential|\.ya?ml|\.ini|\.properties")
_LETTERS = re.compile(r"[A-Za-z]{2,}")
_EMAIL = re.compile(r"[^@]+@[^@]+\.[^@]+")
_ADDRESS = re.compile(r"\d{1,3}(\.\d{1,3}){3}")
_ACCESS_KEY = re.compile(r"A[KS]IA[0-9A-Z]{16}")
_ASSIGNED = re.compile(r"(?i)(password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?$")

FEATURES = [
    "length", "digits", "upper", "lower", "signs", "hex", "distinct", "entropy", "transition_mean", "transition_least",
    "class_changes", "vowels", "letter_run", "digit_run", "dictionary", "near_dictionary", "near_keyword", "after_sign",
    "after_quote", "before_quote", "has_at", "dots", "slashes", "path_depth", "path_test", "path_config",
]


@dataclass
class CorpusStatistics:
    """Log-probabilities of character transitions and a bitmap of frequent words."""

    transitions: np.ndarray  # 128 x 128
    frequent: np.ndarray  # 2 ** DICTIONARY_BITS

    def knows(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, bool)
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        found = Words(data, np.array([0, len(data)]), NON_WORD)
        return self.frequent[(found.hashes >> np.uint64(64 - DICTIONARY_BITS)).astype(np.int64)]


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> CorpusStatistics:
    """Counts over every text: fixed-size arrays of each task, summed by Spark."""
    ship(docs.sparkSession)
    size = 1 << DICTIONARY_BITS

    def count(batches):
        pairs, words = np.zeros(128 * 128, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, offsets in passes(batch.column("text")):
                plain = data.astype(np.int64)
                both = (plain[:-1] < 128) & (plain[1:] < 128)
                pairs += np.bincount((plain[:-1] * 128 + plain[1:])[both], minlength=len(pairs))
                hashes = Words(data, offsets, NON_WORD).hashes
                words += np.bincount((hashes >> np.uint64(64 - DICTIONARY_BITS)).astype(np.int64), minlength=size)
        for kind, counts in enumerate((pairs, words)):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(used), "slot": used, "n": counts[used]})

    counted = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "kind long, slot long, n long")
    pairs, words = np.zeros(128 * 128), np.zeros(size)
    for kind, slot, n in counted.groupBy("kind", "slot").agg(F.sum("n")).collect():  # at most 128 * 128 + 2 ** 16 rows
        (words if kind else pairs)[slot] = n
    pairs = pairs.reshape(128, 128) + 0.01
    spread = 1.5 * np.median(np.abs(words - np.median(words))) + 1
    return CorpusStatistics(np.log(pairs / pairs.sum(axis=1, keepdims=True)), words > np.median(words) + 6 * spread)


def _longest(flags: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return int((edges[1::2] - edges[::2]).max(initial=0))


def features(value: str, before: str, after: str, path: str, corpus: CorpusStatistics) -> list[float]:
    """The numbers of ``FEATURES`` for one candidate."""
    data = np.frombuffer(value.encode(), np.uint8).astype(np.int64)
    n = len(data)
    digit, upper, lower = (data >= 48) & (data <= 57), (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    kinds = digit + 2 * upper + 3 * lower
    shares = np.bincount(data) / n
    plain = np.minimum(data, 127)
    steps = corpus.transitions[plain[:-1], plain[1:]] if n > 1 else np.zeros(1)
    runs = _LETTERS.findall(value)
    covered = sum(len(w) for w, known in zip(runs, corpus.knows(runs), strict=True) if known)
    near = _LETTERS.findall(before) [-3:] + _LETTERS.findall(after)[:3]
    known = corpus.knows(near)
    return [
        n, digit.mean(), upper.mean(), lower.mean(), (kinds == 0).mean(), float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value))),
        (shares > 0).sum() / n, -(shares[shares > 0] * np.log2(shares[shares > 0])).sum(), steps.mean(), steps.min(),
        (np.diff(kinds) != 0).mean(), np.isin(data | 32, [97, 101, 105, 111, 117]).mean(), _longest(upper | lower), _longest(digit),
        covered / n, known.mean() if len(known) else 0.0, float(bool(_KEYWORD.search(before))), float(before.rstrip("\"' ")[-1:] in ("=", ":")),
        float(before[-1:] in ('"', "'")), float(after[:1] in ('"', "'")), float("@" in value), value.count("."), value.count("/"),
        path.count("/"), float(bool(_TEST_PATH.search(path))), float(bool(_CONFIG_PATH.search(path))),
    ]


def rule_label(value: str, before: str) -> int | None:
    """1 for access keys and values assigned to a secret's name, 0 for plainly harmless runs, else None."""
    if _ACCESS_KEY.fullmatch(value):
        return 1
    digits = sum(c.isdigit() for c in value)
    if _EMAIL.fullmatch(value) or _ADDRESS.fullmatch(value) or digits == 0 or digits == len(value):
        return 0
    return 1 if _ASSIGNED.search(before) else None


def candidates(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether a long run) of the candidates of a text, in order, without overlaps.

    The whole value counts where it was named, unless a long run begins with it and reaches as far.
    """
    runs = [m.span() for m in CANDIDATE.finditer(text) if m.end() - m.start() >= LEAST_LETTERS or any(c.isdigit() for c in m.group())]
    ends = dict(runs)
    named = [m.span(1) for m in IN_ADDRESS.finditer(text)]
    for match in NAMED.finditer(text):
        start, end = match.span(match.lastindex)
        if match.lastindex == 3:
            end = start + len(text[start:end].rstrip(CLOSING))
        if text[start:end].strip() and ends.get(start, start) < end:
            named.append((start, end))
    found, upto, at = [], 0, 0
    for start, end in sorted(set(named)):
        if start < upto:
            continue
        while at < len(runs) and runs[at][0] < end:
            if runs[at][0] >= upto and runs[at][1] <= start:
                found.append((*runs[at], True))
            at += 1
        found.append((start, end, False))
        upto = end
    return found + [(*run, True) for run in runs[at:] if run[0] >= upto]


def findings(
    docs: DataFrame, corpus: CorpusStatistics, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """(id, start, length, shown, sha256, features, rule): every candidate of every text, by character offset."""
    ship(docs.sparkSession)
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), path.alias("path"))

    def scan(batches):
        for batch in batches:
            at, out = [], {"start": [], "length": [], "shown": [], "sha256": [], "features": [], "rule": []}
            for row, (text, where) in enumerate(zip(batch.column("text"), batch.column("path"), strict=True)):
                text, where = text.as_py(), where.as_py()
                for start, end, long in candidates(text):
                    value, before, after = text[start:end], text[max(start - AROUND, 0) : start], text[end : end + AROUND]
                    rule = rule_label(value, before)
                    if not long and (rule == 0 or len(value) < LEAST_TAUGHT):
                        rule = None
                    at.append(row)
                    made = (start, len(value), value[: min(4, len(value) // 3)], hashlib.sha256(value.encode()).hexdigest(),
                            features(value, before, after, where, corpus), rule)
                    for name, item in zip(out, made, strict=True):
                        out[name].append(item)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.int32()]
            columns = [pa.array(out[name], kind) for name, kind in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), *columns], ["id", *out])

    id_type = rows.schema["id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(
        scan, f"id {id_type}, start long, length long, shown string, sha256 string, features array<double>, rule int"
    ))


def fit(labelled: DataFrame, label_col: str = "label", max_rows: int = 20_000) -> RandomForest:
    """A forest from at most ``max_rows`` labelled findings, those with the least hashes.

    Equal values count once, so a key that was copied often does not fill the sample.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).groupBy("sha256", label_col).agg(F.min("features").alias("features"))
    sample = rows.orderBy(F.xxhash64("sha256"), "sha256", label_col).limit(max_rows).toArrow()
    y = np.array(sample[label_col].to_pylist(), np.float64)
    forest = RandomForest()
    if len(np.unique(y)) == 2:
        forest.fit(np.array(sample["features"].to_pylist(), np.float64), y)
    return forest


def score(found: DataFrame, forest: RandomForest, id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(id, start, length, shown, sha256, score, is_secret) of every finding."""
    ship(found.sparkSession)

    def scores(column):
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))
        return pa.array(forest.scores(x))

    scores.__annotations__ = {"column": pa.Array, "return": pa.Array}
    scored = found.withColumn("score", F.arrow_udf(scores, "double")("features"))
    return scored.select(F.col("id").alias(id_col), "start", "length", "shown", "sha256", "score", (F.col("score") >= threshold).alias("is_secret"))

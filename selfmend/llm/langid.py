"""Language ID: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log-probabilities, one row per language and one
column per hash bucket, kept in fixed point so that sums are exact and do not
depend on batch boundaries. It is learnt from counts over every labelled
training text (partial sums per task, added up by a ``groupBy``); its size is
``languages x buckets`` and does not grow with the corpus, so it is collected
and broadcast.

Defined cases: a NULL text, a text without a letter, or a model without any
language gives ``und`` with score 0. A NULL language is not learnt from.
Equal posteriors go to the alphabetically first language. Repeated rows are
scored (and learnt from) once per row; other columns are never read.

A posterior says which language is likeliest, not whether any is likely: over
a line of text it is near 1 for whatever it is. ``keep_identified`` therefore
also asks how well the text's words fit its language (runs of letters; what
holds a digit is left out, so that keys and numbers do not count against a
text): the mean log-probability of their n-grams must reach what the language's
own n-grams have on average (by the counts of the training rows), less
``MARGIN`` and less ``SPREAD`` standard deviations of a mean of so many. A text
without such words is not judged by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import map_arrow, text_column, text_slices

UNDETERMINED = "und"
BUCKET_BITS = 15
ORDERS = (2, 3)
SMOOTHING = 0.5
#: The matrix is broadcast: more languages than this is refused.
MAX_LANGUAGES = 200
#: Fixed-point unit of the log-probabilities.
UNIT = 2.0 ** -16
#: Of the mean log-probability of a text in its language: how far it may lie below the language's own.
MARGIN, SPREAD = 2.0, 4.0
#: A longer text is scored in segments; the segments' sums are added.
SEGMENT_CHARS = 1_000_000
_LETTER = regex.compile(r"\p{L}")
_NO_WORDS = regex.compile(r"\S*\d\S*|[^\p{L}\p{M}]+")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray      # float64, per language
    log_prob: np.ndarray       # int32 fixed point, languages x buckets
    typical: np.ndarray | None = None  # per language: mean and standard deviation of an n-gram's log-probability; for ``fits`` only


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: ``crc32(doc_id as text) mod 3 = 1``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _segments(text: str) -> Iterator[str]:
    """The lower-cased text with a blank at both ends; long ones in pieces
    that overlap so that each n-gram is in exactly one piece per order."""
    padded = f" {text.lower()} "
    if len(padded) <= SEGMENT_CHARS:
        yield padded
        return
    for at in range(0, len(padded), SEGMENT_CHARS):
        yield padded[at:at + SEGMENT_CHARS + max(ORDERS) - 1]


def _codes(segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all segments in one array, and the segments' edges."""
    lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
    codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.concatenate([[0], np.cumsum(lengths)])


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each position."""
    n = len(codes) - order + 1
    mixed = codes[:n] * _FACTORS[0]
    for j in range(1, order):
        mixed = (mixed ^ (mixed >> np.uint32(15))) * _FACTORS[j] + codes[j:n + j]
    mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x7FEB352D + 2 * order)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.intp)


def _spans(edges: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end position of each segment's n-grams. An n-gram belongs to
    the segment in whose first ``SEGMENT_CHARS`` characters it starts."""
    start = edges[:-1]
    return start, np.maximum(start, np.minimum(edges[1:] - order + 1, start + SEGMENT_CHARS))


def _prepare(texts: list[str]) -> tuple[list[str], np.ndarray]:
    segments, owner = [], []
    for i, text in enumerate(texts):
        own = list(_segments(text))
        segments += own
        owner += [i] * len(own)
    return segments, np.array(owner, dtype=np.int64)


def bucket_counts(texts: list[str]) -> np.ndarray:
    """How often each bucket occurs in the texts."""
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    if not texts:
        return total
    segments, _ = _prepare(texts)
    codes, edges = _codes(segments)
    for order in ORDERS:
        if len(codes) < order:
            continue
        buckets = _buckets(codes, order)
        inside = np.zeros(len(codes) + 1, dtype=np.int8)
        start, end = _spans(edges, order)
        np.add.at(inside, start, 1)
        np.add.at(inside, end, -1)
        keep = np.cumsum(inside, dtype=np.int8)[:len(buckets)].astype(bool)
        total += np.bincount(buckets[keep], minlength=1 << BUCKET_BITS)
    return total


def fit(train: DataFrame) -> Model:
    """The model of ``train`` (``text``, ``lang``): every row with both counts."""
    def count(batches):
        counts: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for part in text_slices(batches):
            langs = part.column("lang").to_pylist()
            by: dict[str, list[str]] = {}
            for lang, text in zip(langs, part.column("text").to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                if lang not in counts and len(counts) >= MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
                counts[lang] = counts.get(lang, 0) + bucket_counts(texts)
                n_docs[lang] = n_docs.get(lang, 0) + len(texts)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * (len(at) + 1), pa.string()),
                 "bucket": pa.array(np.append(at, -1), pa.int32()),
                 "n": pa.array(np.append(c[at], n_docs[lang]), pa.int64())})

    counted = (map_arrow(train.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL"), count,
                         "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    if train.where("lang IS NOT NULL").select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    rows = counted.toPandas()                       # at most languages x (buckets + 1) rows
    names = sorted(rows["lang"].unique())
    index = {x: i for i, x in enumerate(names)}
    counts = np.zeros((len(names), 1 << BUCKET_BITS))
    prior = np.zeros(len(names))
    if names:
        lang = rows["lang"].map(index).to_numpy()
        bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
        own = bucket >= 0
        counts[lang[own], bucket[own]] = n[own]
        prior[lang[~own]] = n[~own]
    smooth = counts + SMOOTHING
    log_prob = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    mean = (share * log_prob).sum(axis=1)
    spread = np.sqrt(np.maximum((share * log_prob ** 2).sum(axis=1) - mean ** 2, 0))
    return Model(names, np.log(np.maximum(prior, 1) / max(prior.sum(), 1)),
                 np.rint(log_prob / UNIT).astype(np.int32), np.stack([mean, spread]))


def _sums(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The summed log-probabilities of the texts' n-grams, languages x texts,
    in fixed point, and how many n-grams each text has."""
    segments, owner = _prepare(texts)
    codes, edges = _codes(segments)
    sums, n_grams = np.zeros((len(model.languages), len(texts)), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for order in ORDERS:
        if len(codes) < order:
            continue
        buckets = _buckets(codes, order)
        start, end = _spans(edges, order)
        full = end > start
        bounds = np.stack([start[full], np.minimum(end[full], len(buckets))], axis=1).ravel()
        for k in range(len(model.languages)):
            # sparse rows: the n-gram occurrences of a segment, each with count one
            value = np.append(model.log_prob[k][buckets], np.int32(0))
            part = np.add.reduceat(value, bounds, dtype=np.int64)[::2]
            np.add.at(sums[k], owner[full], part)
        np.add.at(n_grams, owner[full], bounds[1::2] - bounds[::2])
    return sums, n_grams


def _lettered(texts: list[str | None], model: Model) -> list[int]:
    return [i for i, x in enumerate(texts) if x is not None and model.languages and _LETTER.search(x)]


def fits(texts: list[str | None], model: Model) -> np.ndarray:
    """Whether the words of each text are as probable as those of its likeliest language are."""
    words = [None if x is None else _NO_WORDS.sub(" ", x) for x in texts]
    own, out = _lettered(words, model), np.ones(len(texts), dtype=bool)
    if own:
        sums, n = _sums([words[i] for i in own], model)
        top = (sums * UNIT + model.log_prior[:, None]).argmax(axis=0)
        mean = sums[top, np.arange(len(own))] * UNIT / np.maximum(n, 1)
        out[own] = mean >= model.typical[0, top] - MARGIN - SPREAD * model.typical[1, top] / np.sqrt(np.maximum(n, 1))
    return out


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Predicted language and posterior of each text."""
    own = _lettered(texts, model)
    best = [UNDETERMINED] * len(texts)
    score = np.zeros(len(texts))
    if not own:
        return best, score
    sums, _ = _sums([texts[i] for i in own], model)
    log_joint = sums * UNIT + model.log_prior[:, None]
    top = log_joint.argmax(axis=0)
    posterior = 1.0 / np.exp(log_joint - log_joint.max(axis=0)).sum(axis=0)
    for j, i in enumerate(own):
        best[i] = model.languages[top[j]]
        score[i] = posterior[j]
    return best, score


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``__lang_pred`` and ``__score`` for every row of ``docs``, with its
    columns ``keep``. Only those and ``text`` are read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in keep if c != "text"]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def score(batches):
        for part in text_slices(batches):
            best, p = score_texts(part.column("text").to_pylist(), shared.value)
            arrays = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(best, pa.string()), pa.array(p, pa.float64())],
                                             names=[*keep, "__lang_pred", "__score"])

    return map_arrow(docs.select(*columns, "text"), score, f"{fields}, __lang_pred string, __score double")


def train_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learnt from."""
    learnt = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    return docs.where(learnt).select("text", "lang")


def identify(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score``."""
    out = predict(docs, fit(train_rows(docs)), ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is determined with a posterior of
    ``min_score`` or more and which fit it; all columns unchanged."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(fit(train_rows(docs)))

    def kept(part):
        texts = part.column("text").to_pylist()
        best, score = score_texts(texts, shared.value)
        return pa.array((np.array(best) != UNDETERMINED) & (score >= min_score) & fits(texts, shared.value))

    return docs.where(text_column(docs.sparkSession, kept, "boolean", F.col("text"))).select(*names)

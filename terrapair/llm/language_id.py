"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts are gathered per task and summed by Spark; the log-probability matrix
(languages x buckets) is the only thing broadcast, and its size is fixed by BUCKETS and
checked against MAX_MATRIX. Scoring gathers the rows of a whole batch's n-grams at once
and sums them per document: one scan, no shuffle.

The classifier is fitted on a bounded sample of labelled rows: of every language at most
``sample_rows`` different rows, the first ones by a hash of doc_id and text, so that a rare language is
there at any size of the table. Everything is scored. The prior is a language's share of all
labelled rows, and the score is the posterior of the predicted one, tempered to at most
TEMPER independent n-grams.

Defined cases: null text, or a text without a letter, predicts ``und`` with score 0; a null
doc_id is never trained on and is not held out; rows with a null lang are never trained
on; with no labelled rows at all everything is ``und``. Ties go to the first language
in alphabetical order. Whole texts are used. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapair.llm import _text as T

UNKNOWN = "und"
GRAMS = (1, 2, 3)
BUCKETS = 1 << 16
#: Training rows of each language.
SAMPLE_ROWS = 1500
#: Languages at most; with BUCKETS that bounds the matrix before anything is gathered.
MAX_LANGS = 1000
TEMPER = 32
#: A score below this is a guess, to a filter.
MIN_SCORE = 0.4
#: Largest log-probability matrix that may be broadcast, in cells.
MAX_MATRIX = 1 << 26
FOLDS = 5
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _is_letter_byte() -> np.ndarray:
    return np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


_LETTER = _is_letter_byte()
#: Bytes that a character's features see: lower-cased, everything that is no letter is one blank.
_FOLD = np.array([T.LOWER[b] if _LETTER[b] or b >= 128 else 32 for b in range(256)], dtype=np.uint8)


def features(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: (bucket of each n-gram, first n-gram of each text).

    Characters are whole code points: their starts are the bytes that don't continue one.
    """
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    folded = _FOLD[data].astype(T.U64) + T.U64(1)
    sums = T.prefix(folded)
    at = np.append(lead, len(data))
    chars = np.searchsorted(lead, off)
    for n in GRAMS:
        count = max(0, len(lead) - n + 1)
        h = T.mix(T.ranges(sums, at[:count], at[n : n + count]) + T.U64(n)) % T.U64(buckets)
        whole = T.windows(chars, n) if count else np.zeros(0, bool)
        h = h[whole].astype(np.int32)
        per = np.maximum(np.diff(chars) - n + 1, 0)
        yield h, np.concatenate([[0], np.cumsum(per)])


def _train(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in T.slices(batches):
            langs = np.array(T.column(batch, "lang").to_pylist(), dtype=object)
            data, off = T.buffers(T.column(batch, "text"))
            names = sorted(set(langs))
            code = np.searchsorted(names, list(langs)).astype(np.int64)
            for h, start in features(data, off, buckets):
                owner = np.repeat(code, np.diff(start))
                got = np.bincount(owner * buckets + h, minlength=len(names) * buckets).reshape(len(names), buckets)
                for k, name in enumerate(names):
                    seen[name] = seen[name] + got[k] if name in seen else got[k]
        for name, x in seen.items():
            at = np.flatnonzero(x)
            yield pa.record_batch(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(x[at].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    return run


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo the folds, is 0."""
    return F.coalesce(F.expr(f"crc32(cast(cast(`{id_col}` as string) as binary)) % {FOLDS} = 0"), F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities [buckets, languages], log-priors) from labelled, not held-out rows."""
    none = [], np.zeros((buckets, 0), np.float32), np.zeros(0)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("_o"))
    # a language's share, and the hash below which about sample_rows of its rows lie
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy("lang").limit(MAX_LANGS + 1).toArrow()
    langs, total = shares.column("lang").to_pylist(), shares.column("rows").to_numpy()
    if len(langs) > MAX_LANGS or len(langs) * buckets > MAX_MATRIX:
        raise ValueError(f"{len(langs)} languages x {buckets} buckets exceed the broadcast bound; use fewer buckets")
    if not langs:
        return none
    least = -(1 << 63)
    upto = [min(-least - 1, int(least + min(1.0, (1.2 * sample_rows + 60) / n) * (1 << 64))) for n in total.tolist()]
    below = docs.sparkSession.createDataFrame(list(zip(langs, upto)), "_lang string, _upto long")
    near = rows.join(F.broadcast(below), F.col("lang") == F.col("_lang")).where("_o <= _upto").dropDuplicates(["lang", "_o"])
    first = Window.partitionBy("lang").orderBy("_o", "text")  # of about 1.2 sample_rows each
    sample = near.select("lang", "text", "_o").withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= sample_rows).select("text", "lang")
    counts = sample.mapInArrow(_train(buckets), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((buckets, len(langs)))
    code = np.searchsorted(langs, counts.column("lang").to_pylist())
    table[counts.column("bucket").to_numpy(), code] = counts.column("n").to_numpy()
    smooth = 0.5
    log = np.log(table + smooth) - np.log(table.sum(0) + smooth * buckets)
    return langs, log.astype(np.float32), np.log(total / total.sum())


def score_batch(data: np.ndarray, off: np.ndarray, log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(summed log-probabilities [texts, languages], n-grams of each text)."""
    total, grams = np.zeros((len(off) - 1, log.shape[1])), np.zeros(len(off) - 1, np.int64)
    for h, start in features(data, off, len(log)):
        per = np.diff(start)
        some = per > 0
        if some.any():
            total[some] += np.add.reduceat(log[h], start[:-1][some], axis=0, dtype=np.float64)
            grams += per
    return total, grams


def _has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out = n[off[1:]] > n[off[:-1]]
    for i in np.flatnonzero(~out & (off[1:] > off[:-1])):
        out[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _decide(data: np.ndarray, off: np.ndarray, log: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the predicted language, or the number of languages for ``und``; score)."""
    known = _has_letter(data, off) & (log.shape[1] > 0)
    if not known.any():
        return np.full(len(known), log.shape[1]), np.zeros(len(known))
    total, grams = score_batch(data, off, log)
    best = (total + prior).argmax(1)
    # n-grams overlap and repeat: a text counts as TEMPER independent ones at most
    z = (total + prior) * (np.minimum(grams, TEMPER) / np.maximum(grams, 1))[:, None]
    z = np.exp(z - z.max(1, keepdims=True))
    score = z[np.arange(len(z)), best] / z.sum(1)
    return np.where(known, best, log.shape[1]), np.where(known, score, 0.0)


def _predict(langs: list[str], log: np.ndarray, prior: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in T.slices(batches, size=1 << 20):
            data, off = T.buffers(T.column(batch, "text"))
            best, score = _decide(data, off, log, prior)
            yield pa.record_batch(
                [T.column(batch, "doc_id"), T.column(batch, "held_out"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def language_id(docs: DataFrame, train: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """Predict the language of every document: doc_id, held_out, lang_pred, score.

    lang, source and doc_id are never inputs of a prediction. `train` defaults to `docs`.
    """
    langs, log, prior = fit(docs if train is None else train, id_col, text_col, lang_col, sample_rows, buckets)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict(langs, log, prior), SCHEMA)


def _keep(log: np.ndarray, prior: np.ndarray, text_at: int, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in T.slices(iter([whole]), whole.schema.names[text_at], 1 << 20):
                text = T.buffers(batch.column(text_at))
                if log.shape[1]:
                    best, score = _decide(*text, log, prior)
                    good = (best < log.shape[1]) & (score >= min_score)
                else:
                    good = _has_letter(*text)
                yield batch.filter(pa.array(good))

    return run


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """`docs` with all columns, without the documents that are predicted to be ``und`` or
    whose language is a guess (a score below `min_score`).

    If no row has a label there is no language to learn and none to reject: every text with a letter stays.
    """
    _, log, prior = fit(docs, id_col, text_col, lang_col, sample_rows, buckets)
    names = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names))))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields)
    return inner.mapInArrow(_keep(log, prior, names.index(text_col), min_score), schema).toDF(*names)

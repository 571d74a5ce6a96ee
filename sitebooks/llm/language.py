"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import CHUNK, map_text, slices

#: Buckets of the n-gram hash and labelled documents per language used for fitting (bounded sample).
BUCKETS, PER_LANGUAGE = 1 << 15, 3000
#: Characters whose n-grams are held at once.
STEP = 1 << 18
#: A model has a row per language; more labels than this are refused as not being languages.
MOST_LANGUAGES = 2000
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """Letter or not, by code point."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Grams:
    """Hashed 1- to 3-grams of lower-cased letters; anything else counts as a space."""

    def __init__(self, buckets: int):
        self.letters, self.shift = _letters(), np.uint64(64 - int(buckets).bit_length() + 1)

    def __call__(self, texts: pa.Array, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Bucket of each n-gram and, in step, the number of its text, for ``step`` characters at a time."""
        plain = [f" {(t or '').lower()} " for t in texts.to_pylist()]
        ends = np.cumsum([len(t) for t in plain])
        points = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32)
        del plain
        for first in range(0, len(points), step):
            part = points[first : first + step + 2]  # the last n-grams reach into the next part
            letter = self.letters[part]
            c = np.where(letter, part, 32).astype(np.uint64)
            one = c * np.uint64(0x9E3779B97F4A7C15)
            two = (c[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ one[1:]
            three = ((c[:-2] * np.uint64(0x165667B19E3779F9)) ^ two[1:]) if len(c) > 2 else one[:0]
            at = [np.flatnonzero(x[:step]) for x in (letter, letter[1:], letter[1:-1])]
            buckets = [
                (((h[i] + np.uint64(n)) * np.uint64(0xFF51AFD7ED558CCD)) >> self.shift).astype(np.int32)
                for n, (h, i) in enumerate(zip((one, two, three), at))
            ]
            yield np.concatenate(buckets), np.concatenate([np.searchsorted(ends, first + i, "right") for i in at])


@dataclass
class Model:
    """Languages, log priors and the log-probability of each bucket in each language."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray  # buckets x languages


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, per_language: int = PER_LANGUAGE, smooth: float = 0.5
) -> Model:
    """Fit on at most about ``per_language`` documents of each language, chosen by a hash of the whole row.

    The hash covers all columns, so that copies of a text under other ids are
    drawn one by one and a large group of copies does not break the bound.  Rows with a null text or label take no part.  Priors come from all rows.
    Counts are summed in the tasks and then by bucket; the driver gets one
    number per language and bucket.  A table without labels gives a model
    without languages, which answers ``und``.
    """
    plain = [F.col(f"`{f.name}`") for f in labelled.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(*plain).alias("draw")
    )
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels in {lang}")
    names = sorted(counts)
    if not names:
        return Model([], np.zeros(0), np.zeros((buckets, 0), np.float32))
    number = {name: i for i, name in enumerate(names)}
    share = {name: per_language / n for name, n in counts.items() if n > per_language}
    draw = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    kept = rows
    if share:
        limit = F.lit(1.0)
        for name, part in share.items():
            limit = F.when(F.col("lang") == name, F.lit(part)).otherwise(limit)
        kept = rows.where(draw < limit)

    def tally(batches):
        grams, sums = Grams(buckets), {}
        for batch in batches:
            for part in slices(batch, 0, CHUNK):
                label = np.fromiter((number[x] for x in part.column(1).to_pylist()), np.int64, part.num_rows)
                for bucket, doc in grams(part.column(0)):
                    own = label[doc]
                    for i in np.unique(own).tolist():
                        sums[i] = sums.get(i, 0) + np.bincount(bucket[own == i], minlength=buckets)
        for i, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i), pa.int32()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    sums = kept.select("text", "lang").mapInArrow(tally, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((buckets, len(names)), smooth)
    table[sums["bucket"].to_numpy(), sums["lang"].to_numpy()] += sums["n"].to_numpy()
    total = np.array([counts[n] for n in names], float)
    return Model(names, np.log(total / total.sum()), np.log(table / table.sum(0)).astype(np.float32))


def predict(documents: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the posterior probability of the language, to the ``carry`` columns.

    The language with the largest sum of log-probabilities wins, ties go to
    the first name.  Null, empty or letterless texts get ``und`` and 0.  Whole
    texts count; only the text is looked at.  The model, whose size is fixed by
    buckets and languages, goes to every task.  Repeated rows are predicted each
    alike; an empty table gives no rows; carried columns named like the two new
    ones are replaced, others are left out.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    buckets, fields = len(model.table), [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]

    def start():
        m, grams = sent.value, Grams(buckets)
        width = max(1, (4 << 20) // max(1, len(m.languages)))

        def fn(texts):
            names, best = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            if m.languages:
                seen, sums = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(m.languages)))
                for bucket, doc in grams(texts):
                    seen += np.bincount(doc, minlength=len(texts))
                    for a in range(0, len(bucket), width):
                        b, d = bucket[a : a + width], doc[a : a + width]
                        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                        np.add.at(sums, d[first], np.add.reduceat(m.table[b], first, axis=0, dtype=np.float64))
                sums += m.prior
                top = sums.argmax(1)
                score = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
                some = seen > 0
                names[some], best[some] = np.array(m.languages, object)[top[some]], score[some]
            return [pa.array(names.tolist(), pa.string()), pa.array(best)]

        return fn

    return map_text(documents, text, ["doc_id"] if carry is None else carry, fields, start)


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in fitting: a quarter, by crc32 of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))

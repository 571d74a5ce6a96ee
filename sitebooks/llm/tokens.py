"""Token counts without token ids."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "piece_bpe_32k.model"
#: Pre-tokens whose counts every task gets (at most so many, each of at most so many bytes), and
#: documents they are picked from.  Which ones they are changes the work, never the counts.
FREQUENT, LONGEST, PICKED_FROM = 400_000, 64, 60_000
#: Tasks among which a pre-token of more than LONGEST bytes is dealt.
SPREAD = 64


@lru_cache(1)
def processor(model: str):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    pieces = map(sp.id_to_piece, range(sp.vocab_size()))
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError(f"{model} has pieces that reach over a space, so texts cannot be cut at spaces")
    return sp


class Counter:
    """Number of pieces of a pre-token.

    A pre-token is a run of spaces with what follows up to the next space; the
    text's first one gets the space the model puts in front.  No piece of the
    model goes on after a non-space into a space, so no merge crosses the cut
    and the pieces of a text are those of its pre-tokens.  To keep the model
    from adding its own space, pre-tokens are counted behind a letter.
    """

    def __init__(self, model: str = MODEL):
        self.sp = processor(model)
        self.letter = len(self.sp.encode("a"))

    def __call__(self, tokens: list[str]) -> list[int]:
        return [len(ids) - self.letter for ids in self.sp.encode(["a " + t for t in tokens], num_threads=1)]


def pretokens(text: str) -> list[str]:
    """Pre-tokens without their first space; a longer run of spaces keeps the others."""
    if not text:
        return []
    words = text.replace("▁", " ").split(" ")
    if "" not in words:
        return words
    out, spaces = [], 0
    for w in words:
        if w:
            out.append(" " * spaces + w)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(" " * (spaces - 1))
    return out


def frequent(documents: DataFrame, text: str, most: int, model: str) -> dict[str, int]:
    """Counts of frequent pre-tokens, picked from a bounded sample of the documents."""
    rows = documents.where(F.col(text).isNotNull()).select(F.col(text).alias("t"))
    n = rows.count()
    if n > PICKED_FROM:
        rows = rows.sample(PICKED_FROM / n, seed=7)
    words = rows.select(F.explode(F.split(F.regexp_replace("t", "▁", " "), " ")).alias("w"))
    words = words.where((F.octet_length("w") <= LONGEST) & (F.col("w") != ""))
    top = words.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "w").limit(most)

    def count(batches):
        counter = Counter(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counter(batch.column(0).to_pylist()), pa.int32())], names=["w", "n"]
            )

    made = top.select("w").mapInArrow(count, "w string, n int").toPandas()
    return dict(zip(made["w"], made["n"].tolist()))


SPLIT = T.StructType(
    [
        T.StructField("row", T.LongType(), False),
        T.StructField("token", T.StringType()),
        T.StructField("times", T.LongType(), False),
    ]
)


def counts(
    documents: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    model: str = MODEL,
    most_frequent: int = FREQUENT,
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8) and ``n_tokens`` to the ``carry`` columns (default ``doc_id``).

    Texts are cut into pre-tokens, whose frequencies are counted per document.
    Frequent pre-tokens, at most ``most_frequent`` short ones, carry their
    piece counts to every task and are summed there.  All others are dealt by
    pre-token: the task that gets one counts its pieces once, joins the count
    to the documents' frequencies, and the products are summed by document.
    Long pre-tokens and those that begin with further spaces, which are in no
    table, are dealt to several tasks each, so that one in very many documents
    does not pile up.
    No list of ids of a text is made.

    Null and empty texts have 0 bytes and 0 tokens; special strings in a text
    are ordinary text, as in the library; repeated rows are counted each;
    an empty table gives no rows; other columns are ignored.
    """
    carry = ["doc_id"] if carry is None else [c for c in carry if c not in ("n_bytes", "n_tokens")]
    known = documents.sparkSession.sparkContext.broadcast(frequent(documents, text, most_frequent, model))
    source = documents.select(
        F.col(text).cast("string").alias("__text"),
        F.struct(*[F.col(c) for c in carry]).alias("keep") if carry else F.lit(None).cast("struct<x:int>").alias("keep"),
        F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    keep = source.schema["keep"]
    schema = T.StructType(
        [*SPLIT.fields, T.StructField("keep", keep.dataType), T.StructField("n_bytes", T.LongType())]
    )

    def split(batches):
        table = known.value
        get = table.get
        for batch in batches:
            base = {}
            rows, tokens, times, first = [], [], [], []
            for i, t in enumerate(batch.column(0)):
                seen: dict[str, int] = {}
                for w in pretokens(t.as_py() or ""):
                    seen[w] = seen.get(w, 0) + 1
                total, rest = 0, []
                for w, k in seen.items():
                    n = get(w)
                    if n is None:
                        rest.append((w, k))
                    else:
                        total += n * k
                first.append(len(rows))
                rows.append(i)
                tokens.append(None)
                times.append(total)
                for w, k in rest:
                    rows.append(i)
                    tokens.append(w)
                    times.append(k)
            at = pa.array(rows, pa.int64())
            head = [None] * len(rows)
            for i, f in enumerate(first):
                head[f] = i
            head = pa.array(head, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(3).take(at),
                    pa.array(tokens, pa.string()),
                    pa.array(times, pa.int64()),
                    batch.column(1).take(head),
                    batch.column(2).take(head),
                ],
                names=schema.names,
            )

    def join(batches):
        counter, seen = Counter(model), {}
        for batch in batches:
            tokens = batch.column(1).to_pylist()
            if len(seen) > 500_000:
                seen = {}
            new = [w for w in dict.fromkeys(tokens) if w is not None and w not in seen]
            seen.update(zip(new, counter(new)))
            seen[None] = 1
            made = [seen[w] * k for w, k in zip(tokens, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.int64()), batch.column(3), batch.column(4)], names=["row", "n", "keep", "n_bytes"]
            )

    joined_schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("n", T.LongType()), T.StructField("keep", keep.dataType), T.StructField("n_bytes", T.LongType())]
    )
    parts = source.mapInArrow(split, schema)
    # One of these that many documents share is dealt over SPREAD tasks.
    unlisted = (F.octet_length("token") > LONGEST) | F.col("token").startswith(" ")
    salt = F.when(unlisted, F.pmod(F.hash("row"), F.lit(SPREAD))).otherwise(0)
    dealt = parts.repartition(F.when(F.col("token").isNull(), F.hash("row")).otherwise(F.hash("token", salt)))
    summed = (
        dealt.mapInArrow(join, joined_schema)
        .groupBy("row")
        .agg(F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"), F.first("keep", ignorenulls=True).alias("keep"))
    )
    return summed.select(*[F.col(f"keep.{c}").alias(c) for c in carry], "n_bytes", "n_tokens")

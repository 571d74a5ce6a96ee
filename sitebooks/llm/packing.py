"""Packing token sequences by attention cost."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import Words, buffers, byte_class, slices

LENGTH, END_ID = 1024, 0
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Tokens packed at once in a task; less than one sequence of padding is left in each block.
BLOCK = 1 << 21
#: Bytes of text whose distinct words are encoded together.
CHUNK = 2 << 20
#: Encoded words a task remembers (it forgets all when full; results do not depend on it).
REMEMBER = 800_000

#: White space of one byte, and first bytes of characters that may be white space.
WHITE = byte_class([0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)])
SUSPECT = byte_class([0xC2, 0xE1, 0xE2, 0xE3])
raw_words = ~byte_class([0x20])
#: The rank file's encoder looks back over a run of white space by recursion; longer runs go to the tokenizer.
LONG_RUN = re.compile(r"\s{2000}")

PIECES = T.StructType(
    [
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("doc_tokens", T.LongType(), False),
        T.StructField("sequence_id", T.LongType(), False),
        T.StructField("offset", T.LongType(), False),
    ]
)


class Encoder:
    """Ids of whole texts, exactly as the tokenizer file gives them.

    The file's pre-tokens never reach across a single space between two
    characters that are no white space (the space starts the next one).  So a
    text without other runs of white space is cut at its spaces, every distinct
    word of a chunk is encoded once and remembered, and the text's ids are the
    words' ids in a row.  Words are encoded with the rank file of the same
    vocabulary, as is a text that has runs of white space or characters that
    might be such; a text that holds a special string or a very long run of
    white space goes to the tokenizer.  Words are remembered by their bytes; a
    chunk in which two words share a hash is encoded text by text.
    """

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.opens = np.zeros(max(table.values()) + 1, bool)
        self.opens[[i for t, i in table.items() if t.startswith(b" ")]] = True
        self.words: dict[bytes, bytes] = {}

    def one(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or LONG_RUN.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def _learn(self, keys: list[bytes]) -> None:
        """Encode words, each with the space before it, all in one text; an id that opens with a space starts the next word."""
        ids = self.one(b"".join(keys).decode("utf-8", "replace"))
        first = np.flatnonzero(self.opens[ids])
        if len(first) != len(keys):  # a word that the file cuts apart in some other way
            raise ValueError("a word does not start with its space")
        data, edges = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
        self.words.update((k, data[a:b]) for k, a, b in zip(keys, edges, edges[1:]))

    def block(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        raw, offsets = buffers(texts)
        n = len(texts)
        filled = offsets[1:] > offsets[:-1]
        space = WHITE[raw]
        odd = SUSPECT[raw]
        odd[1:] |= space[1:] & space[:-1]
        odd[offsets[:-1][filled]] |= space[offsets[:-1][filled]]
        odd[offsets[1:][filled] - 1] |= space[offsets[1:][filled] - 1]
        sums = np.r_[0, np.cumsum(odd)]
        regular = filled & (sums[offsets[1:]] == sums[offsets[:-1]])
        for i in np.flatnonzero(regular).tolist():
            data = raw[offsets[i] : offsets[i + 1]].tobytes()
            regular[i] = not any(s.encode() in data for s in self.special)
        whole = [np.empty(0, np.uint32)] * n
        for i in np.flatnonzero(filled & ~regular).tolist():
            whole[i] = self.one(texts[i].as_py())
        words = Words(texts.filter(pa.array(regular)), raw_words)
        if len(words.start):
            docs = np.flatnonzero(regular)
            head = np.zeros(len(words.start), bool)
            head[words.of[:-1]] = True
            keys = words.hashes(0)
            keys[head] = ~keys[head]  # the first word of a text has no space before it
            _, at, back = np.unique(keys, return_index=True, return_inverse=True)
            if not words.same(at[back]).all():
                for i in docs.tolist():
                    whole[i] = self.one(texts[i].as_py())
                return whole
            data, heads = words.raw.tobytes(), head[at].tolist()
            names = [
                data[a:b] if first else b" " + data[a:b] for first, a, b in zip(heads, words.start[at].tolist(), words.end[at].tolist())
            ]
            new = [j for j, k in enumerate(names) if k not in self.words]
            if len(self.words) + len(new) > REMEMBER:
                self.words, new = {}, range(len(names))
            if behind := [names[j] for j in new if not heads[j]]:
                self._learn(behind)
            for j in new:
                if heads[j]:
                    self.words[names[j]] = self.one(names[j].decode("utf-8", "replace")).tobytes()
            parts = [self.words[k] for k in names]
            flat = np.frombuffer(b"".join(parts), np.uint32)
            sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
            firsts = np.cumsum(sizes) - sizes
            times = sizes[back]
            ends = np.cumsum(times)
            ids = flat[np.repeat(firsts[back] - (ends - times), times) + np.arange(int(times.sum()))]
            edges = np.r_[0, ends][words.of]
            for j, i in enumerate(docs.tolist()):
                whole[i] = ids[edges[j] : edges[j + 1]]
        return whole


@lru_cache(1)
def encoder(vocabulary: str, ranks: str) -> Encoder:
    return Encoder(vocabulary, ranks)


def cost(n: np.ndarray | int, linear: float = 1.0, quadratic: float = 1 / LENGTH):
    """Work of a piece of n tokens: linear layers plus attention within the piece."""
    return linear * n + quadratic * n * n


def pack(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents with ``sizes`` tokens.

    Full windows of long documents are sequences of their own.  The rests are
    assigned in descending order to the sequence of least cost that has room,
    over as few sequences as their total needs; when none has room for all of
    it, a rest is cut: the roomiest sequence takes what it can, and what is
    left queues again by its size.  So only one sequence's worth of padding
    can remain.
    """
    out, rests, used = [], [], 0
    for doc, n in enumerate(sizes):
        for start in range(0, n - n % length, length):
            out.append((doc, start, length, used, 0))
            used += 1
        if n % length:
            rests.append((n % length, doc, n - n % length))
    if not rests:
        return out
    rests.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rests)
    bins = -(-total // length)
    room = np.full(bins, length)
    spent = np.zeros(bins)
    left: list[list[tuple[int, int, int]]] = [[] for _ in range(length)]  # cut-off parts by size
    at, big = 0, 0
    while at < len(rests) or big > 0:
        while big > 0 and not left[big]:
            big -= 1
        if at < len(rests) and (big == 0 or rests[at][0] >= big):
            n, doc, start = rests[at]
            at += 1
        elif big > 0:
            n, doc, start = left[big].pop()
        else:
            break
        s = int(np.where(room >= n, spent, np.inf).argmin())
        if room[s] < n:
            s = int(room.argmax())
            rest = n - int(room[s])
            left[rest].append((rest, doc, start + int(room[s])))
            big = max(big, rest)
            n = int(room[s])
        out.append((doc, start, n, used + s, length - int(room[s])))
        room[s] -= n
        spent[s] += cost(n)
    return out


def packed(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    end_id: int = END_ID,
    block: int = BLOCK,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its whole text's ids and ``end_id``.  Each input split is
    packed by itself in blocks of about ``block`` tokens, so nothing is
    shuffled and memory is bounded; a block leaves less than ``length`` tokens
    of padding.  ``sequence_id`` is split and running number, thus unique; the
    ids of a piece are little-endian 32-bit values.

    A null or empty text is the end id alone; a null id is kept as null;
    repeated rows are packed each for itself; an empty table gives no rows;
    other columns are ignored.
    """
    source = documents.select(F.col(text).cast("string").alias("__text"), F.col(doc_id).alias("doc_id"))
    schema = T.StructType([source.schema["doc_id"], *PIECES.fields])
    end = np.array([end_id], np.uint32)

    def run(batches):
        encode = encoder(vocabulary, ranks)
        made, held, docs, ids = TaskContext.get().partitionId() << 36, 0, [], []

        def flush(kind):
            nonlocal made
            pieces = pack([len(x) for x in ids], length)
            pieces.sort(key=lambda p: (p[3], p[4]))
            for a in range(0, len(pieces), 4096):
                some = pieces[a : a + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([docs[p[0]] for p in some], kind),
                        *[pa.array([p[k] for p in some], pa.int64()) for k in (1, 2)],
                        pa.array([ids[p[0]][p[1] : p[1] + p[2]].tobytes() for p in some], pa.binary()),
                        pa.array([len(ids[p[0]]) for p in some], pa.int64()),
                        pa.array([made + p[3] for p in some], pa.int64()),
                        pa.array([p[4] for p in some], pa.int64()),
                    ],
                    names=schema.names,
                )
            made += max((p[3] for p in pieces), default=-1) + 1

        for batch in batches:
            for part in slices(batch, 0, CHUNK):
                kind = part.column(1).type
                for one, d in zip(encode.block(part.column(0)), part.column(1).to_pylist()):
                    docs.append(d)
                    ids.append(np.r_[one, end])
                    held += len(one) + 1
                    if held >= block:
                        yield from flush(kind)
                        held, docs, ids = 0, [], []
        if docs:
            yield from flush(kind)

    return source.mapInArrow(run, schema)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by their crc32."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

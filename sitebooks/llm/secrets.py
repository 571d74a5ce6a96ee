"""Secrets in text: fixed patterns, and strings that a primed compressor finds new."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import Words, buffers, byte_class, map_text

# --- fixed values: the patterns of the contract -----------------------------------
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}
# -----------------------------------------------------------------------------------

KINDS = ("assign", "access", "hex", "novel")
HEX_BYTES = byte_class([*range(0x30, 0x3A), *range(0x61, 0x67)])
#: A sensitive word, and how far behind the identifier it is in a candidate may start.
SENSITIVE = re.compile(
    r"passw|passphrase|secret|token|(?:api|private|access)[ _-]?key|credential|bearer|authorization|signature", re.I | re.A
)
MARKS = (b"passw", b"passphrase", b"secret", b"token", b"api", b"private", b"access", b"credential", b"bearer", b"authorization", b"signature")
REACH = 48
CANDIDATE = re.compile(r"(?:(?<!\\)|(?![nrt]))[A-Za-z0-9+/_=-]{20,}")  # not from the letter of an escape on
#: A candidate with the dotted parts and, behind lines of 40 characters or more, the lines that go on with it.
JOINED = re.compile(
    r"""[A-Za-z0-9+/_=-]{20,}(?:\.[A-Za-z0-9+/_=-]{2,}"""
    r"""|(?<=[A-Za-z0-9+/_=-]{40})(?:\r?\n|\\n)[ \t]*[A-Za-z0-9+/_=-]+(?=[ \t]*(?:\r?\n|\\n|["'`]|\Z)))*"""
)
BREAK = re.compile(r"\\n|\s+")
IDENTIFIER = re.compile(r"[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"(?: BLOCK)?-----")
#: Characters on each side of a candidate that count as its surroundings; marginal bytes per character of a novel string.
SURROUND, NOVEL = 512, 0.7
#: Words of code, so that identifiers made of them are nothing new to the compressor.
IDENTIFIERS = (
    "password passwd secret token api_key apikey private_key access_key credential bearer authorization signature "
    "username user_name client_id client_secret tenant session cookie header request response config configuration "
    "settings environment variable default value string integer boolean false true none null undefined return import "
    "export from class function def self this const let var public static void final private protected package include "
    "require module exports example placeholder changeme your_token_here your-secret-here xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx "
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ database connection postgres mysql redis mongodb "
    "localhost http https://www.example.com/ production development staging testing service account access storage "
    "bucket region container image version release document paragraph license copyright general public "
)

SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]
    ),
    False,
)


class Novelty:
    """Marginal compressed bytes of a string among its surroundings, with identifiers known beforehand."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        words = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False)

    def __call__(self, around: str, candidate: str) -> float:
        """Bytes per byte that the candidate adds: near 1 or above for random strings, low for known ones."""
        base = around.encode("utf-8", "replace")
        own = candidate.encode()
        return (len(self.packer.compress(base + own)) - len(self.packer.compress(base))) / len(own)


@lru_cache(1)
def novelty() -> Novelty:
    return Novelty()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the fixed patterns as (start, kind number, end)."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= SHORTEST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= SHORTEST["hex"]]
    return out


def spread(taken: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Begins and ends of the stretches that spans cover, in order and apart."""
    begins, ends = [], []
    for a, _, b in sorted(taken):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    return begins, ends


def novel_spans(text: str, taken: list[tuple[int, int, int]], least: float = NOVEL) -> list[tuple[int, int, int]]:
    """Incompressible strings in a sensitive context that no fixed pattern has reported.

    Every candidate that starts within reach of a sensitive word is measured,
    joined with what goes on with it; where that is too plain or partly
    reported, its parts are, and of a part what stands behind its last
    sensitive word.  A string that is there twice is measured as if it were
    there once.
    """
    out: list[tuple[int, int, int]] = []
    seen: set[tuple[int, int]] = set()
    begins, ends = spread(taken)

    def novel(start: int, end: int) -> bool:
        if (start, end) in seen:
            return False
        seen.add((start, end))
        at = bisect_left(begins, end) - 1  # the last stretch that begins before the candidate ends
        if at >= 0 and ends[at] > start:
            return False
        at = bisect_left(out, (end,)) - 1
        if at >= 0 and out[at][2] > start:
            return False
        own = text[start:end]
        if not (any(x.isdigit() for x in own) and any(x.isalpha() for x in own)):
            return False
        around = text[max(0, start - SURROUND) : start].replace(own, "") + text[end : end + SURROUND].replace(own, "")
        return novelty()(around, BREAK.sub("", own)) >= least

    def measured(start: int, end: int) -> bool:
        if novel(start, end):
            insort(out, (start, 3, end))
            return True
        return False

    words = [m.end() for m in SENSITIVE.finditer(text)]
    for a, reach in reaches(text, words):
        at = a
        while c := CANDIDATE.search(text, at, reach + 20):
            if c.start() > reach:
                break
            start, at = c.start(), JOINED.match(text, c.start()).end()
            if measured(start, at):
                continue
            for part in CANDIDATE.finditer(text, start, at):
                if not measured(*part.span()):
                    last = bisect_left(words, part.end()) - 1  # sensitive words may be the plain part of it
                    if last >= 0 and words[last] > part.start() and (rest := CANDIDATE.match(text, words[last], part.end())):
                        measured(*rest.span())
    return out


def reaches(text: str, words: list[int]) -> list[tuple[int, int]]:
    """Where candidates may start: from the ends of sensitive words on, as stretches in order and apart.

    A word reaches ``REACH`` characters behind its identifier, and that of a key
    block to the block's end.  Each identifier and each block end is looked for
    once, so the time is linear in the text.
    """
    out: list[tuple[int, int]] = []
    run = block = -1
    for at in words:
        if at > run:
            run = IDENTIFIER.match(text, at).end()
        reach = run + REACH
        if ARMOUR.match(text, at):
            if block < at:
                block = text.find("-----END", at)
                block = len(text) + 1 if block < 0 else block  # no end: none for the words to come either
            if block <= len(text):
                reach = max(reach, block)
        if out and at <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], reach))
        else:
            out.append((at, reach))
    return out


def spans_of(texts: pa.Array, least: float = NOVEL) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind number, end) of each text, in order; texts without any mark of a pattern are passed over by byte search."""
    raw, offsets = buffers(texts)
    runs = Words(texts, HEX_BYTES)
    hexed = set(np.unique(runs.doc()[runs.end - runs.start >= SHORTEST["hex"]]).tolist())
    data = raw.tobytes()
    low = data.lower()
    edges = offsets.tolist()
    out = []
    for i in range(len(texts)):
        a, b = edges[i], edges[i + 1]
        marked = any(low.find(m, a, b) >= 0 for m in MARKS)
        if not (marked or i in hexed or data.find(b"AKIA", a, b) >= 0):
            out.append([])
            continue
        t = texts[i].as_py()
        spans = base_spans(t)
        if marked:
            spans += novel_spans(t, spans, least)
        out.append(sorted(spans))
    return out


def scan(documents: DataFrame, text: str = "text", carry: list[str] | None = None, least: float = NOVEL) -> DataFrame:
    """Add ``spans`` (kind, start, end in code points) to the ``carry`` columns (default ``doc_id``).

    ``assign``, ``access`` and ``hex`` are the matches of fixed patterns, leftmost
    and non-overlapping per kind, that are long enough.  ``novel`` are strings
    behind a sensitive word that cost nearly their own length (``least`` bytes
    per byte) when compressed behind the text on both sides of them with a
    dictionary of identifiers, and that overlap no other span.  Spans are ordered by start,
    then by kind in this order.

    Whole texts are scanned where they are read; texts without any mark of a
    pattern are passed over by byte search.  Null and empty texts have no
    spans; repeated rows are scanned each; other columns are ignored.
    """

    def start():
        def fn(texts):
            out = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in spans_of(texts, least)]
            return [pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]

        return fn

    return map_text(documents, text, ["doc_id"] if carry is None else carry, [T.StructField("spans", SPANS, False)], start)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of :func:`scan`."""
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redacted(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """All columns of ``documents``, with every span in ``text`` replaced by ``mark``."""

    def start():
        def fn(texts):
            out = []
            for i, spans in enumerate(spans_of(texts)):
                t = texts[i].as_py()
                at, parts = 0, []
                for a, _, b in spans:
                    if a >= at:
                        parts += [t[at:a], mark]
                    at = max(at, b)
                out.append("".join([*parts, t[at:]]) if spans else t)
            return [pa.array(out, pa.string())]

        return fn

    carry = [c for c in documents.columns if c != text]
    made = map_text(documents, text, carry, [T.StructField(text, T.StringType())], start)
    return made.select(*documents.columns)

"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last characters says so, so passages
that documents share fall into equal chunks wherever they stand. Chunks met
more than once in the corpus are counted on Spark, encoded once and sent to
the tasks as a dictionary of bounded size; the others, and shared ones beyond
that bound, are encoded by the task that meets them and remembered in bounded
memory. The dictionary is only a memory: the result is the same without it.

A chunk's tokens can't just be joined, as words cross the cuts. A space before
a character that is neither white space nor the first one of a special token
always starts a new pre-token, whatever stands before and behind it: a *sync
point*, where the tokens of a part agree with those of the whole. Of a chunk
only the tokens between its first and last sync point are kept; each join is
re-encoded from the last sync point before it to the first one behind it,
taking in whole chunks until both ends agree.
"""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship
from shelfwise.llm.packing import _encoder, _portions

#: characters that the rolling hash covers, and mean, least and most characters of a chunk
ROLL, MEAN, LEAST, MOST = 16, 512, 128, 8192
#: characters of the shared dictionary (a proven bound of what is broadcast), and of a worker's own memory
SHARED_CHARS, OWN_CHARS = 4_000_000, 6_000_000
_BLOCK = 1 << 20


def cuts(text: str, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """End positions of the chunks of ``text``: where the hash of the last
    ``ROLL`` characters is low, at least ``least`` and at most ``most`` after
    the cut before."""
    n = len(text)
    if n <= least:
        return [n] if n else []
    hits = []
    for at in range(0, n, _BLOCK):
        lead = min(at, ROLL - 1)
        g = np.frombuffer(text[at - lead:at + _BLOCK].encode("utf-32-le"), dtype="<u4") * np.uint32(0x9E3779B1)
        factor, span = 0x2C1B3C6D, 1
        while span < ROLL:  # the hash of 2s characters from two of s
            h = g.copy()
            h[span:] += g[:-span] * np.uint32(factor)
            g, factor, span = h, factor * factor & 0xFFFFFFFF, span * 2
        g ^= g >> np.uint32(15)
        hits.append(np.flatnonzero(g[lead:] * np.uint32(0x85EBCA6B) < (1 << 32) // mean) + at + 1)
    out, last = [], 0
    for p in np.concatenate(hits).tolist():
        while p - last > most:
            last += most
            out.append(last)
        if p - last >= least:
            out.append(p)
            last = p
    while n - last > most:
        last += most
        out.append(last)
    if n > last:
        out.append(n)
    return out


def chunks(text: str) -> list[str]:
    ends = cuts(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


@cache
def _sync(vocabulary: str) -> re.Pattern:
    """Pattern of a sync point: a space before a character that is not white
    space and starts no special token."""
    with open(vocabulary, encoding="utf-8") as f:
        first = {t["content"][:1] for t in json.load(f)["added_tokens"]}
    return re.compile(" (?=[^\\s" + "".join(re.escape(c) for c in sorted(first)) + "])")


def _parts(chunk: str, sync: re.Pattern) -> tuple[int, int] | None:
    """First and last sync point of a chunk, None if it has none."""
    first = sync.search(chunk)
    if first is None:
        return None
    last = chunk.rfind(" ")
    while not sync.match(chunk, last):
        last = chunk.rfind(" ", 0, last)
    return first.start(), last


class _Memory:
    """Chunk -> (text before its first sync point, tokens between, text from
    the last): the shared dictionary and, beside it, what this worker met
    most recently, up to ``OWN_CHARS`` characters."""

    def __init__(self, encode, sync: re.Pattern, shared: dict[str, tuple]):
        self.encode, self.sync, self.shared = encode, sync, shared
        self.own: OrderedDict[str, tuple] = OrderedDict()
        self.size = 0

    def learn(self, met: set[str]) -> dict[str, tuple]:
        known = {}
        new = []
        for c in met:
            got = self.shared.get(c)
            if got is None and (got := self.own.get(c)) is not None:
                self.own.move_to_end(c)
            if got is None:
                new.append(c)
            else:
                known[c] = got
        at = [_parts(c, self.sync) for c in new]
        mids = self.encode([c[p[0]:p[1]] if p else "" for c, p in zip(new, at)])
        for c, p, ids in zip(new, at, mids):
            known[c] = self.own[c] = (c[:p[0]], ids, c[p[1]:]) if p else (c, None, "")
            self.size += len(c)
        while self.size > OWN_CHARS and self.own:
            self.size -= len(self.own.popitem(last=False)[0])
        return known


def encode_texts(texts: list[str], memory: _Memory) -> list[bytes]:
    """Token bytes (little-endian unsigned 32 bit) of each text."""
    cut = [chunks(t) for t in texts]
    known = memory.learn({c for cs in cut for c in cs})
    plan: list[list] = []
    joins: list[str] = []
    for cs in cut:
        pieces: list = []
        held: list[str] = []  # text since the last sync point
        for c in cs:
            head, ids, tail = known[c]
            held.append(head)
            if ids is not None:
                pieces += [len(joins), ids]
                joins.append("".join(held))
                held = [tail]
        pieces.append(len(joins))
        joins.append("".join(held))
        plan.append(pieces)
    joined = memory.encode(joins)
    return [b"".join(joined[p] if isinstance(p, int) else p for p in pieces) for pieces in plan]


def shared_dictionary(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, most: int = SHARED_CHARS) -> dict[str, tuple]:
    """The chunks that save most characters by being encoded once, with their
    tokens, up to ``most`` characters in all. Only hashes of chunks are
    shuffled, combined per batch before; the texts of the chosen ones are
    taken in a second scan."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            seen: dict[int, list[int]] = {}
            for t in b.column(0):
                for c in chunks(t.as_py()):
                    got = seen.setdefault(xxhash.xxh3_64_intdigest(c) - (1 << 63), [len(c), 0])
                    got[1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array([x[0] for x in seen.values()], pa.int64()),
                                              pa.array([x[1] for x in seen.values()], pa.int64())], names=["h", "chars", "n"])

    texts = docs.where("text is not null").select("text")
    seen = texts.mapInArrow(count, "h long, chars long, n long").groupBy("h").agg(F.max("chars").alias("chars"), F.sum("n").alias("n"))
    best = (seen.where("n > 1").withColumn("saved", F.col("chars") * (F.col("n") - 1))
                .orderBy(F.desc("saved"), "h").limit(most // LEAST).collect())
    chosen, size = set(), 0
    for r in best:
        if size + r["chars"] > most:
            break
        size += r["chars"]
        chosen.add(r["h"])
    if not chosen:
        return {}
    wanted = spark.sparkContext.broadcast(chosen)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        left = set(wanted.value)
        for b in batches:
            found = []
            for t in b.column(0):
                for c in chunks(t.as_py()):
                    h = xxhash.xxh3_64_intdigest(c) - (1 << 63)
                    if h in left:
                        left.discard(h)
                        found.append((h, c))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())],
                                             names=["h", "chunk"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sync = _encoder(vocabulary, ranks, pattern), _sync(vocabulary)
        for b in batches:
            got = _Memory(encode, sync, {}).learn(set(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(got.keys(), pa.string()), pa.array([x[0] for x in got.values()], pa.string()),
                                              pa.array([x[1] for x in got.values()], pa.binary()), pa.array([x[2] for x in got.values()], pa.string())],
                                             names=["chunk", "head", "ids", "tail"])

    # a chunk of another text with a chosen hash only misses the memory: min takes one of them
    once = texts.mapInArrow(take, "h long, chunk string").groupBy("h").agg(F.min("chunk").alias("chunk"))
    rows = once.mapInArrow(code, "chunk string, head string, ids binary, tail string").collect()
    return {r["chunk"]: (r["head"], None if r["ids"] is None else bytes(r["ids"]), r["tail"]) for r in rows}


def encode(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, reuse: bool = True) -> DataFrame:
    """(doc_id, ids) of every whole text: ``ids`` are the tokens that the
    tokenizers library gives for ``vocabulary`` without special tokens, as
    little-endian unsigned 32-bit integers.

    ``vocabulary`` and ``ranks`` are paths of the same public byte-level
    vocabulary on every executor, ``pattern`` its pre-token pattern. Null and
    empty texts have no tokens; null or repeated ids stay rows of their own;
    other columns, whatever their names, are ignored; an empty table gives an
    empty result. ``reuse=False`` builds no shared dictionary."""
    return _coded(docs, vocabulary, ranks, pattern, reuse, decoded=False)


def _coded(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, reuse: bool, decoded: bool) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(shared_dictionary(rows, vocabulary, ranks, pattern) if reuse else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(_encoder(vocabulary, ranks, pattern), _sync(vocabulary), shared.value)
        for b in batches:
            at = 0
            for texts in _portions(x.as_py() or "" for x in b.column(1)):
                ids = encode_texts(texts, memory)
                columns = {"doc_id": b.column(0).slice(at, len(ids)), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array([spell(x, vocabulary) for x in ids], pa.string())
                yield pa.RecordBatch.from_pydict(columns)
                at += len(ids)

    return rows.mapInArrow(run, "doc_id long, ids binary" + ", decoded string" * decoded)


@cache
def _token_bytes(vocabulary: str) -> list[bytes]:
    """Bytes of each token id: byte-level characters back to bytes, added
    tokens as they are spelled."""
    with open(vocabulary, encoding="utf-8") as f:
        made = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    out = {i: bytes(byte_of[c] for c in t) for t, i in made["model"]["vocab"].items()}
    out |= {t["id"]: t["content"].encode() for t in made["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]


def spell(ids: bytes, vocabulary: str) -> str:
    """The text of tokens, special ones included; bytes that are no UTF-8
    become U+FFFD."""
    return b"".join(map(_token_bytes(vocabulary).__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (as ``encode`` gives it) with ``decoded``, as ``spell``
    gives it; null ids give a null text."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [spell(x.as_py(), vocabulary) if x.is_valid else None for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")


def round_trip(docs: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """``decode`` of ``encode``, in one pass: doc_id, ids and the text of the
    ids of every document."""
    return _coded(docs, vocabulary, ranks, pattern, reuse=True, decoded=True)


def digests(coded: DataFrame) -> DataFrame:
    """Per document of ``round_trip``: number of tokens and the SHA-256 of
    its ids and of its decoded text."""
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))

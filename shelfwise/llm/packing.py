"""Packing of documents into token sequences by Karmarkar-Karp differencing.

A document's tokens are cut into full windows, which are sequences of their
own, and a tail, cut into short pieces. The pieces are dealt to groups of
bounded size; in each group multiway differencing spreads them over windows:
every piece starts as a partition with one filled window, and the two
partitions with the largest imbalance are merged with opposing order (fullest
against emptiest) until one is left, whose windows are nearly equal. If a
window exceeds the capacity the group is solved again with one window more.

Token ids are read once: pieces are cut by the document's own length, so their
checksums are known before packing, and packing moves lengths only.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, stage

WINDOW = 2048
#: tail pieces have at most this many tokens
PIECE = 512
END_ID = 1
#: pieces in a group on average
GROUP = 1500
_CACHE_WORDS = 250_000
_LOOSE_SPACE = re.compile(r" (?!\S)")


@functools.cache
def _encoder(vocabulary: str, ranks: str, pattern: str):
    """Function from a list of texts to their token bytes (little-endian
    unsigned 32 bit).

    ``ranks`` holds the same vocabulary as ``vocabulary`` in rank form, which
    encodes faster; texts that spell a special token go to the file's own
    tokenizer, as only that knows it. A space before a non-space always starts
    a new pre-token, so a text is encoded word by word with a bounded memory of
    words; words not met before are encoded in one call, where the tokens that
    begin with a space mark the words' starts. Texts with another kind of
    white space after a space are encoded whole."""
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(vocabulary)
    special = [t.content for t in full.get_added_tokens_decoder().values()]
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
    spaced = np.zeros(max(table.values()) + 1, dtype=bool)
    spaced[[i for t, i in table.items() if t[:1] == b" "]] = True
    known: dict[str, bytes] = {}

    def learn(words: set[str]) -> None:
        new = [w for w in words if w not in known]
        if len(known) + len(new) > _CACHE_WORDS:
            known.clear()
            new = list(words)
        if new:
            ids = np.array(encode(" " + " ".join(new)), dtype="<u4")
            data = ids.tobytes()
            at = (np.flatnonzero(spaced[ids]) * 4).tolist()
            at.append(len(data))
            known.update(zip(new, [data[i:j] for i, j in zip(at, at[1:])], strict=True))

    def run(texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        words: set[str] = set()
        split = {}
        for i, text in enumerate(texts):
            if any(s in text for s in special):
                out[i] = array("I", full.encode(text, add_special_tokens=False).ids).tobytes()
            elif not text or _LOOSE_SPACE.search(text):
                out[i] = array("I", encode(text)).tobytes()
            else:
                first, *rest = text.split(" ")
                out[i] = array("I", encode(first)).tobytes()
                split[i] = rest
                words.update(rest)
        learn(words)
        for i, rest in split.items():
            out[i] += b"".join(map(known.__getitem__, rest))
        return out

    return run


def _portions(texts: Iterator[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters (one longer text alone)."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def pieces_of(ids: bytes, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of a document's token bytes."""
    n = len(ids) // 4
    cuts = list(range(0, n - n % window, window))
    full = len(cuts)
    tail = n - full * window
    # unequal pieces (full ones and a rest) balance better than equal ones
    cuts += range(full * window, n, piece) if tail else []
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(cuts, [*cuts[1:], n], strict=True)]


def differencing(lengths: list[int], windows: int) -> list[int]:
    """Window number of each length: multiway Karmarkar-Karp. A partition is
    its window loads in ascending order (least load taken out) with a tree of
    what was merged; memory is lengths x windows small integers."""
    n = len(lengths)
    if windows <= 1 or n <= 1:
        return [0] * n
    # a node: the order in which the second child's windows, reversed, meet the first's
    heap: list[tuple[int, int]] = []
    loads: dict[int, np.ndarray] = {}
    trail: list[tuple[int, int, np.ndarray]] = []
    for i, x in enumerate(lengths):
        v = np.zeros(windows, dtype=np.int32)
        v[-1] = x
        loads[i] = v
        heap.append((-x, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        v = loads.pop(a) + loads.pop(b)[::-1]
        order = np.argsort(v, kind="stable")
        v = v[order]
        v -= v[0]
        node = n + len(trail)
        trail.append((a, b, order.astype(np.int16 if windows < 1 << 15 else np.int32)))
        loads[node] = v
        heapq.heappush(heap, (-int(v[-1]), node))
    # from the root down: which final window each window of a node is
    place: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)}
    out = [0] * n
    for node in range(n + len(trail) - 1, n - 1, -1):
        a, b, order = trail[node - n]
        final = np.empty(windows, dtype=np.int64)
        final[order] = place.pop(node)
        place[a], place[b] = final, final[::-1]
    for i in range(n):
        out[i] = int(place[i][-1])
    return out


def pack_group(lengths: list[int], window: int = WINDOW) -> tuple[list[int], int]:
    """Window number of each length and the number of windows: the fewest that
    could hold them, one more whenever a window exceeds the capacity."""
    total = sum(lengths)
    windows = max(1, -(-total // window))
    while True:
        got = differencing(lengths, windows)
        if not lengths or np.bincount(got, weights=lengths, minlength=windows).max() <= window:
            return got, windows
        windows += 1


def tokenize(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every
    document; null texts count as empty and have the end id alone."""
    ship(docs.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary, ranks, pattern)
        end = array("I", [END_ID]).tobytes()
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [])
            texts = (x.as_py() or "" for x in b.column(1))
            coded = (ids for portion in _portions(texts) for ids in encode(portion))
            for ident, ids in zip(b.column(0).to_pylist(), coded, strict=True):
                ids += end
                for start, length, crc in pieces_of(ids, window, piece):
                    for c, x in zip(cols, (ident, start, length, crc, len(ids) // 4), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``pieces`` (as ``tokenize`` gives them) with sequence_id and offset.

    Full pieces are sequences of their own. The others are dealt to groups by
    a hash of the row number they were written with, so a document or id with
    very many pieces spreads over all groups; a group is solved in one task and
    its size doesn't grow with the input. sequence_id: the group times 2^20
    plus the window's number there; full pieces: 2^62 plus the row number."""
    ship(pieces.sparkSession)
    rows = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    short = rows.where(F.col("length") < window)
    groups = max(1, -(-short.count() // group))

    def solve(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        place, _ = pack_group(f["length"].tolist(), window)
        f["sequence_id"] = np.array(place, dtype=np.int64) + f["grp"].astype(np.int64) * (1 << 20)
        f = f.sort_values(["sequence_id", "row"], ignore_index=True)
        f["offset"] = f.groupby("sequence_id")["length"].cumsum() - f["length"]
        return f[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = short.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("grp").applyInPandas(solve, schema)
    full = rows.where(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """Every piece of every document with its place: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary`` and ``ranks`` are paths of the same public tokenizer on
    every executor, ``pattern`` its pre-token pattern. Null and empty texts
    give one piece, the end id. Rows with null or repeated ids are documents
    of their own; other columns are ignored; an empty table gives an empty
    result."""
    return pack(tokenize(docs, vocabulary, ranks, pattern, window, piece), window)

"""Alignment of two tokenizers' tokens by byte offsets, in Arrow columns.

A batch's tokens are lists by document. Flattened, with the documents they
stand in (parent indices), their byte lengths are summed up per document
(segmented cumulative sums); a hash join of both sides' (document, end) keys
gives the offsets where tokens of both end, which cut the tokens into groups.
Pairs of tokens whose byte ranges overlap are links; ``Table.group_by`` counts
them per document and over the batch, and Spark merges the batches' counts
into the number of documents that hold an id pair linked.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bpe_chunks import _token_bytes
from shelfwise.llm.common import drop_path, ship, small_or_plain, staged
from shelfwise.llm.packing import _portions

#: characters that are encoded and that are aligned at a time (a longer text alone)
ENCODED, PORTION = 1 << 22, 1 << 19
_LOOSE_SPACE, _SYNC = re.compile(r" (?!\S)"), re.compile(r"(?<=\S) (?=\S)")


@cache
def _coders(vocabulary: str, ranks: str, pattern: str, pieces: str):
    """(function from texts to both sides' ids as lists by text, bytes of A's
    ids, bytes of B's ids). A reads a space and the text, B adds that space
    itself; strings of special tokens are plain text for both.

    A space between characters that are not white space starts a token on
    either side (A's pattern starts one there; no piece of B holds a space
    but at its start), so the parts between such spaces are encoded alone,
    each different one once."""
    import sentencepiece
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    first = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
    model = sentencepiece.SentencePieceProcessor(model_file=pieces)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    worded = not any("▁" in p.lstrip("▁") for p in names)
    spaced = np.zeros(max(table.values()) + 1, dtype=bool)
    spaced[[i for t, i in table.items() if t[:1] == b" "]] = True

    def lists_of(words: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        plain = [" " not in w and w[:1].strip() != "" for w in words]
        joined = [w for w, p in zip(words, plain) if p]
        # in one call for A: the tokens that begin with a space mark the words' starts
        ids = np.array(first(" " + " ".join(joined)) if joined else [], dtype=np.int32)
        starts = np.flatnonzero(spaced[ids])
        if len(joined) == len(words):
            a = pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)).astype(np.int32)), pa.array(ids))
        else:
            parts = iter(np.split(ids, starts[1:]))
            a = _lists([next(parts).tolist() if p else first(" " + w) for w, p in zip(words, plain)])
        return a, _lists(model.encode(words, num_threads=1))

    def run(texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        odd = [not t or not worded or t[0] == " " or _LOOSE_SPACE.search(t) is not None for t in texts]
        plain = pc.split_pattern(pa.array([t for t, o in zip(texts, odd) if not o], pa.string()), " ")
        others = pa.array([(_SYNC.split(t) if worded else [t]) if t else [] for t, o in zip(texts, odd) if o], pa.list_(pa.string()))
        flags = np.array(odd)
        words = pa.concat_arrays([plain, others]).take(pa.array(np.where(flags, len(plain) + np.cumsum(flags), np.cumsum(~flags)) - 1))
        coded = words.flatten().dictionary_encode()
        ends = pc.subtract(words.offsets, words.offsets[0])
        out = []
        for side in lists_of(coded.dictionary.to_pylist()):
            ids = side.take(coded.indices)
            out.append(pa.ListArray.from_arrays(ids.offsets.take(ends), ids.values))
        return out[0], out[1]

    spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return run, _token_bytes(vocabulary), spelled


def _lists(ids: list[list[int]]) -> pa.ListArray:
    ends = np.array([0, *accumulate(map(len, ids))], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))))


def _slice(lists: pa.ListArray, at: int, n: int) -> pa.ListArray:
    """``n`` lists from ``at`` on, with their own values and offsets from 0."""
    part = lists.slice(at, n)
    return pa.ListArray.from_arrays(pc.subtract(part.offsets, part.offsets[0]), part.flatten())


def _ends(lists: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flattened ids, the document of each, and the byte offset in it where
    each ends: a running sum less the sum before the document."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(lengths.take(ids))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(lists.offsets)
    return ids, doc, pc.subtract(total, before.take(doc))


def _spelled(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    """The joined bytes of each list's tokens."""
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, table.take(lists.values)), pa.scalar(b"", pa.binary()))


def _rows(doc: pa.Array, end: pa.Array, row: str) -> pa.Table:
    """A side's tokens for the join: the document and end in one key, and the row."""
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(doc.cast(pa.int64()), 40), end), row: np.arange(len(doc), dtype=np.int32)})


def align_lists(a: pa.ListArray, b: pa.ListArray, texts: pa.Array, spelled_a: pa.Array, spelled_b: pa.Array) -> dict[str, pa.Array]:
    """Columns n_a, n_b, n_groups, n_links, groups (text), link_a, link_b,
    link_n (a document's different linked id pairs and how often each is
    linked) for lists of ids by document and the bytes they should spell."""
    n = len(texts)
    good = pc.and_(pc.equal(_spelled(a, spelled_a), texts), pc.equal(_spelled(b, spelled_b), texts))
    if not pc.all(good).as_py():  # those documents have no tokens
        a, b = (pc.if_else(good, x, pa.scalar([], x.type)) for x in (a, b))
    size_a, size_b = pc.binary_length(spelled_a).cast(pa.int64()), pc.binary_length(spelled_b).cast(pa.int64())
    ids_a, doc_a, end_a = _ends(a, size_a)
    ids_b, doc_b, end_b = _ends(b, size_b)
    shared = _rows(doc_a, end_a, "a").join(_rows(doc_b, end_b, "b"), "key", join_type="inner", use_threads=False)

    # a token's group: how many shared ends stand before its own
    ia, ib, da, db = (x.to_numpy().astype(np.int64) for x in (ids_a, ids_b, doc_a, doc_b))
    ends_a, ends_b = np.zeros(len(ia), dtype=np.int64), np.zeros(len(ib), dtype=np.int64)
    ends_a[shared["a"].to_numpy()] = ends_b[shared["b"].to_numpy()] = 1
    ga, gb = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    # offsets that run on over the batch's documents, so that one sorted search serves all of them
    at_a, at_b = np.cumsum(size_a.to_numpy()[ia]), np.cumsum(size_b.to_numpy()[ib])

    # groups as text: A tokens before B tokens in each group, and behind each token what separates it from the next
    in_a, in_b = np.bincount(ga, minlength=len(shared)), np.bincount(gb, minlength=len(shared))
    place_a = np.arange(len(ia)) + (np.cumsum(in_b) - in_b)[ga]
    place_b = np.arange(len(ib)) + np.cumsum(in_a)[gb]
    last_a, last_b = ends_a.astype(bool), ends_b.astype(bool)  # the last token of its group on its side
    ends_doc = np.append(db[1:] != db[:-1], True)[:len(db)]
    spot = np.empty(len(ia) + len(ib), dtype=np.int64)
    spot[place_a] = ia * 4 + np.where(last_a, 2, 1)
    spot[place_b] = ib * 4 + np.where(last_b, np.where(ends_doc, 0, 3), 1)
    words = _decimals(max(len(spelled_a), len(spelled_b))).take(pa.array(spot))
    n_a, n_b = (np.diff(x.offsets.to_numpy()).astype(np.int64) for x in (a, b))
    offsets = pa.array(np.concatenate([[0], np.cumsum(n_a + n_b)]).astype(np.int32))
    groups = pc.binary_join(pa.ListArray.from_arrays(offsets, words), "")

    # links: an A token meets the B tokens that end behind its start and begin before its end
    low = np.searchsorted(at_b, at_a - size_a.to_numpy()[ia], side="right")
    high = np.searchsorted(at_b - size_b.to_numpy()[ib], at_a, side="left")
    many = high - low
    left = np.repeat(np.arange(len(ia)), many)
    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    span_a, span_b = len(spelled_a), len(spelled_b)
    links = pa.table({"link": (da[left] * span_a + ia[left]) * span_b + ib[right]}).group_by("link", use_threads=False).aggregate([([], "count_all")])
    order = np.argsort(links["link"].to_numpy())
    link, times = links["link"].to_numpy()[order], links["count_all"].to_numpy()[order]
    held = np.bincount(link // (span_a * span_b), minlength=n)
    to = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
    as_list = lambda x: pa.ListArray.from_arrays(to, pa.array(x.astype(np.int32)))
    return {"n_a": pa.array(n_a), "n_b": pa.array(n_b),
            "n_groups": pa.array(np.bincount(da, weights=ends_a, minlength=n).astype(np.int64)),
            "n_links": pa.array(np.bincount(da, weights=many, minlength=n).astype(np.int64)),
            "groups": groups.cast(pa.string()), "link_a": as_list(link // span_b % span_a), "link_b": as_list(link % span_b),
            "link_n": as_list(times)}


@cache
def _decimals(ids: int) -> pa.Array:
    """Each id in decimal with each of the four separators behind it."""
    return pa.array([f"{i}{s}" for i in range(ids) for s in ("", ",", "|", ";")])


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "link_a array<int>, link_b array<int>, link_n array<int>")


def align(docs: DataFrame, first: tuple[str, str, str], second: str) -> DataFrame:
    """Per document its groups and links (``ALIGNED``). ``first``: vocabulary,
    rank form and pattern of a byte-level BPE; ``second``: a sentencepiece
    model; both as paths that every executor has.

    Null and empty texts, and texts whose tokens don't spell a space and the
    text on both sides, have no tokens: zeros, an empty text, empty lists.
    Null or repeated ids stay rows of their own; other columns, whatever
    their names, are ignored; an empty table gives an empty result."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, bytes_a, bytes_b = _coders(*first, second)
        spelled_a, spelled_b = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
        for batch in batches:
            at = 0
            for texts in _portions((x.as_py() or "" for x in batch.column(1)), ENCODED):
                a, b = code(texts)
                done = 0
                for part in _portions(iter(texts), PORTION):
                    whole = pa.array([b" " + t.encode() if t else b"" for t in part], pa.binary())
                    columns = align_lists(_slice(a, done, len(part)), _slice(b, done, len(part)), whole, spelled_a, spelled_b)
                    yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(at + done, len(part)), **columns})
                    done += len(part)
                at += done

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, docs): in how many documents each id pair is linked. A batch's
    documents are counted in its task, so a pair that many documents hold is
    one row a batch."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            t = pa.table({"a": pc.list_flatten(x.column(0)), "b": pc.list_flatten(x.column(1))})
            yield from t.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "docs"]).to_batches()

    parts = aligned.select("link_a", "link_b").mapInArrow(count, "a int, b int, docs long")
    return parts.groupBy("a", "b").agg(F.sum("docs").alias("docs"))


def with_link_counts(aligned: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``aligned`` (as ``align`` gives it) without the link lists, with
    n_best (links whose pair is in as many documents as any pair of the same
    A id) and count_sum (sum of the pairs' documents over the links).

    ``keep`` changes what is written of the aligned rows (a digest instead of
    the groups, say). The table of pairs is broadcast while it is small and
    shuffled beyond that; a document's sums are made in the task that reads
    it, before the shuffle."""
    spark = aligned.sparkSession
    rows, _ = staged(keep(aligned).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts, path = staged(pair_counts(rows), "pairs")
    best = counts.groupBy("a").agg(F.max("docs").alias("most"))
    key = lambda a, b: F.shiftleft(F.col(a).cast("long"), 32) + F.col(b)
    pairs, _ = staged(counts.join(best, "a").select(key("a", "b").alias("pair"), "docs", (F.col("docs") == F.col("most")).alias("is_best")), "pairs")
    drop_path(spark, path)
    links = (rows.select("row", F.explode(F.arrays_zip("link_a", "link_b", "link_n")).alias("l"))
                 .select("row", key("l.link_a", "l.link_b").alias("pair"), F.col("l.link_n").cast("long").alias("n")))
    sums = (links.join(small_or_plain(pairs), "pair").groupBy("row")
                 .agg(F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    plain = [c for c in rows.columns if c not in ("row", "link_a", "link_b", "link_n")]
    return rows.select("row", *plain).join(sums, "row", "left").select(*plain, zero("n_best"), zero("count_sum"))


def digests(docs: DataFrame, first: tuple[str, str, str], second: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 (empty without tokens)."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    out = with_link_counts(align(docs, first, second), lambda df: df.select(*[c for c in df.columns if c != "groups"], digest))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

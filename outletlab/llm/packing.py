"""Packing of tokenised documents into sequences by swap-based local search.

Documents are tokenised and cut where they are longer than a sequence. The
pieces are dealt by hash to groups of bounded size; in each group a best-fit
start is improved by moving a piece, exchanging one for one and one for two
between underfull bins. Every step raises the sum of squared fills; bins that
run empty are dropped.
"""

from __future__ import annotations

import base64
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from outletlab.session import cut_lineage

SEQUENCE_TOKENS = 1024
END_ID = 2
GROUP_PIECES = 25_000  # pieces a group holds on average; a group is one task's work
END_OF_TEXT = "<|endoftext|>"

_encoders: dict[str, object] = {}


def encoder(ranks_path: str):
    """The byte-level BPE of the rank file (one a worker). It gives the ids
    of the tokenizers file with the same vocabulary, four times as fast, but
    raises ValueError on white space of about a million characters in a row
    (``encode``); the tests compare the two."""
    if ranks_path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[ranks_path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                  special_tokens={END_OF_TEXT: len(ranks)})
    return _encoders[ranks_path]


def encode(text: str, ranks_path: str) -> np.ndarray:
    """The text's ids; what the fast encoder can't split is encoded with the
    tokenizers file beside the rank file."""
    try:
        return encoder(ranks_path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        whole_path = os.path.splitext(ranks_path)[0] + ".json"
        if whole_path not in _encoders:
            from tokenizers import Tokenizer

            _encoders[whole_path] = Tokenizer.from_file(whole_path)
        return np.array(_encoders[whole_path].encode(text, add_special_tokens=False).ids, np.uint32)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
                 ranks_path: str | None = None, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """(id, piece, start, length, ids) of every document: its ids and END_ID,
    cut into ``size`` tokens with the shorter piece first. With ``digest``
    the last column is ids_crc32 (of little-endian unsigned 32-bit ids), so
    that the ids needn't be kept. A null text is empty."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_path or default_ranks()
        for batch in source:
            rows, start, length, value = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or "", ranks), END_ID).astype("<u4")
                first = len(ids) % size or min(size, len(ids))
                cuts = [0, *range(first, len(ids) + 1, size)]
                rows += [i] * (len(cuts) - 1)
                start += cuts[:-1]
                length += np.diff(cuts).tolist()
                parts = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                value += [zlib.crc32(p.tobytes()) for p in parts] if digest else parts
            rows = np.array(rows, np.int64)
            piece = np.arange(len(rows)) - np.searchsorted(rows, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(value, pa.int64() if digest else pa.list_(pa.int32()))],
                names=["id", "piece", "start", "length", "ids_crc32" if digest else "ids"])

    last = StructField("ids_crc32", LongType()) if digest else StructField("ids", ArrayType(IntegerType()))
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("piece", IntegerType()),
                         StructField("start", LongType()), StructField("length", LongType()), last])
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(batches, schema)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Pieces, the longest first, each into the fullest bin that holds it.
    The bins' gaps are bits of one integer, so the search is a shift."""
    bins: list[list[int]] = []
    with_gap: list[list[int]] = [[] for _ in range(size + 1)]
    gaps = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = gaps >> n
        if fit:
            gap = n + (fit & -fit).bit_length() - 1
            b = with_gap[gap].pop()
            if not with_gap[gap]:
                gaps ^= 1 << gap
            bins[b].append(i)
        else:
            gap, b = size, len(bins)
            bins.append([i])
        gap -= n
        if gap:
            with_gap[gap].append(b)
            gaps |= 1 << gap
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Empty bins by steps that raise the sum of squared fills.

    The emptiest bin gives: a piece moves to the smallest gap that holds it,
    or is exchanged for one shorter piece or two shorter pieces of a fuller
    bin, the step that empties it most being taken. A bin that allows no step
    is set aside until another bin changes it. Ends when the bins are as few
    as the tokens allow, or no bin has a step left.
    """
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    least, alive = math.ceil(int(fill.sum()) / size), len(bins)

    def offers(b: int) -> list[tuple[int, int, int, int]]:
        """(tokens given back, bin, piece, piece) for none, one or two pieces of a bin."""
        own = bins[b]
        return [(0, b, -1, -1), *((int(lengths[i]), b, i, -1) for i in own),
                *((int(lengths[i] + lengths[j]), b, i, j) for x, i in enumerate(own) for j in own[x + 1:])]

    table = np.array([o for b in np.flatnonzero(fill < size).tolist() for o in offers(b)], np.int64).reshape(-1, 4)
    waiting = fill.astype(float)  # of the bins that may give
    waiting[fill >= size] = np.inf
    while alive > least and len(waiting) and np.isfinite(waiting[d := int(waiting.argmin())]):
        owner = table[:, 1]
        usable = (owner != d) & (fill[owner] >= fill[d])
        room = table[:, 0] + size - fill[owner]
        best, step = 0, None
        for i in bins[d]:
            n = int(lengths[i])
            gain = np.where(usable & (table[:, 0] < n) & (room >= n), n - table[:, 0], 0)
            if len(gain) and gain.max() > best:
                best, step = int(gain.max()), (i, int(gain.argmax()))
        if step is None:
            waiting[d] = np.inf
            continue
        i, (_, b, *back) = step[0], table[step[1]].tolist()
        back = [x for x in back if x >= 0]
        bins[d] = [x for x in bins[d] if x != i] + back
        bins[b] = [x for x in bins[b] if x not in back] + [i]
        fill[d] -= best
        fill[b] += best
        table = table[(owner != d) & (owner != b)]
        new = [o for x in (b, d) if 0 < fill[x] < size for o in offers(x)]
        table = np.concatenate([table, np.array(new, np.int64).reshape(-1, 4)])
        for x in (b, d):
            waiting[x] = fill[x] if 0 < fill[x] < size else np.inf
        alive -= not fill[d]
    return [b for b in bins if b]


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (id, piece, length and any others) with sequence_id and offset.

    Pieces are dealt to count / group_pieces groups by hash, so a group's size
    doesn't depend on the keys; only the last bins of each group stay
    underfull, which costs less than one sequence in thousands.
    """
    count = pieces.count()
    groups = max(1, round(count / group_pieces))
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64("id", "piece", "start"), F.lit(groups)))
    schema = StructType([*(f for f in pieces.schema), StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending")])
        lengths = table["length"].to_numpy()
        bins = local_search(best_fit(lengths, size), lengths, size)
        order = np.array([i for b in bins for i in b], np.int64)
        sequence = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        taken = np.cumsum(lengths[order]) - lengths[order]
        offset = taken - taken[np.searchsorted(sequence, sequence)]
        group = table["__group"][0].as_py()
        table = table.drop_columns(["__group"]).take(pa.array(order))
        return (table.append_column("sequence_id", pa.array((group << 32) + sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    return dealt.groupBy("__group").applyInArrow(pack, schema)


def sequences(packed: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """(sequence_id, ids) of pieces that carry their ids: the token arrays in
    order of offset. A sequence holds at most ``size`` tokens."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Null and empty texts are one piece holding END_ID alone; null ids and
    repeated rows are packed like any other row; an empty table gives no rows;
    other columns are not read.
    """
    pieces = cut_lineage(token_pieces(docs, id_col, text_col, digest=True), "pieces")
    return pack_pieces(pieces).withColumnRenamed("id", id_col)

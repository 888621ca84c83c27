"""Best-two-fit packing of token sequences.

Texts are tokenised once, in tasks, into pieces of at most ``capacity`` tokens;
only ids' checksums and places leave the task. Packing then depends on lengths
alone, so the plan is made from the length histogram (at most ``capacity``
counts, whatever the corpus size): a bin is filled greedily with the longest
lengths that fit, its smallest document gives way to two unpacked documents
that fit the expanded gap more tightly, and the resulting pattern is used as
often as the counts allow. Pieces get their rank within their length by
distributed prefix counts and read their bin and offset off the plan: no group
of pieces is ever held together, also when a third of all have one length.

Ids equal those of the ``tokenizers`` library for ``byte_bpe_50k.json`` with
add_special_tokens=False (tests compare them); they come from the same
vocabulary through ``tiktoken``, which is several times faster, except that
texts with very long unbroken runs go to ``tokenizers``, whose merge is not
quadratic in a run's length.

Defined cases: null or empty text = the end id alone; null doc_id is kept;
repeated rows are packed once each; an empty table = an empty result; further
columns are ignored."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

CAPACITY = 1024
END_ID = 2
LONG_RUN = 400  # characters without a break beyond which a text goes to ``tokenizers``
RANGES = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_encoders: dict = {}


def encoder(json_path: str | None = None, ranks_path: str | None = None):
    """text -> numpy uint32 ids; made once per Python worker."""
    import public_tokenizers as P
    json_path, ranks_path = json_path or P.path("byte_bpe_50k.json"), ranks_path or P.path("byte_bpe_50k.tiktoken")
    if (json_path, ranks_path) in _encoders:
        return _encoders[json_path, ranks_path]
    import tiktoken
    from tokenizers import Tokenizer
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    slow = Tokenizer.from_file(json_path)
    special = {t.content: i for i, t in slow.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("byte_bpe", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        runs = text.split()
        if max(map(len, runs), default=0) > LONG_RUN or len(text) - sum(map(len, runs)) > len(text) // 2 + LONG_RUN:
            return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")

    _encoders[json_path, ranks_path] = encode
    return encode


def cut_pieces(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all of ``capacity`` but the first, which takes the rest."""
    n = len(ids)
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(s, capacity) for s in range(first, n, capacity)]


def tokenize_pieces(docs: DataFrame, capacity: int = CAPACITY, json_path: str | None = None,
                    ranks_path: str | None = None) -> DataFrame:
    """(doc_id, text) -> one row per piece: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for i, (s, n) in enumerate(cut_pieces(ids, capacity)):
                    doc.append(d)
                    piece.append(i)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                              pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def _tighter_pair(counts: np.ndarray, gap: int, least: int) -> tuple[int, int] | None:
    """The two available lengths with the largest sum in (least, gap], longest first."""
    have = np.flatnonzero(counts[:gap] > 0)
    have = have[have > 0]
    best = None
    hi = len(have) - 1
    for i, a in enumerate(have):
        while hi >= 0 and a + have[hi] > gap:
            hi -= 1
        if hi < i:
            break
        j = hi if hi > i or counts[a] > 1 else -1
        if j >= 0 and a + have[j] > least:
            least = int(a + have[j])
            best = (int(have[j]), int(a))
            if least == gap:
                break
    return best


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Length histogram -> [(lengths of a bin with their number, how many such bins)]."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = []
    while counts.any():
        left, used, gap = counts.copy(), [], capacity
        while gap > 0:
            fits = np.flatnonzero(left[:gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            k = min(int(left[length]), gap // length)
            used += [length] * k
            left[length] -= k
            gap -= k * length
        while gap > 0:
            smallest = used[-1]
            pair = _tighter_pair(left, min(gap + smallest, capacity), smallest)
            if pair is None:
                break
            used[-1:] = pair
            left[smallest] += 1
            left[pair[0]] -= 1
            left[pair[1]] -= 1
            gap += smallest - sum(pair)
            used.sort(reverse=True)
        need: dict[int, int] = {}
        for length in used:
            need[length] = need.get(length, 0) + 1
        times = min(int(counts[length]) // n for length, n in need.items())
        for length, n in need.items():
            counts[length] -= n * times
        plan.append((need, times))
    return plan


def _intervals(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, uses per bin, offset), by rank."""
    out: dict[int, list] = {}
    seen: dict[int, int] = {}
    sequence = 0
    for need, times in plan:
        offset = 0
        for length, n in need.items():
            out.setdefault(length, []).append((seen.get(length, 0), sequence, n, offset))
            seen[length] = seen.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, **paths) -> DataFrame:
    """(doc_id, text) -> pieces with sequence_id and offset."""
    pieces = written(tokenize_pieces(docs, capacity, **paths), "pieces")
    return place(pieces, capacity)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) -> + sequence_id, offset."""
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANGES))
    parts = pieces.groupBy("length", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    parts = written(parts, "piece-ranges")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    places = _intervals(plan_bins(histogram, capacity))
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lows = parts.select("length", "part", (F.sum("n").over(upto) - F.col("n")).alias("lo"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("part", part).withColumn("r", F.row_number().over(within) - 1)
    ranked = (ranked.join(lows, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("lo") + F.col("r")).alias("rank")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                t = places[int(one)]
                t = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - t[:, 0]
                sequence[at] = t[:, 1] + nth // t[:, 2]
                offset[at] = t[:, 3] + nth % t[:, 2] * one
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")

"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A text is lower-cased (A-Z) and reduced to its words, joined by one space and
closed by one end byte; before it the end byte stands as often as the context is
long. Each byte is eight binary decisions, each with a context tree of its own:
the node of depth d holds how often the decision fell to 0 and to 1 behind the
same d bytes, in the training texts. Its Krichevsky-Trofimov estimate and the
weighted product of its children give P_w = (P_kt + prod P_w(child)) / 2, at full
depth P_w = P_kt. A decision's probability mixes the estimates (n1 + 1/2) / (n +
1) along its path, node d taken with the weight that the tree ends there,
P_kt / (P_kt + prod P_w(child)), so a score is exactly the probability that the
mixture over all trees gives the text after the training texts were seen.

On Spark:

* one pass over the documents counts byte strings of depth + 1 (numpy, per task;
  every count of every node follows from them) and words, in training texts and
  in all texts; Spark sums them;
* the trees are cut into units: below the shortest context end behind which at most
  ``UNIT`` distinct strings stand, a task builds and prices the whole subtree; the
  levels above, which join the units' roots, are grouped sums up to the root and
  equi-joins back down. Nodes are longs, a parent is its child's low bytes;
* a second pass prices the texts. Frequent strings and words come as a broadcast
  table of bounded size, chosen by a histogram of counts; the occurrences of all
  others, summed per text, are joined with the full tables. What is frequent
  decides only where a price is looked up.

Tables grow with the distinct strings of the corpus; nothing else but the bounded
table goes through the driver.

Defined cases: null or blank text = the end alone; null doc_id = '' in the fold;
repeated rows each get a row; no training texts = every decision costs one bit and
a base score of 0; an empty table = an empty result; further columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlens.llm.common import text_runs, written

#: Bytes of context; strings of DEPTH + 1 bytes are longs, so it is 6 at most.
DEPTH = 5
END = 10
#: Strings of one unit of the trees, built and priced in one task.
UNIT = 1 << 17
#: Strings are priced from a broadcast table of at most so many bytes, words from another.
HOT_STRINGS, HOT_WORDS = 1 << 24, 1 << 22
#: Longer words are looked up by a join.
HOT_WORD = 64
#: Counts are dealt to 2^9 buckets by hash: shifts of a 64-bit hash.
_BUCKET_BITS = np.uint64(64 - 9)
#: Bytes of text counted or priced at once in a task, and distinct strings or words held before a flush.
CHUNK, PRICED = 3 << 20, 1 << 20
HELD = 800_000
LN10, LN2 = float(np.log(10)), float(np.log(2))


def training(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x09:0x0E] = 0x20
_FOLD[0x41:0x5B] += 0x20


def _normal(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words in lower case, joined by one space: all bytes, and where each text
    begins (one more entry: the end)."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
    data = _FOLD[np.frombuffer(text.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]]
    at = at - at[0]
    word = data != 0x20
    # a space stays where a word follows in the same text; then a text's first byte must be a word's
    keep = word.copy()
    keep[:-1] |= word[1:]
    last = at[1:][at[1:] > at[:-1]] - 1
    keep[last] = word[last]
    kept = np.flatnonzero(keep)
    begin = np.searchsorted(kept, at)
    first = kept[begin[:-1][begin[1:] > begin[:-1]]]
    first = first[~word[first]]
    if len(first):
        keep[first] = False
        kept = np.flatnonzero(keep)
        begin = np.searchsorted(kept, at)
    return data[kept], begin


def _words(normal: tuple[np.ndarray, np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """All words, and the text each belongs to."""
    data, begin = normal
    texts = pa.LargeStringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(data))
    lists = pc.split_pattern(texts, " ")
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(words, "")          # an empty text splits into one empty word
    return words.filter(some), owner.filter(some).to_numpy()


def _strings(normal: tuple[np.ndarray, np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings (depth of context, then the byte) as longs, and where each text's begin."""
    data, begin = normal
    lengths = np.diff(begin)
    # a block for each text: the end byte ``depth`` times, its bytes, the end byte
    blocks = np.r_[0, np.cumsum(lengths + depth + 1)]
    padded = np.full(blocks[-1] + 8, END, np.uint8)
    body = np.ones(blocks[-1], bool)
    body[(blocks[:-1, None] + np.arange(depth)).ravel()] = False
    body[blocks[1:] - 1] = False
    padded[:blocks[-1]][body] = data
    # a string starts at each place of a block but the last ``depth``
    starts = np.ones(blocks[-1], bool)
    starts[(blocks[1:, None] - 1 - np.arange(depth)).ravel()] = False
    longs = np.ndarray((blocks[-1],), ">u8", padded, strides=(1,)).astype(np.uint64)
    longs >>= np.uint64(8 * (7 - depth))
    return longs.view(np.int64)[starts], begin[:-1] + np.arange(len(lengths))


def _merged(parts: list) -> tuple:
    """Distinct keys of parts (keys, n, n_all), with their sums."""
    keys, trains, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, trains, counts = keys[order], trains[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[new], np.add.reduceat(trains, new), np.add.reduceat(counts, new)


def _merged_words(tables: list) -> pa.Table:
    sums = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum"), ("n_all", "sum")])
    return sums.rename_columns(["word", "n", "n_all"]).combine_chunks()


_WEIGHTS = np.random.default_rng(1).integers(0, 1 << 63, 257).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _word_bucket(words: pa.Array) -> np.ndarray:
    """Bucket of each (non-empty) word: a weighted sum of its bytes, mixed."""
    at = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = np.frombuffer(words.buffers()[2], np.uint8)[at[0]:at[-1]].astype(np.uint64) + np.uint64(1)
    begin = at[:-1] - at[0]
    place = np.arange(len(data)) - np.repeat(begin, np.diff(at))
    return (np.add.reduceat(data * _WEIGHTS[place % 257], begin) * np.uint64(0x9E3779B97F4A7C15) >> _BUCKET_BITS).astype(np.int64)


def _dealt(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by bucket, the buckets that occur, where each begins in that order, and the end)."""
    order = np.argsort(bucket, kind="stable")
    sorted_ = bucket[order]
    new = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    return order, sorted_[new], np.r_[new, len(bucket)]


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    values = np.ascontiguousarray(values)
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


_PARTS = ["bucket", "words", "values", "n", "n_all"]


def _string_parts(keys, n, n_all) -> pa.RecordBatch:
    order, buckets, cuts = _dealt(((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> _BUCKET_BITS).astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.array(np.zeros(len(buckets), bool)), *(_blobs(c[order].astype(np.int64), cuts) for c in (keys, n, n_all))], names=_PARTS)


def _word_parts(table: pa.Table) -> pa.RecordBatch:
    words = table["word"].combine_chunks() if table["word"].num_chunks != 1 else table["word"].chunk(0)
    order, buckets, cuts = _dealt(_word_bucket(words))
    joined = pc.binary_join_element_wise(words.take(pa.array(order)), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, 8 * joined.offset)
    text = np.frombuffer(joined.buffers()[2], np.uint8)[at[0]:at[-1]]
    return pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.array(np.ones(len(buckets), bool)), _blobs(text, (at - at[0])[cuts]),
                                       *(_blobs(table[c].to_numpy()[order].astype(np.int64), cuts) for c in ("n", "n_all"))], names=_PARTS)


def count(docs: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(strings, words): key or word, n in training texts, n_all in all texts.

    A task counts its texts and hands its sums on as one row per bucket (a hash of the
    string or word), packed; the tasks behind the shuffle merge the rows of one bucket
    after the other."""
    def tally(batches):
        strings, words, n_strings, n_words = [], [], 0, 0
        for text, train in text_runs(batches, ("text", "train"), CHUNK):
            train = train.to_numpy(zero_copy_only=False).astype(bool)
            for side in (True, False):
                some = text.filter(pa.array(train == side))
                if not len(some):
                    continue
                normal = _normal(some)
                keys = _strings(normal, depth)[0]
                keys.sort()
                new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                n = np.diff(np.r_[new, len(keys)])
                strings.append((keys[new], n * side, n))
                seen = pc.value_counts(_words(normal)[0])
                n = seen.field("counts").to_numpy()
                words.append(pa.table({"word": seen.field("values"), "n": n * side, "n_all": n}))
                n_strings, n_words = n_strings + len(new), n_words + len(seen)
            if n_strings > HELD:
                strings = [_merged(strings)]
                n_strings = len(strings[0][0])
                if n_strings > HELD // 2:
                    yield _string_parts(*strings.pop())
                    n_strings = 0
            if n_words > HELD:
                words = [_merged_words(words)]
                n_words = len(words[0])
                if n_words > HELD // 2:
                    yield _word_parts(words.pop())
                    n_words = 0
        if n_strings:
            yield _string_parts(*_merged(strings))
        if n_words:
            yield _word_parts(_merged_words(words))

    def merge(batches):
        out, n_out = [], 0

        def flat(strings, words):
            if strings:
                keys, n, n_all = _merged(strings)
                out.append(pa.table([pa.array(keys), pa.nulls(len(keys), pa.string()), pa.array(n), pa.array(n_all)], names=_COUNTS))
            if words:
                sums = _merged_words(words)
                out.append(pa.table([pa.nulls(len(sums), pa.int64()), sums["word"].cast(pa.string()), sums["n"], sums["n_all"]], names=_COUNTS))
            return sum(len(t) for t in out)

        bucket, strings, words, held = None, [], [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in _PARTS), strict=True):
                if row[0].as_py() != bucket:
                    if flat(strings, words) > 50_000:
                        yield from pa.concat_tables(out).combine_chunks().to_batches()
                        out.clear()
                    bucket, strings, words, held = row[0].as_py(), [], [], 0
                n, n_all = (np.frombuffer(row[i].as_buffer(), np.int64) for i in (3, 4))
                if row[1].as_py():
                    text = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(row[2].as_buffer())], np.int64)), row[2].as_buffer())
                    words.append(pa.table({"word": pc.list_flatten(pc.split_pattern(text, " ")).slice(0, len(n)), "n": n, "n_all": n_all}))
                else:
                    strings.append((np.frombuffer(row[2].as_buffer(), np.int64), n, n_all))
                held += len(n)
                if held > HELD:
                    strings, words = [_merged(strings)] if strings else [], [_merged_words(words)] if words else []
                    held = 0
        flat(strings, words)
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    parts = docs.select("text", training(F.col("doc_id")).alias("train")).mapInArrow(tally, "bucket int, words boolean, values binary, n binary, n_all binary")
    dealt = parts.repartition("bucket").sortWithinPartitions("bucket")
    both = written(dealt.mapInArrow(merge, "key long, word string, n long, n_all long"), "ctw-counts")
    return both.filter("key IS NOT NULL").drop("word"), both.filter("word IS NOT NULL").drop("key")


_COUNTS = ["key", "word", "n", "n_all"]


def _ln_gamma(x):
    """ln Gamma(x) for x > 0, of columns or arrays: Stirling's series eight steps up, exact to 1e-11."""
    ln = F.log if isinstance(x, Column) else np.log
    z = x + 8
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    return (z - 0.5) * ln(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - ln(steps)


def _ln_kt(n0, n1):
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _ln_gamma(n0 + 0.5) + _ln_gamma(n1 + 0.5) - _ln_gamma(n0 + n1 + 1.0) - 1.1447298858494002


class _Subtree:
    """The trees of decision ``i`` below one context of ``start`` bytes, from the strings
    behind it: a list of levels, deepest last, nodes in the order of their contexts read
    backwards, so a parent's children lie side by side."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, i: int, start: int, depth: int):
        byte = keys & 255
        self.bit = (byte >> (7 - i)) & 1
        backwards = (keys >> 8).astype(np.uint64).byteswap().astype(np.int64) >> np.int64(64 - 8 * depth) if depth else np.zeros_like(keys)
        backwards &= (1 << 8 * depth) - 1
        place = ((byte >> (8 - i)) << (8 * depth)) | backwards
        self.order = np.argsort(place, kind="stable")
        place = place[self.order]
        ones = n * self.bit
        n0, n1 = (n - ones)[self.order], ones[self.order]
        self.levels = []
        children = None
        for d in range(depth, start - 1, -1):
            ids = place >> (8 * (depth - d)) if d == depth else ids >> 8
            new = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            group = np.repeat(np.arange(len(new), dtype=np.int32), np.diff(np.r_[new, len(ids)]))
            ids, n0, n1 = ids[new], np.add.reduceat(n0, new), np.add.reduceat(n1, new)
            kt = _ln_kt(n0, n1)
            if d == depth:
                pw, stop, go = kt, np.ones(len(kt)), np.zeros(len(kt))
            else:
                below = np.add.reduceat(children, new)
                both = np.logaddexp(kt, below)
                pw, stop, go = both - LN2, np.exp(kt - both), np.exp(below - both)
            children = pw
            self.levels.append((group, (n1 + 0.5) / (n0 + n1 + 1.0), stop, go))
        self.v = (1 << i) | (ids >> (8 * start))
        self.n0, self.n1, self.pw = n0, n1, pw

    def bits(self, one: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Cost of each string's decision, given what the levels above the first one mix to."""
        for group, kt_one, stop, go in reversed(self.levels):
            one, rest = one + rest * stop * kt_one, rest * go
            one, rest = one[group], rest[group]
        out = np.empty(len(one))
        out[self.order] = one
        return -np.log2(np.where(self.bit == 1, out, 1.0 - out))


def _suffix(d: int) -> Column:
    """The last ``d`` bytes of a string's context."""
    return F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << 8 * d) - 1))


def with_units(strings: DataFrame, depth: int, limit: int) -> tuple[DataFrame, int]:
    """Add ``unit``: the shortest end of the string's context behind which at most ``limit``
    strings stand, as that end and its length in the low three bits. Longer ends are told
    from a table of the contexts over the limit, of which a depth has at most
    strings / limit. Also the longest unit's length."""
    unit, inside = F.lit(None).cast("long"), strings
    for d in range(depth + 1):
        over = [] if d == depth else [r["end"] for r in inside.groupBy(_suffix(d).alias("end")).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > limit).collect()]
        here = _suffix(d) * 8 + d
        if not over:
            return strings.withColumn("unit", F.coalesce(unit, here)), d
        large = F.broadcast(strings.sparkSession.createDataFrame([(e, True) for e in over], f"end{d} long, over{d} boolean"))
        strings = strings.join(large, _suffix(d) == F.col(f"end{d}"), "left").drop(f"end{d}")
        unit = F.coalesce(unit, F.when(F.col(f"over{d}").isNull(), here))
        inside = strings.filter(F.col(f"over{d}"))
    raise AssertionError("a full context has at most 256 strings")


def price_strings(strings: DataFrame, depth: int = DEPTH, limit: int | None = None) -> DataFrame:
    """key, n_all, bits: what a string's last byte costs behind the others.

    Below the units' contexts the trees are built and priced in tasks, one unit at a time;
    the few levels above them are grouped sums on the way up and joins on the way down."""
    units, top = with_units(strings, depth, UNIT if limit is None else limit)
    units = written(units.select("unit", "key", "n", "n_all"), "ctw-units")

    def trees(keys, n, unit):
        return (_Subtree(keys, n, i, unit & 7, depth) for i in range(8))

    def up(table):
        unit = table["unit"][0].as_py()
        parts = [(t.v, t.n0, t.n1, t.pw) for t in trees(table["key"].to_numpy(), table["n"].to_numpy(), unit)]
        v, n0, n1, pw = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.table({"unit": np.full(len(v), unit), "node": (unit >> 3 << 8) | v, "n0": n0, "n1": n1, "pw": pw})

    def down(table, above):
        unit, keys = table["unit"][0].as_py(), table["key"].to_numpy()
        one, rest = np.zeros(256), np.ones(256)
        v = above["node"].to_numpy() & 255
        one[v], rest[v] = above["one"].to_numpy(), above["rest"].to_numpy()
        bits = sum(t.bits(one[t.v], rest[t.v]) for t in trees(keys, table["n"].to_numpy(), unit))
        return pa.table({"key": keys, "n_all": table["n_all"], "bits": bits})

    roots = written(units.groupBy("unit").applyInArrow(up, "unit long, node long, n0 long, n1 long, pw double"), "ctw-roots")
    low = lambda d: F.col("node").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1))
    at = lambda d: roots.filter(F.col("unit").bitwiseAND(F.lit(7)) == d)
    levels = {}
    for d in range(top - 1, -1, -1):
        below = at(d + 1).select("node", "n0", "n1", "pw")
        below = below.unionByName(levels[d + 1].select("node", "n0", "n1", "pw")) if d + 1 in levels else below
        sums = below.groupBy(low(d).alias("node")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("children"))
        kt = sums.withColumn("kt", _ln_kt(F.col("n0"), F.col("n1")))
        most = F.greatest("kt", "children")
        both = kt.withColumn("both", most + F.log(F.exp(F.col("kt") - most) + F.exp(F.col("children") - most)))
        levels[d] = written(both.select("node", "n0", "n1", (F.col("both") - LN2).alias("pw"), F.exp(F.col("kt") - F.col("both")).alias("stop"),
                                        F.exp(F.col("children") - F.col("both")).alias("go")), f"ctw-level-{d}")
    kt_one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    above = at(0).select("unit", "node", F.lit(0.0).alias("one"), F.lit(1.0).alias("rest"))
    state = None
    for d in range(top):
        here = levels[d]
        here = here.withColumns({"one_up": F.lit(0.0), "rest_up": F.lit(1.0)}) if d == 0 else here.withColumn("up", low(d - 1)).join(state, "up")
        state = written(here.select(F.col("node").alias("up"), (F.col("one_up") + F.col("rest_up") * F.col("stop") * kt_one).alias("one_up"),
                                    (F.col("rest_up") * F.col("go")).alias("rest_up")), f"ctw-state-{d}")
        above = above.unionByName(at(d + 1).withColumn("up", low(d)).join(state, "up").select("unit", "node", F.col("one_up").alias("one"), F.col("rest_up").alias("rest")))
    return units.groupBy("unit").cogroup(above.groupBy("unit")).applyInArrow(down, "key long, n_all long, bits double")


def _frequent(table: DataFrame, size: Column, room: int) -> DataFrame:
    """The rows of the highest counts, in whole classes of an eighth of a power of two, that
    together take at most ``room`` bytes."""
    rank = F.floor(8 * F.log2("n_all"))
    sizes = table.groupBy(rank.alias("rank")).agg(F.sum(size).alias("bytes")).collect()
    least = 512
    for r in sorted(sizes, key=lambda r: -r["rank"]):
        room -= r["bytes"]
        if room < 0:
            break
        least = r["rank"]
    return table.filter(rank >= least)


class _Prices:
    """Look-up of strings' prices: open addressing over two arrays, twice as many places as keys at least."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray):
        self.size = max(1, int(2 * len(keys))).bit_length()
        self.keys, self.bits = np.full(1 << self.size, -1, np.int64), np.zeros(1 << self.size)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == -1
            self.keys[at[left[free]]] = keys[left[free]]
            done = free & (self.keys[at[left]] == keys[left])
            self.bits[at[left[done]]] = bits[left[done]]
            left = left[~done]
            at[left] = (at[left] + 1) & ((1 << self.size) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.size)).astype(np.int64)

    def __call__(self, keys: np.ndarray, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
        """(bits, or 0 where the key is missing; whether it is missing), a step at a time."""
        bits, missing = np.empty(len(keys)), np.empty(len(keys), bool)
        for k in range(0, len(keys), step):
            some = keys[k:k + step]
            at = self._place(some)
            there = self.keys[at]
            left = np.flatnonzero((there != some) & (there != -1))
            while len(left):
                at[left] = (at[left] + 1) & ((1 << self.size) - 1)
                there[left] = self.keys[at[left]]
                left = left[(there[left] != some[left]) & (there[left] != -1)]
            bits[k:k + step], missing[k:k + step] = self.bits[at], there == -1
        return bits, missing


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and
    bits_per_byte of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    strings, words = count(docs, depth)
    n_train = docs.filter(training(F.col("doc_id"))).count()
    known = words.filter("n > 0").agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    total, distinct = known["n"] + n_train, known["v"] + (n_train > 0)
    over = float(total + distinct + 1)
    prices = written(price_strings(strings, depth), "ctw-prices")

    hot = _frequent(prices, F.lit(16), HOT_STRINGS).select("key", "bits").toArrow()
    hot_strings = (hot.column("key").to_numpy(), hot.column("bits").to_numpy())
    frequent = _frequent(words.filter(F.octet_length("word") <= HOT_WORD), F.octet_length("word") + 16, HOT_WORDS).select("word", "n").toArrow()
    hot_words = (frequent.column("word").combine_chunks().cast(pa.large_string()), frequent.column("n").to_numpy())
    shared = spark.sparkContext.broadcast((hot_strings, hot_words))
    end_log = float(np.log10((n_train + 1) / over))

    def price(batches):
        hot_strings, (vocabulary, counts) = shared.value
        prices_of = _Prices(*hot_strings)
        row = TaskContext.get().partitionId() << 40
        for doc_id, text, train in text_runs(batches, ("doc_id", "text", "train"), PRICED):
            normal, n = _normal(text), len(text)
            # strings
            found, begins = _strings(normal, depth)
            bits, cold = prices_of(found)
            total_bits = np.add.reduceat(bits, begins)
            n_bytes = np.diff(np.r_[begins, len(found)])
            owner = np.searchsorted(begins, np.flatnonzero(cold), side="right") - 1
            # words
            word, of = _words(normal)
            n_words = np.bincount(of, minlength=n)
            place = pc.index_in(word, value_set=vocabulary)
            missing = place.is_null().to_numpy(zero_copy_only=False)
            seen = np.r_[counts, 0][pc.fill_null(place, len(counts)).to_numpy(zero_copy_only=False)]
            base = np.bincount(of, weights=np.where(missing, 0.0, np.log10((seen + 1.0) / over)), minlength=n)
            n_known = np.bincount(of, weights=(seen > 0), minlength=n).astype(np.int64)
            ids = row + np.arange(n)
            row += n
            nothing = lambda kind, m: pa.nulls(m, kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids), doc_id, pa.array(~train.to_numpy(zero_copy_only=False).astype(bool)), pa.array(n_words + 1), pa.array(n_known), pa.array(base), pa.array(total_bits),
                pa.array(n_bytes), nothing(pa.int64(), n), nothing(pa.string(), n), nothing(pa.int64(), n)], names=names)
            if cold.any():
                key, times = np.unique(np.stack([owner, found[cold]], 1), axis=0, return_counts=True)
                yield _cold(ids[key[:, 0]], pa.array(key[:, 1]), nothing(pa.string(), len(key)), times)
            if missing.any():
                rare = pa.table({"o": pa.array(of[missing]), "w": word.filter(pa.array(missing))}).group_by(["o", "w"]).aggregate([([], "count_all")])
                yield from (_cold(ids[b.column("o").to_numpy()], nothing(pa.int64(), len(b)), b.column("w").cast(pa.string()), b.column("count_all").to_numpy())
                            for b in rare.to_batches())

    def _cold(ids, key, word, times):
        m = len(ids)
        empty = [pa.nulls(m, f.type) for f in schema]
        return pa.RecordBatch.from_arrays([pa.array(ids), *empty[1:8], key, word, pa.array(times)], schema=schema)

    rows = docs.withColumn("train", training(F.col("doc_id")))
    layout = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")], *[T.StructField(c, T.DoubleType()) for c in ("base_score", "bits")],
        T.StructField("n_bytes", T.LongType()), T.StructField("key", T.LongType()), T.StructField("word", T.StringType()), T.StructField("times", T.LongType())])
    schema = to_arrow_schema(layout)
    names = layout.names
    priced = written(rows.mapInArrow(price, layout), "ctw-priced")

    rest = priced.filter("times IS NOT NULL")
    zero = F.lit(0.0)
    by_string = rest.filter("key IS NOT NULL").join(prices.select("key", F.col("bits").alias("cost")), "key").select(
        "row", F.lit(0).cast("long").alias("known"), zero.alias("base"), (F.col("times") * F.col("cost")).alias("more"))
    by_word = rest.filter("word IS NOT NULL").join(words.select("word", "n"), "word").select(
        "row", F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"), (F.col("times") * F.log10((F.col("n") + 1) / F.lit(over))).alias("base"), zero.alias("more"))
    more = by_string.unionByName(by_word).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("known", "base", "more")])
    out = priced.filter("times IS NULL").drop("key", "word", "times").join(more, "row", "left")
    bits = F.col("bits") + F.coalesce("more", zero)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0)) + int(n_train > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("base", zero) + end_log).alias("base_score"),
        (-bits * F.lit(LN2 / LN10)).alias("score"), "n_bytes", (bits / F.col("n_bytes")).alias("bits_per_byte"))

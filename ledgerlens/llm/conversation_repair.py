"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed when the initials of its roles, in order, match
``(s?(ua)+)?``: an optional system row, then user and assistant rows in turn.
Its repair is the cheapest list of edits that makes it so, of equally cheap
lists the least in ASCII order of the edits' initials:

    D  delete a row                               3   (required for blank and duplicate rows)
    I  insert a user or assistant row, no text    2
    K  keep a row                                 0
    R  give a row the role user or assistant      2   (the one the place asks for)

and 1 for each row that looks cut off and stays. The initials alone fix the
repair, as every place asks for one role.

``cheapest_edits`` searches depth first, edits in the order D, I, K, R, up to a
bound on cost that rises from an admissible estimate of the whole to the least
cost that the last pass had to cut; the first accepting path is the answer. The
estimate of the rest of a transcript counts what no edit list avoids: 3 for each
row that must go, 1 for each cut-off row, and 2 for every two neighbouring
conflicts (an edit touches two at most, and those share a row). Failed states
(place, what the last role was) are kept in a table with the least cost that
could succeed there, over all passes, so a pass visits each state once.

On Spark: one pass marks the rows (a window over the conversation, whose rows
stream through one task's spillable sort, reduced to one character each before
the search) and one pass streams the texts through the edits. Neither holds a
conversation's texts; the search holds a few integers per row. Equal transcripts
of a task are searched once.

Defined cases: null role or text = one space; null conv_id = a conversation of
its own; null turns first, then by turn, role, text; an empty table = an empty
result; further columns are ignored. A role counts by its first character, an
empty role like a foreign one. A conversation whose rows all went (``dropped``)
is reported with zeros and no edits."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLANK = r"\A[\x20\x09-\x0D]*\z"
#: The last character that is no white space ends a sentence.
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

# What the last role was: nothing yet, system, user, assistant. The next one must be:
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = "uuau"
_AFTER = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}

# A row as one character: initial s, u, a or o (other) as it is, upper case when cut
# off, and x when it must be deleted.
_FAULTS = ("blank", "duplicate", "truncated")


def _legal(last: int, initial: str) -> bool:
    return initial == _NEXT[last] or (last == _START and initial == "s")


class _Estimate:
    """Least cost from (place, last role) on: see the module's text."""

    def __init__(self, rows: str):
        n = len(rows)
        self.fixed, self.run, self.later, self.first = array("q", [0]) * (n + 1), array("q", [0]) * (n + 1), array("q", [0]) * (n + 1), bytearray(n + 1)
        follows = ""                     # initial of the next row that may stay
        for i in range(n - 1, -1, -1):
            c = rows[i]
            self.fixed[i], self.run[i], self.later[i], self.first[i] = self.fixed[i + 1], self.run[i + 1], self.later[i + 1], self.first[i + 1]
            if c == "x":
                self.fixed[i] += 3
                continue
            self.fixed[i] += c.isupper()
            c = c.lower()
            if (c != "a") if not follows else (c not in _AFTER or not _legal(_AFTER[c], follows)):
                self.run[i] += 1         # conflict between this row and the next, or the end
            else:
                self.later[i] += (self.run[i] + 1) // 2
                self.run[i] = 0
            self.first[i], follows = ord(c), c

    def __call__(self, place: int, last: int) -> int:
        first = self.first[place]
        if not first:
            return self.fixed[place] + (0 if last in (_START, _ASSISTANT) else 2)
        run = self.run[place]
        if _legal(last, chr(first)):
            return self.fixed[place] + 2 * ((run + 1) // 2 + self.later[place])
        return self.fixed[place] + 2 * ((run + 2) // 2 + self.later[place])


def _moves(c: str, last: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows used, last role after it), in ASCII order; ``c`` is empty at the end."""
    asked = _AFTER[_NEXT[last]]
    insert = ("I", 2, 0, asked)
    if not c:
        return [insert]
    if c == "x":
        return [("D", 3, 1, last), insert]
    stays, role = int(c.isupper()), c.lower()
    keep = [("K", stays, 1, _AFTER[role])] if _legal(last, role) else []
    return [("D", 3, 1, last), insert, *keep, ("R", 2 + stays, 1, asked)]


_MOVES = {(c, last): tuple(_moves(c, last)) for c in ("", *"suaoSUAOx") for last in range(4)}


@lru_cache(maxsize=1 << 16)
def _searched(rows: str) -> tuple[int, str]:
    n, estimate = len(rows), _Estimate(rows)
    least = array("q", [-1]) * (4 * n + 4)    # the table: least cost that may succeed from a state
    best = estimate(0, _START)
    while True:
        bound, edits = best, []
        # a frame: place, last role, budget, its moves, the next of them, least cost that may succeed
        frames = [[0, _START, bound, _MOVES[rows[:1], _START], 0, 1 << 62]]
        while frames:
            frame = frames[-1]
            place, last, budget, moves, at, low = frame
            if place == n and last in (_START, _ASSISTANT):
                return bound, "".join(edits)
            if at == len(moves):
                state = 4 * place + last
                if low > least[state]:
                    least[state] = low
                frames.pop()
                if frames:
                    edits.pop()
                    above = frames[-1]
                    above[5] = min(above[5], low + above[3][above[4] - 1][1])
                continue
            initial, cost, used, then = moves[at]
            frame[4] += 1
            to = 4 * (place + used) + then
            need = least[to]
            if need < 0:
                need = least[to] = estimate(place + used, then)
            if cost + need > budget:
                if cost + need < low:
                    frame[5] = cost + need
                continue
            edits.append(initial)
            frames.append([place + used, then, budget - cost, _MOVES[rows[place + used:place + used + 1], then], 0, 1 << 62])
        best = least[_START]


def cheapest_edits(rows: str) -> tuple[int, str]:
    """(cost, initials of the edits) for a transcript of one character a row. Only
    transcripts of usual length are remembered."""
    return _searched(rows) if len(rows) <= 256 else _searched.__wrapped__(rows)


def damage(turns: DataFrame) -> DataFrame:
    """The rows with the faults that crc32(conv_id:turn) mod 20 deals out: 0 drops the row
    (kept here with ``dropped``, so its conversation is not forgotten), 1 empties its text,
    2 takes ``[.!?]`` out of it, 3 repeats the row, 4 makes its role user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("kind") == 0).alias("dropped"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _plain(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped with nulls filled."""
    dropped = F.coalesce("dropped", F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), dropped.alias("dropped"))


def _marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, place, mark: a row's initial (upper case when cut off) or its fault
    blank (b), duplicate (d); ``-`` for a dropped row. Rows of a conversation lie in order
    in one partition."""
    order = [F.col("dropped"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("dropped", F.col("turn").asc_nulls_first())) > 1
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    mark = (F.when(F.col("dropped"), "-").when(F.col("text").rlike(BLANK), F.concat(F.lit("b"), initial))
            .when(F.col("seen"), F.concat(F.lit("d"), initial)).when(F.col("text").rlike(ENDED), initial).otherwise(F.upper(initial)))
    return (rows.repartition("conv_id").withColumn("seen", seen).select("conv_id", "turn", place.alias("place"), mark.alias("mark"))
            .sortWithinPartitions("conv_id", "place"))


def _runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[bool, tuple]]:
    """The rows of sorted batches; True where a new conversation begins."""
    before = object()
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            yield row[0] != before, row
            before = row[0]


def _packed(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or chars > 16_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _audited(conv_id, turns: list, marks: list) -> tuple:
    """One conversation: its structure counts and its edits."""
    marks = [m for m in marks if m != "-"]
    initials = "".join(m[-1].lower() for m in marks)
    faults = [sum(len(m) == 2 and m[0] == f for m in marks) for f in "bd"] + [sum(m.isupper() for m in marks)]
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, edits = cheapest_edits("".join("x" if len(m) == 2 else m for m in marks))
    return conv_id, gaps, *faults, illegal, cost, edits


def _arrow(fields: list[T.StructField]) -> pa.Schema:
    return to_arrow_schema(T.StructType(fields))


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost
    (longs) and audit, the initials of the cheapest edits."""
    rows = _plain(turns)
    fields = [T.StructField("conv_id", rows.schema["conv_id"].dataType),
              *[T.StructField(c, T.LongType()) for c in ("gaps", *_FAULTS, "illegal", "cost")], T.StructField("audit", T.StringType())]
    schema = _arrow(fields)

    def search(batches):
        def each():
            conv, turns_of, marks = None, [], []
            for new, (conv_id, turn, mark) in _runs(batches, ("conv_id", "turn", "mark")):
                if new:
                    if marks:
                        yield _audited(conv, turns_of, marks)
                    conv, turns_of, marks = conv_id, [], []
                marks.append(mark)
                if mark != "-":
                    turns_of.append(turn)
            if marks:
                yield _audited(conv, turns_of, marks)
        return _packed(each(), schema)

    return _marked(rows).mapInArrow(search, T.StructType(fields))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, edit, role, text) of the repaired conversations, in order, from rows
    that follow the header row of their conversation, its audit as JSON. The header comes
    first, as place -1 with the JSON in place of a text."""
    edits, at, last, place, conv = "", 0, _START, 0, None

    def inserted():
        nonlocal at, last, place
        while edits[at:at + 1] == "I":
            last = _AFTER[_NEXT[last]]
            yield conv, place, "I", "user" if last == _USER else "assistant", ""
            at, place = at + 1, place + 1

    for new, (conv_id, header, role, text) in _runs(batches, ("conv_id", "header", "role", "text")):
        if new:
            yield from inserted()
            edits, at, last, place, conv = json.loads(header)["audit"], 0, _START, 0, conv_id
            yield conv, -1, "", "", header
            continue
        yield from inserted()
        edit, at = edits[at], at + 1
        if edit == "D":
            continue
        if edit == "R":
            role = "user" if _NEXT[last] == "u" else "assistant"
        last = _AFTER[role[0]]
        yield conv, place, edit, role, text
        place += 1
    yield from inserted()


def _with_headers(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of each conversation in order behind one row that holds its audit."""
    rows = _plain(turns).filter(~F.col("dropped")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("header"))
    told = F.to_json(F.struct(*[c for c in audits.columns if c != "conv_id"]))
    heads = audits.select("conv_id", F.lit(0), F.lit(None).cast("long"), F.lit(""), F.lit(""), told)
    return rows.union(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "text")


def repair(turns: DataFrame, audits: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (I, K or R), role, text."""
    ordered = _with_headers(turns, audit(turns) if audits is None else audits)
    fields = [T.StructField("conv_id", ordered.schema["conv_id"].dataType), T.StructField("place", T.LongType()),
              *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]]
    schema = _arrow(fields)
    return ordered.mapInArrow(lambda batches: _packed((r for r in _repaired(batches) if r[1] >= 0), schema), T.StructType(fields))


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The columns of ``audits`` and repaired_sha256: of the repaired rows as ``role:text``,
    joined by line feeds. The texts stream through the hash."""
    ordered = _with_headers(turns, audits)
    fields = [T.StructField("conv_id", ordered.schema["conv_id"].dataType), T.StructField("told", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    schema = _arrow(fields)
    told = T.StructType([audits.schema[c] for c in audits.columns if c != "conv_id"])

    def digests(rows):
        head = digest = None
        for conv_id, place, _, role, text in rows:
            if place < 0:
                if head:
                    yield *head, digest.hexdigest()
                head, digest = (conv_id, text), hashlib.sha256()
            else:
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if head:
            yield *head, digest.hexdigest()

    hashed = ordered.mapInArrow(lambda batches: _packed(digests(_repaired(batches)), schema), T.StructType(fields))
    return hashed.select("conv_id", F.from_json("told", told).alias("told"), "repaired_sha256").select("conv_id", "told.*", "repaired_sha256")

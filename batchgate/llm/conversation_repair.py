"""Conversation structure repair by a Viterbi search with survivor coalescence.

Rows of a conversation are edited at least cost until the role initials read
``(s?(ua)+)?``: keep (0), give a row the role user / assistant (2), delete (3),
insert an empty user / assistant row (2); an undeleted row whose text is cut off
adds 1. Blank and repeated rows must be deleted. Ties go to the ASCII-least string of
edit initials D, I, K, R. Both roles that R and I can give follow from the state
(nothing yet, after s, after u, after a), so a string of edits is one path.

Decoder: one survivor for each state, held in a tree of back pointers with
reference counts. A survivor that no path continues is released up to its first
ancestor still in use; as soon as all survivors share an ancestor, the edits
above it are final, are given out and leave memory. A survivor that costs more than
another by more than any ending can win back (:data:`LEAD`) is given up, so deleting everything
from the start on does not keep the first edits open. Survivors of equal cost are
compared by their whole unresolved strings; as two strings differ before either
ends, the order found for them holds for all that follows, so a step carries it on instead
of reading the strings again. Edits that stay open (a long run of one role) stay in
memory, at most those of a segment. Inserts are
tried before rows that stay and at the end: before a deleted row they cost the
same and sort after the same inserts behind it.

Spark: equal rows are counted first (a row repeated a million times is one row with
a count), all rows are dealt in order over range partitions of about the same
size, and (conversation, partition) is a segment. A conversation that lies in one
segment is decoded in one pass. Segments of cut conversations, at most two for a partition
border, are first reduced to 4 x 4 costs with the order of their edit strings;
these compose like matrices (edit strings of one start state to different end
states differ, and never by a mere prefix, so their order decides every tie), which
gives each segment's first and last state. Decoding then runs for all segments
alike, so a conversation that holds a third of all rows is spread over tasks.

Defined results
  * NULL roles and texts count as one space. NULL conversation ids are one
    conversation; NULL turns come first.
  * Rows of one turn are ordered by role, then the text's first 32 characters,
    then a digest of the row.
  * The first fault of a row counts: blank (no character but white space),
    duplicate (role and text seen earlier in the conversation), truncated (last
    such character is none of ``.!?``).
  * A conversation without rows is not listed; empty tables give empty results;
    other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.llm.common import SPACES, partitions, shipped, squeezed, written

DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1         # costs
SEGMENT_ROWS = 100_000
START, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
WANTED = ("u", "u", "a", "u")                         # what a state takes next
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
TAIL = ("", "II", "I", "")                            # cheapest inserts that end a conversation in each state
ROLE = {"u": "user", "a": "assistant"}
#: LEAD[y][x]: what any ending costs from state y at most more than from x. From after a, for example, an ending of
#: the start state costs 3 more at most (the system row that it keeps is deleted instead).
LEAD = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))
ALLOWED = ("su", "ua", "au")
_PREFIX = 32


# ------------------------------------------------------------------- decoder

def _moves(state: int, initial: str) -> list[tuple[int, int, int, str]]:
    """(next state, cost, times cut-off counts, edits) of one row that may stay."""
    out = [(state, DELETE, 0, "D")]
    at, inserts, seen = state, "", set()
    while at not in seen:
        seen.add(at)
        cost = INSERT * len(inserts)
        if at == START and initial == "s":
            out.append((AFTER_S, cost, 1, inserts + "K"))
        out.append((NEXT[at], cost, 1, inserts + "K") if initial == WANTED[at] else (NEXT[at], cost + REROLE, 1, inserts + "R"))
        at, inserts = NEXT[at], inserts + "I"
    return out


_MOVES = {(s, i): _moves(s, i) for s in STATES for i in ("s", "u", "a", "")}


class _Node:
    """The edits of one step, and how many survivors and later steps hold on to them."""
    __slots__ = ("up", "edits", "row", "refs")

    def __init__(self, up: "_Node | None", edits: str, row) -> None:
        self.up, self.edits, self.row, self.refs = up, edits, row, 1
        if up is not None:
            up.refs += 1

    def release(self) -> None:
        node = self
        node.refs -= 1
        while node.refs == 0 and node.up is not None:
            node.up, node = None, node.up
            node.refs -= 1


class Decoder:
    """Cheapest edits from one start state to every state; ``step`` and ``block`` return final ones."""

    def __init__(self, start: int = START) -> None:
        self.root = _Node(None, "", None)
        self.root.refs += 1                            # the root's own mark, so that it is never released
        self.live: dict[int, tuple[int, int, _Node]] = {start: (0, 0, self.root)}      # cost, place of the edits so far, node
        self.held, self.check_at = 0, 32               # steps since the root; when to look for coalescence next

    def step(self, initial: str, cut_off: bool, row=None) -> list[tuple[str, object]]:
        """One row that may stay."""
        best: dict[int, tuple[int, int, str, _Node]] = {}
        kind = initial if initial in ("s", "u", "a") else ""
        for state, (cost, place, node) in self.live.items():
            for to, more, counts, edits in _MOVES[state, kind]:
                # Edits of two survivors differ before either ends, so (place, new edits) orders the whole strings.
                way = (cost + more + (CUT_OFF if cut_off and counts else 0), place, edits, node)
                if to not in best or way[:3] < best[to][:3]:
                    best[to] = way
        return self._advance(best, row)

    def block(self, times: int, row=None) -> list[tuple[str, object]]:
        """``times`` equal rows that must go."""
        return self._advance({s: (cost + DELETE * times, place, "D" * times, node) for s, (cost, place, node) in self.live.items()}, row)

    def _advance(self, best: dict[int, tuple[int, int, str, _Node]], row) -> list[tuple[str, object]]:
        best = {x: way for x, way in best.items() if all(w[0] + LEAD[y][x] >= way[0] for y, w in best.items())}
        order = sorted(best, key=lambda x: best[x][1:3])
        new = {x: (best[x][0], place, _Node(best[x][3], best[x][2], row)) for place, x in enumerate(order)}
        for _, _, node in self.live.values():
            node.release()
        self.live = new
        self.held += 1
        if self.held < self.check_at:
            return []
        chain, node = [], next(iter(new.values()))[2]
        while node is not self.root:
            chain.append(node)
            node = node.up
        out = []
        while chain and self.root.refs == 2:           # its own mark and one step: all survivors pass there
            node = chain.pop()
            out.append((node.edits, node.row))
            node.refs += 1
            self.root, node.up = node, None
        self.held = len(chain)
        self.check_at = 2 * self.held + 32
        return out

    def unresolved(self, state: int) -> list[tuple[str, object]]:
        """The steps of a survivor since the last final one."""
        out, node = [], self.live[state][2]
        while node is not self.root:
            out.append((node.edits, node.row))
            node = node.up
        return out[::-1]

    def order(self) -> list[int]:
        """The states reached, by the whole unresolved strings of their survivors."""
        return sorted(self.live, key=lambda s: "".join(edits for edits, _ in self.unresolved(s)))

    def finish(self, end: int | None = None, last: bool = True) -> tuple[int, list[tuple[str, object]]]:
        """Cost and remaining edits of the best path (to state ``end`` if given; closed by inserts if ``last``)."""
        place = {s: k for k, s in enumerate(self.order())}
        tail = TAIL if last else ("",) * 4
        state = end if end is not None else min(self.live, key=lambda s: (self.live[s][0] + INSERT * len(tail[s]), place[s]))
        return self.live[state][0] + INSERT * len(tail[state]), self.unresolved(state) + ([(tail[state], None)] if tail[state] else [])


def summary(decoders: list[Decoder]) -> tuple[list[int | None], list[int | None]]:
    """Costs (start x end) of a segment, and the place of each end among the edit strings of its start."""
    cost: list[int | None] = [None] * 16
    place: list[int | None] = [None] * 16
    for start, d in enumerate(decoders):
        for k, end in enumerate(d.order()):
            cost[4 * start + end], place[4 * start + end] = d.live[end][0], k
    return cost, place


def compose(segments: list[tuple[list, list]]) -> list[tuple[int, int]]:
    """First and last state of every segment on the best path, from the segments' summaries in order."""
    best, place, back = {START: 0}, {START: 0}, []
    for cost, order in segments:
        reached: dict[int, tuple[int, int, int, int]] = {}       # end: (cost, place of the way before, place within, from)
        for a, before in best.items():
            for b in STATES:
                if cost[4 * a + b] is not None:
                    way = (before + int(cost[4 * a + b]), place[a], int(order[4 * a + b]), a)
                    if b not in reached or way[:2] < reached[b][:2]:
                        reached[b] = way
        rank = sorted(reached, key=lambda b: reached[b][1:3])
        back.append({b: way[3] for b, way in reached.items()})
        best, place = {b: way[0] for b, way in reached.items()}, {b: k for k, b in enumerate(rank)}
    at = min(best, key=lambda b: (best[b] + INSERT * len(TAIL[b]), place[b]))
    ends = []
    for links in reversed(back):
        ends.append((links[at], at))
        at = links[at]
    return ends[::-1]


# ------------------------------------------------------------------ operator

class Repaired(NamedTuple):
    """``report``: one row per conversation (conv, gaps, blank, duplicate, truncated, illegal, cost, audit);
    ``lines``: the repaired rows (conv, seg, pos, edit, role, text), in order of seg and pos."""
    report: DataFrame
    lines: DataFrame


def _sized(c: Column) -> Column:
    """Text that no other value can imitate when such texts are joined."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("~"))


def _named(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    out = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                      F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    content = F.concat(_sized(F.col("role")), F.col("text"))
    return out.withColumns({"content": F.unhex(F.sha2(content, 256)),
                            "rid": F.unhex(F.sha2(F.concat(_sized(F.col("conv")), _sized(F.col("turn")), content), 256))})


def _segments(base: DataFrame) -> DataFrame:
    """Distinct rows without their texts: order columns, faults, count, and the segment they are dealt to."""
    spark = base.sparkSession
    keys = ["conv", "turn", "role", "prefix", "content", "rid", "blank", "cut_off"]
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    rows = base.select("conv", "turn", "role", F.substring("text", 1, _PREFIX).alias("prefix"), "content", "rid",
                       (squeezed(F.col("text")) == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut_off"))
    rows = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "repair_rows")
    # The earliest row of each role and text; joined by the row's own digest, so no key is hot.
    first = (rows.groupBy("conv", "content").agg(F.min(F.struct(F.col("turn").isNotNull().alias("t"), "turn", "rid")).alias("m"))
                 .select(F.col("m.rid").alias("rid"), F.lit(True).alias("first")))
    rows = rows.join(first, "rid", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    rows = written(rows.drop("content"), "repair_flagged")
    parts = max(partitions(spark), -(-rows.count() // SEGMENT_ROWS))
    return written(rows.repartitionByRange(parts, "conv", "turn", "role", "prefix", "rid")
                       .withColumn("seg", F.spark_partition_id()), "repair_segments")


_ORDER = ["conv", "seg", "turn", "role", "prefix", "rid"]
_COLUMNS = ["conv", "seg", "turn", "role", "rid", "blank", "cut_off", "n", "first"]


def _in_order(segments: DataFrame, *more: str) -> DataFrame:
    """Whole segments to tasks, in the order of their rows."""
    return segments.repartition("conv", "seg").sortWithinPartitions(*_ORDER).select(*_COLUMNS, *more)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """(is the first of its segment, row) of every row."""
    key = None
    for batch in batches:
        for row in batch.to_pylist():
            new = key is None or key != (row["conv"], row["seg"])
            key = (row["conv"], row["seg"])
            yield new, row


def _feed(decoder: Decoder, row: dict) -> Iterator[tuple[str, object]]:
    """One distinct row with its count."""
    stays = row["first"] and not row["blank"]
    if stays:
        yield from decoder.step(row["role"][:1], row["cut_off"], row)
    if row["n"] > stays:
        yield from decoder.block(row["n"] - stays, row)


def _states(segments: DataFrame, conv_type: T.DataType) -> DataFrame | None:
    """conv, seg, first and last state of the segments of cut conversations (at most two a partition border)."""
    span = segments.groupBy("conv").agg(F.min("seg").alias("a"), F.max("seg").alias("b"))
    cut = written(span.where("a < b").select(F.col("conv").alias("cut_conv")), "repair_cut")
    if cut.isEmpty():
        return None
    # Fewer cut conversations than partitions: broadcast.
    rows = segments.join(F.broadcast(cut), F.col("conv").eqNullSafe(F.col("cut_conv")), "left_semi")
    schema = T.StructType([T.StructField("conv", conv_type), T.StructField("seg", T.IntegerType()),
                           T.StructField("cost", T.ArrayType(T.LongType())), T.StructField("place", T.ArrayType(T.LongType()))])

    def reduce_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list = []
        decoders: list[Decoder] = []
        held = None

        def record() -> pa.RecordBatch:
            cost, place = summary(decoders)
            columns = [([held[0]], types[0]), ([held[1]], pa.int32()), ([cost], pa.list_(pa.int64())), ([place], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=schema.names)

        for new, row in _groups(_noting(batches, types)):
            if new:
                if held is not None:
                    yield record()
                held, decoders = (row["conv"], row["seg"]), [Decoder(s) for s in STATES]
            for d in decoders:
                for _ in _feed(d, row):
                    pass
        if held is not None:
            yield record()

    reduced = written(_in_order(rows).mapInArrow(reduce_segments, schema), "repair_summaries")
    out = T.StructType([T.StructField("conv", conv_type), T.StructField("seg", T.IntegerType()), T.StructField("start", T.IntegerType()),
                        T.StructField("stop", T.IntegerType()), T.StructField("closes", T.BooleanType())])

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        # At most one row a partition, whatever the conversation holds.
        group = group.sort_values("seg", ignore_index=True)
        full = [([None if pd.isna(v) else int(v) for v in c], [None if pd.isna(v) else int(v) for v in p])
                for c, p in zip(group["cost"], group["place"])]
        ends = compose(full)
        return pd.DataFrame({"conv": group["conv"], "seg": group["seg"], "start": [a for a, _ in ends], "stop": [b for _, b in ends],
                             "closes": group["seg"] == group["seg"].max()})

    return written(reduced.groupBy("conv").applyInPandas(resolve, out), "repair_states")


def _noting(batches: Iterator[pa.RecordBatch], types: list) -> Iterator[pa.RecordBatch]:
    """The batches, the Arrow type of the first column noted on the way."""
    for batch in batches:
        types[:] = [batch.schema.field(0).type]
        yield batch


_EVENT = [("seg", T.IntegerType()), ("pos", T.LongType()), ("rid", T.BinaryType()), ("role", T.StringType()), ("edit", T.StringType()),
          ("cost", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()),
          ("illegal", T.LongType()), ("head", T.StringType()), ("tail", T.StringType()), ("audit", T.StringType())]
_EVENT_PA = [pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.string(), *[pa.int64()] * 5, *[pa.string()] * 3]


def _decode(segments: DataFrame, conv_type: T.DataType) -> DataFrame:
    """Repaired rows (audit NULL) and one report of every segment."""
    schema = T.StructType([T.StructField("conv", conv_type), *[T.StructField(n, t) for n, t in _EVENT]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list = []
        pending: list[tuple] = []

        def out() -> pa.RecordBatch:
            rows, pending[:] = list(pending), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [types[0], *_EVENT_PA])], names=schema.names)

        seg = None
        for new, row in _groups(_noting(batches, types)):
            if new:
                if seg is not None:
                    pending.extend(seg.close())
                seg = _Segment(row)
            pending.extend(seg.add(row))
            if len(pending) >= 4096:
                yield out()
        if seg is not None:
            pending.extend(seg.close())
        if pending:
            yield out()

    return _in_order(segments, "start", "stop", "closes").mapInArrow(run, schema)


class _Segment:
    """One segment's decoder, counters and the state that its final edits have reached."""

    def __init__(self, row: dict) -> None:
        self.conv, self.seg, self.closes, self.stop = row["conv"], row["seg"], row["closes"], row["stop"]
        self.state = row["start"]
        self.decoder = Decoder(self.state)
        self.pos, self.audit = 0, []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.head = self.tail = None

    def add(self, row: dict) -> Iterator[tuple]:
        initial, n = row["role"][:1], row["n"]
        self.illegal += (n - 1) * (initial * 2 not in ALLOWED) + (self.tail is not None and self.tail + initial not in ALLOWED)
        self.head, self.tail = initial if self.head is None else self.head, initial
        if row["blank"]:
            self.blank += n
        else:
            self.duplicate += n - row["first"]
            self.truncated += bool(row["first"] and row["cut_off"])
        for edits, of in _feed(self.decoder, row):
            yield from self._lines(edits, of)

    def close(self) -> Iterator[tuple]:
        cost, rest = self.decoder.finish(self.stop, self.closes)
        for edits, of in rest:
            yield from self._lines(edits, of)
        yield (self.conv, self.seg, None, None, None, None, cost, self.blank, self.duplicate, self.truncated, self.illegal,
               self.head, self.tail, "".join(self.audit))

    def _lines(self, edits: str, row) -> Iterator[tuple]:
        self.audit.append(edits)
        for edit in edits:
            if edit == "D":
                continue
            kept_s = edit == "K" and self.state == START and row["role"][:1] == "s"
            role = row["role"] if edit == "K" else ROLE[WANTED[self.state]]
            self.state = AFTER_S if kept_s else NEXT[self.state]
            yield (self.conv, self.seg, self.pos, None if edit == "I" else row["rid"], role, edit, *[None] * 8)
            self.pos += 1


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> Repaired:
    """Report and repaired rows of all conversations."""
    shipped(rows.sparkSession)
    base = _named(rows, conv_col, turn_col, role_col, text_col)
    conv_type = base.schema["conv"].dataType
    segments = _segments(base)
    states = _states(segments, conv_type)
    if states is None:
        marked = segments.withColumns({"start": F.lit(START), "stop": F.lit(None).cast("int"), "closes": F.lit(True)})
    else:
        # At most two rows a partition border and one a partition between: broadcast.
        s = F.broadcast(states.withColumnsRenamed({"conv": "s_conv", "seg": "s_seg"}))
        marked = (segments.join(s, F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("seg") == F.col("s_seg")), "left")
                          .withColumns({"start": F.coalesce("start", F.lit(START)), "closes": F.coalesce("closes", F.lit(True))}))
    events = written(_decode(marked, conv_type), "repair_events")
    return Repaired(_report(segments, events), _lines(base, events))


def _lines(base: DataFrame, events: DataFrame) -> DataFrame:
    found = events.where("audit IS NULL").select("conv", "seg", "pos", "edit", "role", "rid")
    texts = base.select("rid", "text").dropDuplicates(["rid"])
    kept = found.where("rid IS NOT NULL").join(texts, "rid").select("conv", "seg", "pos", "edit", "role", "text")
    return kept.unionByName(found.where("rid IS NULL").select("conv", "seg", "pos", "edit", "role", F.lit("").alias("text")))


def _report(segments: DataFrame, events: DataFrame) -> DataFrame:
    turns = (segments.groupBy("conv", "turn").agg(F.count(F.lit(1))).groupBy("conv")
                     .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
                     .select(F.col("conv").alias("g_conv"), "gaps"))
    counts = ["cost", "blank", "duplicate", "truncated", "illegal"]
    # At most one row a partition for each conversation.
    folded = (events.where("audit IS NOT NULL").groupBy("conv")
                    .agg(*[F.sum(c).alias(c) for c in counts], F.array_sort(F.collect_list(F.struct("seg", "head", "tail", "audit"))).alias("s")))
    pairs = F.zip_with(F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1),
                       lambda a, b: F.concat(a["tail"], b["head"]))
    borders = F.size(F.filter(pairs, lambda p: ~p.isin(*ALLOWED)))
    folded = folded.withColumns({"illegal": F.col("illegal") + F.when(F.size("s") > 1, borders).otherwise(0),
                                 "audit": F.array_join(F.transform("s", lambda x: x["audit"]), "")})
    out = folded.join(turns, F.col("conv").eqNullSafe(F.col("g_conv")))
    return out.select("conv", "gaps", *[c for c in counts if c != "cost"], "cost", "audit")


def line_digests(lines: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its ``role:text`` lines, newline-joined. A digest of a whole conversation needs
    its lines in order: they stream through one task, which holds one batch at a time."""
    rows = lines.select("conv", "seg", "pos", F.concat_ws(":", "role", "text").cast("binary").alias("line"))
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), T.StructField("sha", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        conv, digest, types = None, None, []
        done: list[tuple] = []
        for batch in _noting(batches, types):
            for c, line in zip(batch.column(0), batch.column(1)):
                if digest is None or c.as_py() != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = c.as_py(), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.as_py())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], types[0]), pa.array([x for _, x in done])], names=schema.names)
                done = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], types[0]), pa.array([digest.hexdigest()])], names=schema.names)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "seg", "pos").select("conv", "line")
    return ordered.mapInArrow(run, schema)

"""Repair of the structure of conversations at least cost, by a bidirectional search over the edit lattice.

A conversation is read by turn (nulls first; of one turn by role and then by a digest of the text). A row's first fault
counts: blank text, a repeat of a role and text seen earlier in it, a text that does not end in `.`, `!` or `?`. Edits turn the
rows into `(s?(ua)+)?` by role initials: Keep costs 0, Rerole to user or assistant 2, Delete 3 (the only edit for blank rows and
repeats), Insert an empty user or assistant text 2; a truncated row that stays adds 1. Of the cheapest edit sequences the
one whose initials are least in ASCII is taken.

A lattice node is (rows read, last role written). Dijkstra runs from both ends; when the heaps meet, all crossings of the best cost
are finished and the least concatenated audit wins. Labels carry their audit: two audits of one node and one cost are never
prefixes of each other (edits beyond a prefix cost something), so the least stays the least when edits are put before or behind it.

Equal rows become one row with a count before they move. Slim rows without texts are range-partitioned by conversation and
turn, so that a conversation that holds much of the table is many tasks' work: stretches of `CHUNK` rows become tables of the
cheapest audit from each state to each state, tables are joined in order, and what is cut by a partition's border is joined last.
Whole texts move once, to be written out in order; they stream through their task, which holds one audit at a time.

Nulls: a null role or text counts as one space, a null conversation id is a conversation, null turns come first and don't count for gaps.
Repeated rows are duplicates. Conversations of no rows don't exist here; an empty table gives an empty result. Other
columns are not carried, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from revlens.llm.common import one_by_one, staged

BLANKS = " \t\n\x0b\f\r"
CHUNK = 256
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
# A row to the search: its initial and the cost of leaving it in, or a run of so many rows that must go.
Row = tuple[str, int] | int
Label = tuple[int, str]


def _steps(row: Row, state: int) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, edit) of the edits that read a row."""
    if isinstance(row, int):
        yield state, 3 * row, "D" * row
        return
    initial, extra = row
    yield state, 3, "D"
    if (state, initial) in KEPT:
        yield KEPT[state, initial], extra, "K"
    if KEPT.get((state, initial)) != NEXT[state]:
        yield NEXT[state], 2 + extra, "R"


def search(rows: tuple[Row, ...], entry: int, exits: tuple[int, ...]) -> Label | None:
    """The cheapest cost and its least audit from a state before the rows to one of the states behind them.

    Equal costs are settled in reading order from the front and against it from the back, because only edits that read a row are free.
    """
    n = len(rows)
    ahead: list[dict[tuple[int, int], tuple[int, str]]] = [{} for _ in rows]  # (state behind, state before) of a row's edits
    for i, row in enumerate(rows):
        for state in range(4):
            for after, cost, edit in _steps(row, state):
                ahead[i][after, state] = min(ahead[i].get((after, state), (cost, edit)), (cost, edit))
    behind = [[[] for _ in range(4)] for _ in rows]
    before = [[[] for _ in range(4)] for _ in rows]
    for i, edges in enumerate(ahead):
        for (after, state), (cost, edit) in edges.items():
            behind[i][state].append((after, cost, edit))
            before[i][after].append((state, cost, edit))

    labels: tuple[dict, dict] = ({(0, entry): (0, "")}, {(n, state): (0, "") for state in exits})
    heaps = ([(0, 0, entry)], [(0, -n, state) for state in exits])
    heapq.heapify(heaps[1])
    settled: tuple[set, set] = (set(), set())
    def offer(side: int, node: tuple[int, int], label: Label) -> None:
        known = labels[side].get(node)
        if known is None or label < known:
            labels[side][node] = label
            if known is None or label[0] < known[0]:
                heapq.heappush(heaps[side], (label[0], node[0] if side == 0 else -node[0], node[1]))

    def top(side: int) -> int | None:
        heap = heaps[side]
        while heap and (abs(heap[0][1]), heap[0][2]) in settled[side]:
            heapq.heappop(heap)
        return heap[0][0] if heap else None

    cheapest = None
    while True:
        tops = top(0), top(1)
        if tops[0] is None or tops[1] is None or (cheapest is not None and tops[0] + tops[1] > cheapest):
            break
        side = 0 if tops[0] <= tops[1] else 1
        _, at, state = heapq.heappop(heaps[side])
        node = (abs(at), state)
        settled[side].add(node)
        cost, audit = labels[side][node]
        i = node[0]
        if side == 0:
            found = [((i, NEXT[state]), 2, "I")]
            found += [((i + 1, after), more, edit) for after, more, edit in (behind[i][state] if i < n else ())]
            for other, more, edit in found:
                offer(0, other, (cost + more, audit + edit))
        else:
            found = [((i, earlier), 2, "I") for earlier in range(4) if NEXT[earlier] == state]
            found += [((i - 1, earlier), more, edit) for earlier, more, edit in (before[i - 1][state] if i else ())]
            for other, more, edit in found:
                offer(1, other, (cost + more, edit + audit))
        for other in [node, *(f[0] for f in found)]:
            if other in labels[0] and other in labels[1]:
                total = labels[0][other][0] + labels[1][other][0]
                cheapest = total if cheapest is None else min(cheapest, total)
    both = ((labels[0][node], labels[1][node]) for node in labels[0].keys() & labels[1].keys())
    return min(((cheapest, first + rest) for (x, first), (y, rest) in both if x + y == cheapest), default=None)


class Searches:
    """Searches by their rows: the same faults are searched once, until the memory is full and starts anew."""

    def __init__(self, most: int = 1 << 14):
        self.most, self.wholes, self.crossings = most, {}, {}

    def whole(self, rows: tuple[Row, ...]) -> Label:
        """The repair of a whole conversation of few rows."""
        if rows not in self.wholes:
            if len(self.wholes) >= self.most:
                self.wholes.clear()
            self.wholes[rows] = search(rows, START, ACCEPTED)
        return self.wholes[rows]

    def crossing(self, rows: tuple[Row, ...]) -> tuple[tuple[Label | None, ...], ...]:
        """The cheapest audit of a stretch from every state to every state."""
        if rows not in self.crossings:
            if len(self.crossings) >= self.most // 16:
                self.crossings.clear()
            self.crossings[rows] = tuple(tuple(search(rows, entry, (leave,)) for leave in range(4)) for entry in range(4))
        return self.crossings[rows]


def joined(left: list[Label | None], table: tuple[tuple[Label | None, ...], ...]) -> list[Label | None]:
    """Labels per state behind a stretch from those before it."""
    out: list[Label | None] = []
    for leave in range(4):
        found = [(x[0] + y[0], x[1] + y[1]) for x, y in ((left[s], table[s][leave]) for s in range(4)) if x is not None and y is not None]
        out.append(min(found, default=None))
    return out


class Stretch:
    """What is known of some consecutive rows of one conversation."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self, searches: Searches):
        self.searches = searches
        self.rows: list[Row] = []
        self.tables: list[tuple] = []
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.head = self.tail = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: str, ending: int, copies: int, first: bool) -> None:
        counts, forced = self.counts, copies
        if ending == 0:
            counts["blank"] += copies
        else:
            if first:
                forced -= 1
                counts["truncated"] += ending == 2
            counts["duplicate"] += forced
        if turn is not None:
            counts["turns"] += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        counts["illegal"] += copies - 1 + (self.tail is not None and self.tail + initial not in LEGAL)
        self.head = self.head or initial
        self.tail = initial
        if len(self.rows) >= CHUNK:
            self.tables.append(self.searches.crossing(tuple(self.rows)))
            self.rows.clear()
        if ending and first:
            self.rows.append((initial, int(ending == 2)))
        if forced:
            if self.rows and isinstance(self.rows[-1], int):
                self.rows[-1] += forced
            else:
                self.rows.append(forced)

    def from_state(self, entry: int) -> list[Label | None]:
        labels = [(0, "") if s == entry else None for s in range(4)]
        for table in [*self.tables, *([self.searches.crossing(tuple(self.rows))] if self.rows else [])]:
            labels = joined(labels, table)
        return labels

    def repaired(self) -> Label:
        if not self.tables:
            return self.searches.whole(tuple(self.rows))
        labels = self.from_state(START)
        return min(labels[s] for s in ACCEPTED if labels[s] is not None)


def _ending(text: Column) -> Column:
    """0 for a blank text, 1 for one that ends, 2 for one that is cut off."""
    trimmed = F.rtrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) == 0, 0).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 1).otherwise(2)


def _read(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text without nulls, and two digests that tell texts apart."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.xxhash64(text).alias("_d"), F.xxhash64(F.lit(1), text).alias("_e"))


ORDER = ("conv_id", "turn", "role", "_d", "_e")
FOUND = "cost long, audit string, blank long, duplicate long, truncated long, illegal long, gaps long"
PIECE = f"part long, head string, tail string, first_turn long, last_turn long, {', '.join(f'{c} long' for c in Stretch.COUNTS)}, costs array<long>, audits array<string>"


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id, cost, audit, blank, duplicate, truncated, illegal and gaps of every conversation that has a row."""
    slim = _read(rows).withColumn("_ending", _ending(F.col("text"))).groupBy(*ORDER, "_ending").agg(F.count("*").alias("_n"))
    firsts = slim.groupBy("conv_id", "role", "_d", "_e").agg(F.min(F.struct("turn")).alias("_at")).select("conv_id", F.col("_at.turn").alias("turn"), "role", "_d", "_e", F.lit(0).alias("_ending"), F.lit(0).cast("long").alias("_n"))
    both = slim.select(*firsts.columns).union(firsts).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, "_n")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def gaps(first: int | None, last: int | None, turns: int) -> int:
        return 0 if first is None else last - first + 1 - turns

    def result(conv, s: Stretch | None, part: int | None) -> dict:
        out = {"conv_id": conv}
        if part is None:
            cost, audit = s.repaired()
            counts = {c: s.counts[c] for c in Stretch.COUNTS if c != "turns"}
            return {**out, "cost": cost, "audit": audit, **counts, "gaps": gaps(s.first_turn, s.last_turn, s.counts["turns"]), "piece": None}
        labels = [label for entry in range(4) for label in s.from_state(entry)]
        piece = {"part": part, "head": s.head, "tail": s.tail, "first_turn": s.first_turn, "last_turn": s.last_turn, **s.counts}
        return {**out, "piece": {**piece, "costs": [x and x[0] for x in labels], "audits": [x and x[1] for x in labels]}}

    found_schema = f"conv_id {kind}, {FOUND}, piece struct<{', '.join(f.replace(' ', ':', 1) for f in PIECE.split(', '))}>"
    found_type = to_arrow_schema(StructType.fromDDL(found_schema))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        searches = Searches()
        conv, stretch, n, marked, out = None, None, 0, False, []
        for batch in one_by_one(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if stretch is None or row[0] != conv:
                    if stretch is not None:
                        out.append(result(conv, stretch, part if n == 0 else None))  # the first one may have begun in the task before
                        n += 1
                    conv, stretch = row[0], Stretch(searches)
                if row[6] == 0:
                    marked = True
                    continue
                role = row[2][:1]
                stretch.add(row[1], role if role in ("s", "u", "a") else "x", row[5], row[6], marked)
                marked = False
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, found_type)
                out = []
        if stretch is not None:
            out.append(result(conv, stretch, part))  # and the last one may go on in the next
        if out:
            yield pa.RecordBatch.from_pylist(out, found_type)

    walked = staged(both.mapInArrow(walk, found_schema), "repairs")
    cut = walked.where("piece IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))  # one piece a task at most
    closed_schema = f"conv_id {kind}, {FOUND}"
    closed_type = to_arrow_schema(StructType.fromDDL(closed_schema))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            out = []
            for conv, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                labels: list[Label | None] = [(0, ""), None, None, None]
                counts, tail, first, last = dict.fromkeys(Stretch.COUNTS, 0), None, None, None
                for p in some:
                    flat = [None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"], strict=True)]
                    labels = joined(labels, tuple(tuple(flat[4 * s : 4 * s + 4]) for s in range(4)))
                    for c in counts:
                        counts[c] += p[c]
                    counts["illegal"] += tail is not None and tail + p["head"] not in LEGAL
                    counts["turns"] -= last is not None and last == p["first_turn"]
                    tail = p["tail"]
                    first = p["first_turn"] if first is None else first
                    last = p["last_turn"] if p["last_turn"] is not None else last
                cost, audit = min(labels[s] for s in ACCEPTED if labels[s] is not None)
                turns = counts.pop("turns")
                out.append({"conv_id": conv, "cost": cost, "audit": audit, **counts, "gaps": gaps(first, last, turns)})
            if out:
                yield pa.RecordBatch.from_pylist(out, closed_type)

    return walked.where("piece IS NULL").drop("piece").union(cut.mapInArrow(close, closed_schema))


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (Keep, Rerole or Insert), turn, role and text of the repaired conversations, by the audits of `repairs`.

    The rows of a conversation are in one partition, in order.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    audits = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), *(F.lit(0).cast("long").alias(c) for c in ("_d", "_e")), "audit")
    both = _read(rows).withColumn("audit", F.lit(None).cast("string")).unionByName(audits)
    lined = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER[1:])
    names = {"K": "Keep", "R": "Rerole", "I": "Insert"}
    schema = f"conv_id {kind}, place long, edit string, turn long, role string, text string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, state = None, "", 0, 0, START
        for batch in one_by_one(batches):
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "audit")]
            out = []

            def inserted() -> None:
                nonlocal at, place, state
                while at < len(audit) and audit[at] == "I":
                    state = NEXT[state]
                    out.append((conv, place, "Insert", None, ROLES[state], ""))
                    at, place = at + 1, place + 1

            for key, turn, role, text, own in zip(*columns, strict=True):
                if own is not None:
                    conv, audit, at, place, state = key, own, 0, 0, START
                    inserted()  # those before the first row
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = KEPT[state, role[:1]] if edit == "K" else NEXT[state]
                    out.append((conv, place, names[edit], turn, role if edit == "K" else ROLES[state], text))
                    place += 1
                inserted()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return lined.mapInArrow(write, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of `role:text` joined by line breaks, of rows that `repaired_rows` gave.

    A digest is taken in order, so a conversation streams through one task, which keeps nothing but the state of the digest.
    """
    schema = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in one_by_one(batches):
            out = []
            for key, place, role, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if place == 0:
                    if state is not None:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], arrow)

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, schema)


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for every conv_id of `conversations`: what `repairs` finds in `rows` and the digest of the repaired rows."""
    found = staged(repairs(rows), "audits")
    marks = digests(repaired_rows(rows, found))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    null = F.lit(None)
    parts = [
        conversations.select("conv_id", *(null.cast("long").alias(c) for c in numbers), null.cast("string").alias("audit"), null.cast("string").alias("repaired_sha256")),
        found.select("conv_id", *numbers, "audit", null.cast("string").alias("repaired_sha256")),
        marks.select("conv_id", *(null.cast("long").alias(c) for c in numbers), null.cast("string").alias("audit"), "repaired_sha256"),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("conv_id").agg(*(F.max(c).alias(c) for c in [*numbers, "audit", "repaired_sha256"]))
    return every.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of their place: of every twenty one each is dropped, emptied, stripped of its sentence marks, repeated, given to the user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.select("conv_id", "turn", kind.alias("_kind"), role.alias("role"), text.alias("text"))
        .where("_kind <> 0")
        .withColumn("text", F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text")
    )

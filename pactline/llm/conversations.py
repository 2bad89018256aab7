"""Conversation structure repair by an integer-minimum path over a small graph.

A conversation is repaired by Keep, Rerole, Delete and Insert so that its
role initials read ``(s?(ua)+)?``. The nodes are (row, state of that grammar);
each edge is an edit with one integer weight: the cost in the high digits, and the
audit letter at the digit of its place in the audit, all places behind it zero. Weights
add up along a path, and the least of the plain integers is the cheapest repair with the
ASCII-least audit, the zeros at the end standing before every letter. Two paths to
one node never have equal cost with one audit beginning the other: the longer one would
have paid for more insertions. So the minimum at each node is final.

The integers are as wide as needed, not as the conversation is long: a state too dear
to win is dropped, and digits on which the paths to the others agree are
moved out. So a row costs much the same in conversations of any length.

Conversations are dealt by id and streamed in order, batch by batch. A text repeated at a
later turn is found beforehand, by joining rows to the earliest turn of
each (conversation, role, text) that occurs at several turns, so no row set is
held. The digest chains a conversation's whole text, which one process must
read in order; texts above ``HELD_BYTES`` are not kept for that but streamed a second
time behind their audit.

Defined results: null roles and texts are one space, and a null conv_id or turn is
one in the damage rule; null turns come first and are left out of the gaps; rows of
equal turns follow by role and text; a null conv_id is a conversation of its own; a role
other than one beginning with s, u or a (an empty one, too) can't be kept; a conversation without
rows is returned with zeros and an empty audit; an empty table gives no rows; columns
other than the four are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, partitions, stage

DIGIT = 3  # bits of an audit digit
WIDTH = 64  # digits of a weight at first
LETTERS = "\0DIKR"  # digit -> letter, in ASCII order
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COSTS = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
SWITCH_COST = 12  # a path dearer by more than this than the cheapest can't win
START, SYSTEM, USER, ASSISTANT = range(4)  # grammar states: what the last row was
#: state -> (state after the row that may come next, its role); ``s`` is only possible first
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
FINAL = (START, ASSISTANT)
#: what a row allows: initial (0 other, 1 s, 2 u, 3 a) + 4 if truncated; 8: must go
MUST_GO = 8
HELD_BYTES = 32_000_000
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Path:
    """Cheapest edits of the rows so far, per grammar state, as integers (cost, then audit digits)."""

    def __init__(self) -> None:
        self.width, self.moved = WIDTH, []
        self.best: dict[int, tuple[int, int]] = self._inserted({START: (0, 0)})  # state -> (weight, audit letters held)

    def _edge(self, path: tuple[int, int], letter: int, extra: int = 0) -> tuple[int, int]:
        weight, place = path
        return weight + ((COSTS[letter] + extra) << DIGIT * self.width) + (letter << DIGIT * (self.width - 1 - place)), place + 1

    def _inserted(self, best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """Rows inserted at this gap: at most one per state on a cheapest path."""
        for state in (START, SYSTEM, USER, ASSISTANT, USER):
            if state in best:
                to, path = NEXT[state][0], self._edge(best[state], INSERT)
                best[to] = min(best[to], path) if to in best else path
        return best

    def row(self, kind: int) -> None:
        if max(place for _, place in self.best.values()) + 4 > self.width:
            self._make_room()
        new: dict[int, tuple[int, int]] = {}

        def offer(state: int, path: tuple[int, int]) -> None:
            new[state] = min(new[state], path) if state in new else path

        for state, path in self.best.items():
            offer(state, self._edge(path, DELETE))
            if kind >= MUST_GO:
                continue
            extra, initial = (TRUNCATED_COST if kind & 4 else 0), kind & 3
            after = NEXT[state][0]
            offer(after, self._edge(path, REROLE, extra))
            if initial == after:
                offer(after, self._edge(path, KEEP, extra))
            if initial == SYSTEM and state == START:
                offer(SYSTEM, self._edge(path, KEEP, extra))
        best = self._inserted(new)
        # any state's rest can follow any other state for SWITCH_COST more at most (insert u and a, delete a kept s)
        limit = ((min(w for w, _ in best.values()) >> DIGIT * self.width) + SWITCH_COST + 1) << DIGIT * self.width
        self.best = {s: path for s, path in best.items() if path[0] < limit}

    def _digits(self, weight: int) -> int:
        return weight & ((1 << DIGIT * self.width) - 1)

    def _make_room(self) -> None:
        """Digits shared by all paths are moved out; without any, the integers become wider."""
        agree = min(place for _, place in self.best.values())
        digits = [self._digits(w) for w, _ in self.best.values()]
        differ = max(d ^ digits[0] for d in digits)
        if differ:
            agree = min(agree, self.width - 1 - (differ.bit_length() - 1) // DIGIT)
        if agree:
            shared = digits[0] >> DIGIT * (self.width - agree)
            self.moved.append("".join(LETTERS[shared >> DIGIT * k & 7] for k in range(agree - 1, -1, -1)))
            mask = (1 << DIGIT * (self.width - agree)) - 1
            self.best = {s: (w >> DIGIT * self.width << DIGIT * self.width | (w & mask) << DIGIT * agree, p - agree) for s, (w, p) in self.best.items()}
        if max(p for _, p in self.best.values()) + 4 > self.width // 2:
            self.best = {s: (w << DIGIT * self.width, p) for s, (w, p) in self.best.items()}
            self.width *= 2

    def repair(self) -> tuple[int, str]:
        weight, place = min(self.best[s] for s in FINAL if s in self.best)
        digits = self._digits(weight) >> DIGIT * (self.width - place)
        return weight >> DIGIT * self.width, "".join(self.moved) + "".join(LETTERS[digits >> DIGIT * k & 7] for k in range(place - 1, -1, -1))


def applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows: what each audit letter makes of the next row."""
    state = START
    for letter in audit:
        if letter == "I":
            state, role = NEXT[state]
            yield role, ""
            continue
        role, text = next(rows)
        if letter == "D":
            continue
        if letter == "R":
            state, role = NEXT[state]
        else:
            state = "sua".index(role[0]) + 1
        yield role, text


def damaged(rows: DataFrame) -> DataFrame:
    """The damage that the contract names, by crc32 of ``conv_id:turn``; dropped rows stay as marks (``gone``) so that no conversation is lost."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rule = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    base = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), rule.alias("rule"))
    text = F.when(F.col("rule") <= 1, F.lit("")).when(F.col("rule") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("rule") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select("conv_id", "turn", F.when(F.col("rule") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("rule") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, gone)`` with ``later``: role and text occur at an earlier turn of the conversation."""
    key = [F.xxhash64(F.lit(k), "conv_id", "role", "text").alias(f"h{k}") for k in (1, 2)]
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    keyed = rows.select("*", *key, at.alias("at"))
    repeated = keyed.where("not gone").groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last").select("h1", "h2", "first")
    return keyed.join(repeated, ["h1", "h2"], "left").select("conv_id", "turn", "role", "text", "gone", F.coalesce(F.col("first") < F.col("at"), F.lit(False)).alias("later"))


def streamed(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows dealt by conversation, each one's rows together and in order; ``text`` as bytes, whose order is that of code points."""
    dealt = rows.repartition(partitions(spark), "conv_id")
    return dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


def row_kind(role: str, text: str, duplicate: bool) -> tuple[int, int]:
    """(kind for the path, fault): 0 none, 1 blank, 2 duplicate, 3 truncated."""
    end = text.rstrip(" \t\n\v\f\r")
    if not end:
        return MUST_GO, 1
    if duplicate:
        return MUST_GO, 2
    initial = "sua".find(role[:1]) + 1 if role else 0
    return (initial, 0) if end[-1] in ".!?" else (initial + 4, 3)


def make_reporter(held_bytes: int = HELD_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One report row per conversation from its rows in order; ``repaired_sha256`` is null where the texts were not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        known: dict[bytes, tuple[int, str]] = {}

        def emit() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(c, pa.string()) for c in cols[7:]], names=[c.split()[0] for c in REPORT.split(", ")])

        class Conversation:
            def __init__(self, conv_id: int | None) -> None:
                self.conv_id, self.before, self.initial = conv_id, None, None
                self.faults, self.illegal, self.turns, self.low, self.high = [0] * 4, 0, 0, None, None
                self.kinds, self.path, self.held, self.size = bytearray(), None, [], 0

            def take(self, turn: int | None, role: str, text: str, later: bool) -> None:
                kind, fault = row_kind(role, text, later or self.before == (turn, role, text))
                self.faults[fault] += 1
                initial = role[:1]
                if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
                    self.illegal += 1
                if turn is not None and turn != self.high:
                    self.turns, self.high = self.turns + 1, turn
                    self.low = turn if self.low is None else self.low
                self.before, self.initial = (turn, role, text), initial
                self.kinds.append(kind)
                if len(self.kinds) >= 256:  # long: rows go into the path as they come
                    self.walk()
                if self.held is not None:
                    self.held.append((role, text))
                    self.size += len(role) + len(text) + 100
                    if self.size > held_bytes:
                        self.held = None

            def walk(self) -> None:
                self.path = self.path or Path()
                for kind in self.kinds:
                    self.path.row(kind)
                self.kinds.clear()

            def report(self) -> tuple:
                key = bytes(self.kinds) if self.path is None else None
                if key is None or key not in known:
                    self.walk()
                    found = self.path.repair()
                    if key is not None and len(known) < 50_000:
                        known[key] = found
                else:
                    found = known[key]
                digest = None
                if self.held is not None:
                    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in applied(found[1], iter(self.held))).encode()).hexdigest()
                gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
                return (self.conv_id, gaps, *self.faults[1:], self.illegal, *found, digest)

        now = None
        for batch in batches:
            for conv_id, turn, role, text, gone, later in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.report())
                        if len(out) >= 2000:
                            yield emit()
                    now = Conversation(conv_id)
                if not gone:
                    now.take(turn, role, text, later)
        if now is not None:
            out.append(now.report())
            yield emit()

    return run


def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of repaired rows: each conversation's audit comes first in the stream, its rows behind it."""
    audit, at, state, now = "", 0, START, None

    def inserts() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, role = NEXT[state]
            at += 1
            yield now, role, ""

    for batch in batches:
        for conv_id, role, text, given in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if given is not None:
                yield from inserts()
                audit, at, state, now = given, 0, START, conv_id
                continue
            yield from inserts()
            letter = audit[at]
            at += 1
            if letter == "R":
                state, role = NEXT[state]
            elif letter == "K":
                state = "sua".index(role[0]) + 1
            if letter != "D":
                yield conv_id, role, text
    yield from inserts()


def with_audit_first(rows: DataFrame, audits: DataFrame, spark: SparkSession) -> DataFrame:
    """(conv_id, role, text, audit): per conversation of ``audits`` one row with its audit, then its rows in order."""
    own = rows.where("not gone").join(audits.select("conv_id"), rows["conv_id"].eqNullSafe(audits["conv_id"]), "left_semi")
    both = own.select("conv_id", "turn", "role", "text", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("part")).unionByName(
        audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", F.lit(0).alias("part")))
    dealt = both.repartition(partitions(spark), "conv_id")
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "role", "text", "audit")


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, sha256) of repaired conversations, row by row; those without rows are left out."""
    now, chain, first = None, None, True
    done: list[tuple] = []
    for conv_id, role, text in replay(batches):
        if first or conv_id != now:
            if not first:
                done.append((now, chain.hexdigest()))
            now, chain, first = conv_id, hashlib.sha256(), False
        else:
            chain.update(b"\n")
        chain.update(f"{role}:{text}".encode())
    if not first:
        done.append((now, chain.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "digest"])


def repaired_rows(spark: SparkSession, rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations themselves: (conv_id, place, role, text), from ``rows(conv_id, turn, role, text, gone)`` and ``audits(conv_id, audit)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, now, first = [], 0, None, True

        def emit() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv_id", "place", "role", "text"])

        for conv_id, role, text in replay(batches):
            place = place + 1 if not first and conv_id == now else 0
            now, first = conv_id, False
            out.append((conv_id, place, role, text))
            if len(out) >= 2000:
                yield emit()
        if out:
            yield emit()

    return with_audit_first(rows, audits, spark).mapInArrow(run, "conv_id long, place long, role string, text string")


def repair_report(spark: SparkSession, rows: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text, gone)``: its faults, the cheapest repair's cost and audit, and the repaired text's digest."""
    report = stage(spark, streamed(judged(rows), spark).mapInArrow(make_reporter(held_bytes), REPORT), "conversations")
    long = report.where("repaired_sha256 is null")
    if long.isEmpty():
        return report
    # conversations of more than held_bytes: their rows are streamed again behind their audit
    late = stage(spark, with_audit_first(rows, long.select("conv_id", "audit"), spark).mapInArrow(digests, "conv_id long, digest string"), "conversation-digests")
    late = late.withColumnRenamed("conv_id", "of")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    joined = report.join(late, report["conv_id"].eqNullSafe(late["of"]), "left")
    return joined.select(*(F.coalesce("repaired_sha256", "digest", empty).alias(c) if c == "repaired_sha256" else F.col(c) for c in report.columns))


def op12_repair(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    return repair_report(spark, damaged(conversations))

"""Repair of the structure of conversations: faults, the cheapest edits, and the repaired rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .four_russians import CLASSES, EMPTY, OTHER, Tables, after_insert, after_keep

WHITE = " \t\n\x0b\f\r"
# A row's code: 4 * class of its role + its first fault.
SOUND, CUT, BLANK, REPEATED = range(4)
_PLAN = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _filled(rows: DataFrame) -> DataFrame:
    """The columns that matter; a null role or text is one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text)


def _same(*columns: Column) -> Column:
    """128 bits that tell strings apart, null from any."""
    told = [F.concat(F.coalesce(F.length(c).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(c, F.lit(""))) for c in columns]
    return F.unhex(F.md5(F.concat(*told)))


def _codes(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, same, n, code, dup``: equal rows as one, the code of the first and of the other n - 1.

    Equal rows are counted by task before they are shuffled. A role and text is met first in the row of the
    lowest turn, nulls lowest.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    role = F.coalesce(*[F.when(initial == c, F.lit(i)) for i, c in enumerate(CLASSES)], F.lit(OTHER)) * 4
    fault = F.when(trimmed == "", BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(CUT)
    counted = (
        rows.select("conv_id", "turn", _same(F.col("role"), F.col("text")).alias("same"), (role + fault).alias("code"))
        .groupBy("conv_id", "turn", "same", "code")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("met", _same(F.col("conv_id").cast("string"), F.hex("same")))
    )
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("first"))
    firsts = counted.groupBy("met").agg(F.min(order).alias("order"), F.count(F.lit(1)).alias("turns"))
    firsts = firsts.where("turns > 1").select("met", "order.first")
    again = F.col("first").isNotNull() & (F.col("turn") > F.col("first")) | F.col("first").isNull() & F.col("turn").isNotNull()
    joined = counted.join(firsts.withColumn("often", F.lit(True)), "met", "left")
    blank = F.col("code") % 4 == BLANK
    repeated = F.col("code") - F.col("code") % 4 + REPEATED
    return joined.select(
        "conv_id",
        "turn",
        "same",
        "n",
        F.when(F.col("often") & again & ~blank, repeated).otherwise(F.col("code")).alias("code"),
        F.when(blank, F.col("code")).otherwise(repeated).alias("dup"),
    )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of each conversation in a sorted partition as one row, with its first, last and different turns."""
    nothing = object()
    conv, codes, first, last, turns, kind = nothing, [], None, None, 0, None

    def row():
        values = [[conv], [b"".join(codes)], [first], [last], [turns]]
        kinds = [kind, pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["conv_id", "codes", "first", "last", "turns"]
        )

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "n", "code", "dup")]
        for here, turn, n, code, dup in zip(*columns, strict=True):
            if conv is nothing or here != conv:
                if conv is not nothing:
                    yield row()
                conv, codes, first, last, turns = here, [], None, None, 0
            if n:
                codes.append(bytes([code]) + bytes([dup]) * (n - 1))
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
    if conv is not nothing:
        yield row()


def _illegal(classes: np.ndarray) -> int:
    """Neighbours that are not system and user, user and assistant, or assistant and user."""
    a, b = classes[:-1], classes[1:]
    return int(np.sum(~((a == 0) & (b == 1) | (a == 1) & (b == 2) | (a == 2) & (b == 1))))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = Tables()
    for batch in batches:
        strings, found = [], {c: [] for c in _PLAN}
        for stretches in batch.column("stretches").to_pylist():
            codes = np.frombuffer(b"".join(s["codes"] for s in stretches), np.uint8).astype(np.int64)
            classes, faults = codes // 4, codes % 4
            strings.append(np.where(faults >= BLANK, 0, 1 + 2 * classes + (faults == CUT)))
            known = [s for s in stretches if s["turns"]]
            met_twice = sum(a["last"] == b["first"] for a, b in zip(known, known[1:]))
            turns = sum(s["turns"] for s in known) - met_twice
            found["gaps"].append(known[-1]["last"] - known[0]["first"] + 1 - turns if known else 0)
            for name, fault in (("blank", BLANK), ("duplicate", REPEATED), ("truncated", CUT)):
                found[name].append(int(np.sum(faults == fault)))
            found["illegal"].append(_illegal(classes))
        audits, found["cost"] = tables.repair(strings)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *[pa.array(found[c], pa.int64()) for c in _PLAN], pa.array(audits, pa.string())],
            ["conv_id", *_PLAN, "audit"],
        )


def plan_repairs(rows: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """``conv_id``, counts of faults, ``cost`` and ``audit`` of each conversation in ``rows`` (conv_id, turn, role, text).

    Rows stand by turn, nulls first, equal turns by a digest of role and text. A row's first fault counts: blank,
    duplicate (of role and text) or truncated (no ``.!?`` at its end). ``audit`` has the initials of the cheapest
    edits (Keep, Rerole, Delete, Insert) that make the roles' initials match ``(s?(ua)+)?``, the ASCII-least of
    equally cheap ones. ``gaps`` are missing turns between the lowest and the highest. Conversations of ``everyone``
    (conv_id) without rows get zeros and no edits. A null conv_id is a conversation too; other columns don't matter.

    A row travels as a digest and a byte. Rows are range-partitioned by place, so a large conversation lies in many
    tasks; only its bytes, one per row as in its audit, meet in one.
    """
    codes = _codes(_filled(rows))
    if everyone is not None:
        nobody = everyone.select("conv_id").distinct().select(
            "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("same"),
            F.lit(0).cast("long").alias("n"), F.lit(0).alias("code"), F.lit(0).alias("dup"),
        )
        codes = codes.unionByName(nobody)
    kind = rows.schema["conv_id"].dataType
    laid = codes.repartitionByRange("conv_id", "turn", "same").sortWithinPartitions("conv_id", "turn", "same")
    stretch = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("codes", T.BinaryType())]
        + [T.StructField(c, T.LongType()) for c in ("first", "last", "turns")]
    )
    plan = T.StructType(
        [T.StructField("conv_id", kind)] + [T.StructField(c, T.LongType()) for c in _PLAN] + [T.StructField("audit", T.StringType())]
    )
    found = laid.mapInArrow(_stretches, stretch).withColumn("part", F.spark_partition_id())
    whole = found.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "codes", "first", "last", "turns"))).alias("stretches")
    )
    return whole.mapInArrow(_solve, plan)


class Follower:
    """Follows an audit row by row: what to write for each row, and what is inserted before it."""

    def __init__(self, audit: str):
        self.edits, self.at, self.state = audit, 0, EMPTY

    def inserts(self) -> list[str]:
        """Roles of the rows inserted here."""
        found = []
        while self.edits.startswith("I", self.at):
            found.append(self.fill())
            self.at += 1
        return found

    def fill(self) -> str:
        self.state = after_insert(self.state)
        return "user" if self.state != 3 else "assistant"

    def row(self, role: str) -> str | None:
        """The role that the next row gets, or None if it goes."""
        edit = self.edits[self.at]
        self.at += 1
        if edit == "R":
            return self.fill()
        if edit == "K":
            self.state = after_keep(self.state, CLASSES.index(role[0]))
            return role
        return None


def _streamed(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows in order, in one partition."""
    rows = _filled(rows).select(
        "conv_id", F.lit(1).alias("kind"), "turn", _same(F.col("role"), F.col("text")).alias("same"), "role", "text"
    )
    heads = plans.withColumns({"kind": F.lit(0), "text": F.col("audit")}).drop("audit")
    both = heads.unionByName(rows, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "same").drop("same")


def _walk(batches: Iterator[pa.RecordBatch]):
    """(plan, lines) per batch and conversation: lines are (edit, role, text). A conversation's first lines come with
    its plan, later ones with the same plan again; None for both at its end."""
    plan, follower = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if follower:
                    yield plan, [("I", role, "") for role in follower.inserts()], True
                plan, follower = row, Follower(row["text"])
                continue
            lines = [("I", role, "") for role in follower.inserts()]
            edit = follower.edits[follower.at]
            role = follower.row(row["role"])
            yield plan, [*lines, (edit, row["role"] if role is None else role, row["text"])], False
    if follower:
        yield plan, [("I", role, "") for role in follower.inserts()], True


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, edit``: the rows after ``plans`` (of plan_repairs), inserted ones too, in order.

    A conversation streams through one task in order; the task holds its audit and one batch of rows.
    """
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place, schema = [], 0, None

        def peek():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        def out():
            columns = [[h[i] for h in held] for i in range(5)]
            kinds = [schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "place", "role", "text", "edit"]
            )

        size = 0
        for plan, lines, last in _walk(peek()):
            for edit, role, text in lines:
                if edit != "D":
                    held.append((plan["conv_id"], place, role, text, edit))
                    place, size = place + 1, size + len(text) + 100
            place = 0 if last else place
            if size > 4 << 20:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    schema = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("place", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("role", "text", "edit")]
    )
    return _streamed(rows, plans).mapInArrow(run, schema)


def with_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``plans`` with ``repaired_sha256``, the digest of the repaired ``role:text`` lines, joined by newlines.

    SHA-256 takes its input in order, so a conversation's rows stream through one task; none is held.
    """
    kind = rows.schema["conv_id"].dataType
    names = ["conv_id", *_PLAN, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, schema, hashed, empty = [], None, hashlib.sha256(), True

        def peek():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        def out():
            kinds = [schema.field("conv_id").type, *[pa.int64()] * len(_PLAN), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names
            )

        size = 0
        for plan, lines, last in _walk(peek()):
            for edit, role, text in lines:
                if edit != "D":
                    hashed.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            if last:
                done.append((plan["conv_id"], *[plan[c] for c in _PLAN], plan["text"], hashed.hexdigest()))
                size += len(plan["text"]) + 200
                hashed, empty = hashlib.sha256(), True
                if size > 4 << 20:
                    yield out()
                    done, size = [], 0
        if done:
            yield out()

    schema = T.StructType(
        [T.StructField("conv_id", kind)]
        + [T.StructField(c, T.LongType()) for c in _PLAN]
        + [T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")]
    )
    return _streamed(rows, plans).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by a checksum of conversation and turn: dropped, emptied, without sentence ends,
    repeated, or given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = _filled(conversations).withColumn("dice", F.crc32(key) % 20).where("dice <> 0")
    text = F.when(F.col("dice") == 1, "").when(F.col("dice") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("dice") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("dice") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark, sf_dir):
    """Every conversation after damage: its faults, the cheapest repair, and a digest of the repaired rows."""
    conversations = table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    return with_digests(rows, plan_repairs(rows, conversations))

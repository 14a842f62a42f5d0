"""Conversation structure repair: faults of every turn, and the cheapest edits
that fit a conversation to the grammar (s?(ua)+)?; the method is in
``turn_alignment``.

Turns are dealt by ranges of (conversation, turn), so a conversation of any size
spreads over tasks. A task solves the conversations that lie wholly within it.
The others, at most two a task and those of more than ``MAX_HELD`` turns, come
out as runs of ``RUN`` turns: duplicates between ranges are found by a grouped
minimum, every run is aligned between all grammar states on its own, and one
streaming fold a conversation adds the runs up in constant memory (its digest
is sequential by nature).
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_process, ship, staged
from .turn_alignment import RUN, Between, Fold, letters_of

#: White space of the contract.
SPACE = " \t\n\x0b\f\r"
#: Conversations of more turns than this come out as runs.
MAX_HELD = 4096
#: Turns that the bounds of the ranges are drawn by: this much of a text.
_PREFIX = 64
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired string"
_RUN = "part int, seq int, turns array<long>, initials string, faults string, digests array<binary>, roles array<string>, texts array<string>"
_COLUMNS = [f.split()[0] for f in _RESULT.split(", ")]


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")), (F.crc32(key) % 20).alias("_kind"))
    kind = F.col("_kind")
    rows = rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return rows.drop("_copy")


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, and with ``with_text`` the repaired
    turns as ``role:text`` lines (a whole conversation in one row).

    Turns count in order of turn (null first), role, text. A null role or text
    is one space; a null id is a conversation of its own; rows that are equal
    are duplicates after the first. Texts of any length pass. No rows give no
    rows. Other columns are not read.
    """
    ship(Fold.__module__, per_process.__module__, __name__)
    spark = turns.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(" "))
    role = F.coalesce(F.col(role_col), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(parts, "conv", "turn", "role", F.substring("text", 1, _PREFIX)).sortWithinPartitions("conv", "turn", "role", "text")
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), ".").otherwise("t")
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    digest = F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.col("text")), 256))
    judged = dealt.select("conv", "turn", "role", "text", initial.alias("initial"), fault.alias("fault"), digest.alias("digest"))
    conv_type = judged.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", conv_type), *T.DataType.fromDDL(_RESULT).fields, T.StructField("run", T.DataType.fromDDL(_RUN))])
    table, path = staged(judged.mapInArrow(_solver(_arrow(schema), with_text), schema), "turns")
    solved = table.where(F.col("run").isNull()).select("conv", *_COLUMNS)
    runs = table.where(F.col("run").isNotNull()).select("conv", "run.*")
    # a turn's text may be a duplicate of an earlier range's
    seen = runs.select("conv", "part", "seq", F.posexplode("digests").alias("pos", "digest")).where(F.col("digest").isNotNull())
    first = seen.groupBy("conv", "digest").agg(F.min("part").alias("first"))
    again = (seen.alias("s").join(first.alias("f"), F.col("s.conv").eqNullSafe(F.col("f.conv")) & (F.col("s.digest") == F.col("f.digest")) & (F.col("s.part") > F.col("f.first")))
             .groupBy("s.conv", "s.part", "s.seq").agg(F.collect_list("s.pos").alias("again")))       # at most RUN of them
    marked = (runs.alias("r").join(again.alias("a"), F.col("r.conv").eqNullSafe(F.col("a.conv")) & (F.col("r.part") == F.col("a.part")) & (F.col("r.seq") == F.col("a.seq")), "left")
              .select("r.conv", "r.part", "r.seq", "r.turns", "r.initials", "r.faults", "r.roles", "r.texts", "a.again"))
    ways = T.StructType([*marked.schema.fields[:-1], T.StructField("known", T.DataType.fromDDL("array<struct<begin: int, end: int, cost: int, letters: string>>"))])
    aligned = marked.mapInArrow(_aligner(_arrow(ways)), ways)
    result = T.StructType([T.StructField("conv", conv_type), *T.DataType.fromDDL(_RESULT).fields])
    folded = (aligned.repartition(parts, "conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(_folder(_arrow(result), with_text), result))
    out = solved.unionByName(folded)
    return out.select(F.col("conv").alias("conv_id"), *(_COLUMNS if with_text else _COLUMNS[:-1]))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows, a bounded slice of a batch at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 512).columns))


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of bounded size together."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row.get("audit") or "") + len(row.get("repaired") or "") + sum(map(len, (row.get("run") or row).get("texts") or ()))
        if len(held) >= 2048 or size >= 4 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _runs(turns: list[tuple]) -> Iterator[tuple]:
    """(turns, initials, faults, roles, texts, digests) of at most RUN turns; a
    duplicate's digest is left out."""
    for at in range(0, len(turns), RUN):
        turn, role, text, initial, fault, digest = zip(*turns[at:at + RUN])
        yield list(turn), "".join(initial), "".join(fault), list(role), list(text), list(digest)


def _solver(schema: pa.Schema, with_text: bool):
    """Sorted turns of a range -> results of the conversations within it, runs of the others."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        between = per_process("turns_between", Between)
        seq = 0

        def as_runs(conv, held):
            nonlocal seq
            for turn, initials, faults, roles, texts, digests in _runs(held):
                yield {"conv": conv, "run": {"part": part, "seq": seq, "turns": turn, "initials": initials, "faults": faults,
                                             "digests": digests, "roles": roles, "texts": texts}}
                seq += 1

        conv, held, seen, is_open, begun, size = None, [], set(), True, False, 0
        for own, turn, role, text, initial, fault, digest in _rows(batches):
            if begun and own != conv:
                if is_open:                                      # it may have begun in the range before
                    yield from as_runs(conv, held)
                else:
                    fold = Fold(between, with_text)
                    for turns, initials, faults, roles, texts, _ in _runs(held):
                        fold.push(turns, initials, faults, roles, texts)
                    yield {"conv": conv, **fold.finish()}
                held, seen, is_open, size = [], set(), False, 0
            conv, begun = own, True
            if fault != "b":
                fault, digest = ("d", None) if digest in seen else (fault, digest)
                seen.add(digest)
            else:
                digest = None
            held.append((turn, role, text, initial, fault, digest))
            size += len(text)
            if len(held) % RUN == 0 and (len(held) >= MAX_HELD or size >= 8 << 20):
                yield from as_runs(conv, held)
                held, is_open, size = [], True, 0
        if held:                                                 # it may go on in the next range
            yield from as_runs(conv, held)

    return lambda batches: _batches(solve(batches), schema)


def _aligner(schema: pa.Schema):
    """Runs with their duplicates marked, and the cheapest ways between all states."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        between = per_process("turns_between", Between)
        for conv, part, seq, turns, initials, faults, roles, texts, again in _rows(batches):
            if again:
                again = set(again)
                faults = "".join("d" if i in again else f for i, f in enumerate(faults))
            letters = letters_of(initials, faults)
            known = [{"begin": b, "end": e, "cost": found[0], "letters": found[1]} for b in range(4) for e in range(4) if (found := between(letters, b, e))]
            yield {"conv": conv, "part": part, "seq": seq, "turns": turns, "initials": initials, "faults": faults, "roles": roles, "texts": texts, "known": known}

    return lambda batches: _batches(run(batches), schema)


def _folder(schema: pa.Schema, with_text: bool):
    """Sorted runs -> a result a conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        between = per_process("turns_between", Between)
        conv, fold = None, None
        for own, _, _, turns, initials, faults, roles, texts, known in _rows(batches):
            if fold and own != conv:
                yield {"conv": conv, **fold.finish()}
                fold = None
            conv, fold = own, fold or Fold(between, with_text)
            fold.push(turns, initials, faults, roles, texts, {(k["begin"], k["end"]): (k["cost"], k["letters"]) for k in known})
        if fold:
            yield {"conv": conv, **fold.finish()}

    return lambda batches: _batches(run(batches), schema)

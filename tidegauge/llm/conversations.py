"""Repair of conversation structure at the least cost: one integer minimum over a graph of edits.

A row of a conversation can be kept, given another role or deleted, and rows without text can be
added, until the initials of the roles read `(s?(ua)+)?`. The way back from the end of a
conversation is a path through a graph without cycles; the weight of a path is one big integer. Its
high digits are the cost. Its low digits, three bits each, are the letters of the edits from
the first on, D I K R as 1 to 4, with zeros behind the last: the smaller integer is the cheaper path
and, at equal cost, the one whose letters come first in ASCII.

Long conversations are cut into pieces that tasks solve by themselves, for each pair of
states before and after; a chain of small integers then picks the pair of each piece. Added rows
belong to the row behind them, so every piece's letters end with that of a row: two ways through a
piece are equal or differ within it, and comparing them needs nothing of what follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

# Rows and bytes of text of a piece.
PIECE = 1024
PIECE_BYTES = 4 << 20
# Fixed costs of the edits.
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3

BLANKS = " \t\n\v\f\r"
_LEGAL = ("su", "ua", "au")
# States: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
# Where a user or assistant row, added or given that role, leads to.
_MADE = (_USER, _USER, _ASSISTANT, _USER)
# Where a kept row leads to, by its initial.
_KEPT = (
    {"s": _SYSTEM, "u": _USER},
    {"u": _USER},
    {"a": _ASSISTANT},
    {"u": _USER},
)
# Rows added at the end of a conversation.
_LAST = (0, 2, 1, 0)
_D, _I, _K, _R = 1, 2, 3, 4
_LETTERS = str.maketrans("1234", "DIKR")


class Ways:
    """Least weights from each state to the end of some rows, for rows of known number."""

    def __init__(self, rows: int):
        self.width = 3 * rows + 2
        self.shift = 3 * self.width
        self.low = (1 << self.shift) - 1
        self.never = 1 << (self.shift + 60)

    def step(self, letter: int, cost: int) -> int:
        return (cost << self.shift) | (letter << (self.shift - 3))

    def behind(self, weight: int) -> int:
        """A weight whose letters have moved back by one, to make room for one before them."""
        letters = weight & self.low
        return weight - letters + (letters >> 3)

    def ends(self) -> list[int]:
        """Weights at the end of a conversation: what is missing there is added."""
        one = self.step(_I, INSERT)
        added = [0, one, self.behind(one) + one]
        return [added[n] for n in _LAST]

    def back(self, rows: list[tuple[str, bool, bool]], ends: list[int]) -> list[int]:
        """Weights from each state before the rows (initial, to be deleted, cut off)."""
        behind, step = self.behind, self.step
        deleted, added = step(_D, DELETE), step(_I, INSERT)
        kept = [step(_K, 0), step(_K, CUT_OFF)]
        changed = [step(_R, REROLE), step(_R, REROLE + CUT_OFF)]
        after = ends
        for initial, gone, cut in reversed(rows):
            led = [behind(w) for w in after]
            own = [w + deleted for w in led]
            if not gone:
                for q in _STATES:
                    own[q] = min(own[q], led[_MADE[q]] + changed[cut])
                    to = _KEPT[q].get(initial)
                    if to is not None:
                        own[q] = min(own[q], led[to] + kept[cut])
            # One or two rows added before this one; three never pay.
            after = own
            for _ in range(2):
                led = [behind(w) for w in after]
                after = [min(own[q], led[_MADE[q]] + added) for q in _STATES]
        return after

    def cost(self, weight: int) -> int:
        return weight >> self.shift

    def audit(self, weight: int) -> str:
        return f"{weight & self.low:0{self.width}o}".rstrip("0").translate(_LETTERS)


def best_edits(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and letters of the best repair of a whole conversation."""
    ways = Ways(len(rows))
    weight = ways.back(rows, ways.ends())[_START]
    return ways.cost(weight), ways.audit(weight)


def all_ways(rows: list[tuple[str, bool, bool]]) -> tuple[list[int], list[int], list[str]]:
    """Of a piece: cost (-1: none), rank of the letters and letters, for 4 x 4 states before, after."""
    ways = Ways(len(rows))
    found = []
    for to in _STATES:
        found.append(ways.back(rows, [0 if q == to else ways.never for q in _STATES]))
    costs, ranks, audits = [], [], []
    for q in _STATES:
        order = sorted(_STATES, key=lambda to: found[to][q] & ways.low)
        for to in _STATES:
            there = found[to][q] < ways.never
            costs.append(ways.cost(found[to][q]) if there else -1)
            ranks.append(order.index(to))
            audits.append(ways.audit(found[to][q]) if there else "")
    return costs, ranks, audits


def repaired(
    audit: str, roles: list[str], texts: list[str | None], state: int
) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits, from a state on."""
    out_roles, out_texts, at = [], [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, state = roles[at], _KEPT[state][roles[at][:1]]
        else:
            state = _MADE[state]
            role = "user" if state == _USER else "assistant"
        out_roles.append(role)
        out_texts.append("" if letter == "I" else texts[at])
        at += letter != "I"
    return out_roles, out_texts


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


class _Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.rows: list[tuple[str, bool, bool]] = []
        self.roles: list[str] = []
        self.texts: list[str | None] = []
        self.bytes = 0
        self.faults = [0, 0, 0]

    def full(self) -> bool:
        return len(self.rows) >= PIECE or self.bytes >= PIECE_BYTES

    def add(self, role: str, text: str, again: bool) -> None:
        said = text.rstrip(BLANKS)
        blank = not said
        again = again and not blank
        cut = not (blank or again) and said[-1] not in ".!?"
        for k, fault in enumerate((blank, again, cut)):
            self.faults[k] += fault
        gone = blank or again
        self.rows.append((role[:1], gone, cut))
        self.roles.append(role)
        self.texts.append(None if gone else text)
        self.bytes += 0 if gone else len(text)

    def closed(self, part: int, number: int, whole: bool) -> dict:
        initials = [row[0] for row in self.rows]
        pairs = zip(initials, initials[1:], strict=False)
        out = {
            "conv_id": self.conv_id,
            "part": part,
            "number": number,
            "whole": whole,
            "blank": self.faults[0],
            "duplicate": self.faults[1],
            "truncated": self.faults[2],
            "illegal": sum(a + b not in _LEGAL for a, b in pairs),
            "first": initials[0],
            "last": initials[-1],
        }
        if whole:
            cost, audit = best_edits(self.rows)
            roles, texts = repaired(audit, self.roles, self.texts, _START)
            more = {"cost": cost, "audit": audit, "costs": [], "ranks": [], "audits": []}
        else:
            costs, ranks, audits = all_ways(self.rows)
            roles, texts = self.roles, self.texts
            more = {"cost": 0, "audit": "", "costs": costs, "ranks": ranks, "audits": audits}
        return out | more | {"roles": roles, "texts": texts, "bytes": self.bytes}


def _gathered(found: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of some hundred rows, fewer where their texts are long."""
    held, size = [], 0
    for row in found:
        size += row.pop("bytes", 0)
        held.append(row)
        if len(held) >= 512 or size >= PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Pieces of the conversations of a sorted partition.

    A conversation between two others is whole and solved at once. The first and the last of a
    partition may go on elsewhere, and what fills a piece goes on in the next one.
    """
    part = TaskContext.get().partitionId()
    piece, number, cut = None, 0, True
    for batch in batches:
        for conv_id, role, text, copies, again in _columns(batch):
            if piece is not None and piece.conv_id != conv_id:
                yield piece.closed(part, number, whole=not cut)
                piece, number, cut = None, number + 1, False
            for copy in range(copies):
                if piece is not None and piece.full():
                    yield piece.closed(part, number, whole=False)
                    piece, number, cut = None, number + 1, True
                piece = piece or _Piece(conv_id)
                piece.add(role, text, again or copy > 0)
    if piece is not None:
        yield piece.closed(part, number, whole=False)


def _chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The last piece of a conversation first: for each state before a piece, the best one after."""
    own, conv_id, totals = False, None, []
    for batch in batches:
        for conv, part, number, costs, ranks, first, last in _columns(batch):
            if not own or conv != conv_id:
                totals = [INSERT * n for n in _LAST]
            last_piece, own, conv_id = not own or conv != conv_id, True, conv
            to, now = [], []
            for q in _STATES:
                best = min(
                    ((costs[4 * q + p] + totals[p]) * 4 + ranks[4 * q + p], p)
                    for p in _STATES
                    if costs[4 * q + p] >= 0
                )
                to.append(best[1])
                now.append(best[0] >> 2)
            totals = now
            yield {
                "conv_id": conv,
                "part": part,
                "number": number,
                "to": to,
                "ending": last_piece,
                "first": first,
                "last": last,
            }


def _walked(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The first piece of a conversation first: the state before each piece, and its place."""
    own, conv_id, state, piece, before = False, None, _START, 0, ""
    for batch in batches:
        for conv, part, number, to, ending, first, last in _columns(batch):
            if not own or conv != conv_id:
                own, conv_id, state, piece = True, conv, _START, 0
            yield {
                "part": part,
                "number": number,
                "piece": piece,
                "state": state,
                "to": to[state],
                "ending": ending,
                "joint": int(piece > 0 and before + first not in _LEGAL),
            }
            state, piece, before = to[state], piece + 1, last


def _finished(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            at = 4 * row.pop("state_before") + row["to"]
            state = at // 4
            audit, cost = row.pop("audits")[at], row.pop("costs")[at]
            if row.pop("ending"):
                cost += INSERT * _LAST[row["to"]]
                audit += "I" * _LAST[row["to"]]
            row.pop("to")
            row["illegal"] += row.pop("joint")
            roles, texts = repaired(audit, row["roles"], row["texts"], state)
            size = sum(map(len, texts))
            yield row | {
                "cost": cost,
                "audit": audit,
                "roles": roles,
                "texts": texts,
                "bytes": size,
            }


def _schema(table: DataFrame, fields: str) -> str:
    return f"conv_id {table.schema['conv_id'].dataType.simpleString()}, {fields}"


def _mapped(table: DataFrame, work, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(work(batches), arrow)

    return table.mapInArrow(run, schema)


_FAULTS = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows of each conversation, with what was wrong and what was done.

    `rows` holds `conv_id, turn, role, text`; a null role or text is one blank. Rows of a
    conversation (null is one too) stand in the order of turn (null first), then role, then text. A
    row's first fault counts: blank; duplicate of an earlier role and text; truncated, where the
    last character that is no blank is none of `.!?`. A role that is empty has no initial and
    cannot be kept. Keeping a row costs 0, the role user or
    assistant 3, deleting 4, a row that is added 3, a truncated row that stays 3 more. Blank
    rows and duplicates are deleted.

    Returns pieces: `conv_id, piece` (from 0), `whole` (the conversation has this piece only),
    `blank, duplicate, truncated, illegal` (neighbours whose initials are not su, ua or au,
    counted with the later one), `cost`, `audit` (letters of the edits in order), `roles`
    and `texts` of the repaired rows. A piece comes from at most 1024 rows or about 4 MB of text;
    one conversation may hold a third of all rows. Equal rows are counted before they are
    sorted, and no group is gathered. Extra columns are ignored. An empty table gives none.
    """
    blank = F.lit(" ")
    plain = rows.select(
        rows["conv_id"].alias("conv_id"),
        rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"], blank).alias("role"),
        F.coalesce(rows["text"], blank).alias("text"),
    )
    own = F.col("conv_id").cast("string")
    key = F.concat_ws(
        ":",
        F.coalesce(F.length(own), F.lit(-1)).cast("string"),
        F.length("role").cast("string"),
        own,
        "role",
        "text",
    )
    given = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    given = stored(given.withColumn("key", F.unhex(F.sha2(key, 256))), "given")
    # Where a role and text comes again at a later turn; null turns are first.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    repeats = (
        given.groupBy("key")
        .agg(F.min(turn).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1")
        .select("key", "first")
    )
    again = F.coalesce(turn != F.col("first"), F.lit(False))
    marked = given.join(repeats, "key", "left").withColumn("again", again)
    order = ["conv_id", "turn", "role", "text"]
    # The bounds of the ranges are kept small: long texts count with their beginning there.
    ranged = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    ranged = ranged.sortWithinPartitions(*order)
    pieces = stored(
        _mapped(
            ranged.select("conv_id", "role", "text", "copies", "again"),
            _cut,
            _schema(
                rows,
                f"part int, number long, whole boolean, {_FAULTS}, first string, last string, "
                "costs array<long>, ranks array<int>, audits array<string>, "
                "roles array<string>, texts array<string>",
            ),
        ),
        "pieces",
    )
    ahead = pieces.where("not whole").select(
        "conv_id", "part", "number", "costs", "ranks", "first", "last"
    )
    chosen = _mapped(
        ahead.repartition("conv_id").sortWithinPartitions(
            "conv_id", F.desc("part"), F.desc("number")
        ),
        _chosen,
        _schema(
            rows,
            "part int, number long, to array<int>, ending boolean, first string, last string",
        ),
    )
    walked = _mapped(
        chosen.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number"),
        _walked,
        "part int, number long, piece long, state int, to int, ending boolean, joint int",
    )
    cut = pieces.where("not whole").join(walked, ["part", "number"]).select(
        "conv_id",
        "piece",
        "whole",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "joint",
        F.col("state").alias("state_before"),
        "to",
        "ending",
        "costs",
        "audits",
        "roles",
        "texts",
    )
    result = _schema(
        rows, f"piece long, whole boolean, {_FAULTS}, roles array<string>, texts array<string>"
    )
    names = [field.split(" ")[0] for field in result.split(", ")]
    done = pieces.where("whole").withColumn("piece", F.lit(0).cast("long")).select(*names)
    return done.unionByName(_mapped(cut, _finished, result))


def lines(pieces: DataFrame) -> DataFrame:
    """Each repaired row as `role:text` with a line end between them, a piece at a time."""
    rows = F.transform(
        F.arrays_zip("roles", "texts"), lambda r: F.concat(r["roles"], F.lit(":"), r["texts"])
    )
    return pieces.withColumn("lines", F.array_join(rows, "\n"))


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Pieces of a conversation come in order: counts are added, and the text runs through the hash."""
    now, digest, audits, kept = None, None, [], False

    def out():
        return now | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        for row in batch.to_pylist():
            text, some, audit = row.pop("lines"), row.pop("some"), row.pop("audit")
            if now is None or now["conv_id"] != row["conv_id"]:
                if now is not None:
                    yield out()
                now, digest, audits, kept = row, hashlib.sha256(), [], False
            else:
                for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    now[name] += row[name]
            audits.append(audit)
            if some:
                digest.update((b"\n" if kept else b"") + text.encode())
                kept = True
    if now is not None:
        yield out()


def summary(pieces: DataFrame) -> DataFrame:
    """One row a conversation: the faults, cost and letters of all its pieces, and the SHA-256 of its
    repaired rows as `role:text` lines.

    A conversation of many pieces sends one joined string of each through one task, in
    order and one at a time: a SHA-256 can only be taken so.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    said = lines(pieces)
    whole = said.where("whole").select(
        "conv_id", *counts, "audit", F.sha2("lines", 256).alias("repaired_sha256")
    )
    cut = said.where("not whole").select(
        "conv_id", "piece", *counts, "audit", "lines", (F.size("roles") > 0).alias("some")
    )
    cut = cut.repartition("conv_id").sortWithinPartitions("conv_id", "piece").drop("piece")
    schema = _schema(pieces, f"{_FAULTS}, repaired_sha256 string")
    return whole.unionByName(_mapped(cut, _summed, schema))


def gaps(rows: DataFrame) -> DataFrame:
    """`conv_id, gaps`: numbers missing between the smallest and the largest turn; without turns 0.

    A count beyond a long stops at its end.
    """
    turn = rows["turn"].cast("long")
    span = F.max(turn).cast("decimal(38,0)") - F.min(turn).cast("decimal(38,0)") + F.lit(1)
    missing = F.least(span - F.count_distinct(turn), F.lit(2**63 - 1).cast("decimal(38,0)"))
    found = F.when(F.max(turn).isNull(), F.lit(0)).otherwise(missing.cast("long"))
    return rows.groupBy(rows["conv_id"].alias("conv_id")).agg(found.alias("gaps"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults: by crc32 of `conv_id:turn`, modulo 20, rows are dropped (0),
    emptied (1), lose `.!?` (2), come twice (3) or get the role user (4).

    Null is one blank in the checksum, role and text. Returns `conv_id, turn, role, text`.
    """

    def said(name: str):
        return F.coalesce(conversations[name].cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = said("text")
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        conversations["conv_id"].alias("conv_id"),
        conversations["turn"].alias("turn"),
        F.when(kind == 4, "user").otherwise(said("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    ).drop("copy")

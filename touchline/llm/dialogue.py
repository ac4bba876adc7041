"""Repair of conversations by generalised LR parsing with weighted edits.

The roles of a conversation should read ``(s?(ua)+)?``: an optional system turn, then pairs of a user and an assistant turn.
A parse reads the turns from left to right and keeps all stacks that are still possible; deleting, re-roling or inserting a
turn is an action with a cost. Stacks with equal tops have the same future, so only the one with the least (cost, audit) stays,
the audit being the edits so far by their initials. At most four stacks are alive at any turn.

Turns that must be told apart are counted first: equal turns at one place become one row with a number. Rows are then
range-partitioned by conversation and place, so a conversation of any length is spread over tasks. A task repairs the
conversations that lie inside its range at once. For one that reaches over the range's border it gives, for each stack top that
the part before may leave, the best edits to each top it may hand on. Those few summaries of a conversation are chained, and
its turns are then read once more to apply the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import partitions, read, stored

# What may follow each stack top, the stacks that may end, costs of the edits.
FOLLOWS = {"": "su", "s": "u", "u": "a", "p": "u"}
ENDS = ("", "p")
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
SPACE = r"\x20\x09-\x0D"


# --- the parse -------------------------------------------------------------------------------

def shift(stack: str, symbol: str) -> str | None:
    """The stack after one more symbol, with pairs reduced; None if the symbol may not follow."""
    if symbol not in FOLLOWS[stack[-1:]]:
        return None
    return (stack + symbol).replace("ua", "p").replace("pp", "p")


def _merge(cands):
    """Of (extra cost, order, parent, edits, stack): the least for each stack top."""
    best = {}
    for c in cands:
        top = c[4][-1:]
        if top not in best or c[:2] < best[top][:2]:
            best[top] = c
    return list(best.values())


def _inserted(state) -> list:
    """All stacks that insertions before the next turn can reach, the given ones included."""
    cands = [(extra, (rank, ""), rank, "", stack) for rank, (stack, extra) in enumerate(state)]
    best = {}
    while cands:
        cands.sort(key=lambda c: c[:2])
        c = cands.pop(0)
        if c[4][-1:] in best:
            continue
        best[c[4][-1:]] = c
        for symbol in "ua":
            if (grown := shift(c[4], symbol)) is not None:
                cands.append((c[0] + INSERT, (c[2], c[3] + "I"), c[2], c[3] + "I", grown))
    return list(best.values())


@lru_cache(maxsize=1 << 16)
def step(state: tuple, kind: tuple[str, str]):
    """One turn. ``state`` holds (stack, cost above the least) in order of the audits; ``kind`` is (role initial, fault).

    Gives the cost added to the least, the new state, and for each of its stacks (index of the stack it came from, edits).
    Two audits up to the same turn are never one the beginning of the other, so their order stays whatever follows.
    """
    initial, fault = kind
    more = TRUNCATED if fault == "truncated" else 0
    cands = [(extra + DELETE, (rank, "D"), rank, "D", stack) for rank, (stack, extra) in enumerate(state)]
    if fault in ("", "truncated"):
        for extra, (rank, _), _, edits, stack in _inserted(state):
            for symbol, edit, cost in ((initial, "K", KEEP), ("u", "R", REROLE), ("a", "R", REROLE)):
                if symbol != "?" and (grown := shift(stack, symbol)) is not None:
                    cands.append((extra + cost + more, (rank, edits + edit), rank, edits + edit, grown))
    left = sorted(_merge(cands), key=lambda c: c[1])
    least = min(c[0] for c in left)
    return least, tuple((c[4], c[0] - least) for c in left), tuple((c[2], c[3]) for c in left)


class Parse:
    """A run over turns from one stack top; remembers one small cached tuple for each turn."""

    def __init__(self, stack: str = ""):
        self.state, self.cost, self.trail = ((stack, 0),), 0, []

    def turn(self, kind: tuple[str, str], copies: int = 0) -> None:
        """A turn, and that many copies after it that must go."""
        added, self.state, links = step(self.state, kind)
        self.cost += added
        self.trail.append((links, 0))
        self.copies(copies)

    def copies(self, n: int) -> None:
        if n:
            self.cost += n * DELETE
            self.trail.append((None, n))

    def audit(self, index: int) -> str:
        out = []
        for links, n in reversed(self.trail):
            if links is None:
                out.append("D" * n)
            else:
                index, edits = links[index]
                out.append(edits)
        return "".join(reversed(out))

    def exits(self) -> list[tuple[str, int]]:
        """(stack top, cost) of every stack alive, in order of their audits."""
        return [(stack[-1:], self.cost + extra) for stack, extra in self.state]

    def audit_to(self, top: str) -> str:
        return self.audit(next(i for i, (stack, _) in enumerate(self.state) if stack[-1:] == top))


def ending(exits: list[tuple[str, int]]) -> tuple[int, int, str]:
    """Least cost after insertions that complete the conversation, the exit it comes from, and these insertions."""
    cost, _, index, edits, _ = min((c for c in _inserted(tuple(exits)) if c[4][-1:] in ENDS), key=lambda c: c[:2])
    return cost, index, edits


def chain_parts(parts: list[dict[str, list[tuple[str, int]]]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, insertions at the end, and (entry top, exit top) of each part, from each part's exits by entry top.

    Audits need not be compared: they are ordered by the audit of the parts before, then by that of the part.
    """
    alive, back = [("", 0)], []  # in order of the audits
    for exits_of in parts:
        cands = [(cost + more, (rank, i), rank, top) for rank, (entry, cost) in enumerate(alive)
                 for i, (top, more) in enumerate(exits_of[entry])]
        best: dict[str, tuple] = {}
        for c in sorted(cands):
            best.setdefault(c[3], c)
        ordered = sorted(best.values(), key=lambda c: c[1])
        back.append([(c[2], alive[c[2]][0], c[3]) for c in ordered])
        alive = [(c[3], c[0]) for c in ordered]
    cost, index, edits = ending(alive)
    path = []
    for links in reversed(back):
        index, entry, top = links[index]
        path.append((entry, top))
    return cost, edits, path[::-1]


def apply_edits(turns: Iterator[tuple[str, str]], audit: str, entry: str = "") -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) in order; the role and text of a deleted turn are its own."""
    stack = entry
    for edit in audit:
        if edit == "I":
            symbol = next(x for x in FOLLOWS[stack[-1:]] if x in NAMES)
            role, text = NAMES[symbol], ""
        else:
            role, text = next(turns)
            if edit == "D":
                yield edit, role, text
                continue
            if edit == "R":
                symbol = next(x for x in FOLLOWS[stack[-1:]] if x in NAMES)
                role = NAMES[symbol]
            else:
                symbol = role[:1]
        stack = shift(stack, symbol)
        yield edit, role, text


# --- turns as rows ---------------------------------------------------------------------------

def fault(text: Column) -> Column:
    """'blank', 'truncated' or '' by the text alone."""
    return (F.when(~text.rlike(f"[^{SPACE}]"), "blank")
             .when(~text.rlike(f"[.!?][{SPACE}]*\\z"), "truncated").otherwise(""))


def counted_turns(turns: DataFrame) -> DataFrame:
    """Equal turns at one place as one row: conv_id, turn, role, text, n, fault, and whether the first is seen earlier.

    Place is the turn number (nulls first), then role and text. A null role or text counts as one space.
    """
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                        *([F.col("n")] if "n" in turns.columns else [F.lit(1).cast("long").alias("n")]))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    same = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.first("text").alias("text"), F.sum("n").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("at"))
    # Only what occurs at several places: few rows, so that the join below seldom moves the texts.
    several = (rows.select("conv_id", "role", "digest", place.alias("place")).distinct()
                   .groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first"), F.count("*").alias("_n"))
                   .filter("_n > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
    joined = same.join(several, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r"))
                       & (F.col("digest") == F.col("_d")), "left")
    return joined.select("conv_id", "turn", "role", "text", "digest", "n", fault(F.col("text")).alias("fault"),
                         F.coalesce(place > F.col("first"), F.lit(False)).alias("seen"))


_ROW = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64()),
        ("fault", pa.string()), ("seen", pa.bool_())]
_COUNTS = [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns", "cost")]
_EXIT = pa.struct([("entry", pa.string()), ("top", pa.string()), ("cost", pa.int64())])
_SUMMARY = [("first_role", pa.string()), ("last_role", pa.string()), ("exits", pa.list_(_EXIT))]
# Kind 0: a result. Kind 1: a turn of a conversation at a border. Kind 2: the summary of its part.
_LINE = [("kind", pa.int32()), ("part", pa.int32()), ("pos", pa.int64()), *_ROW, *_COUNTS, *_SUMMARY, ("audit", pa.string()),
         ("repaired_sha256", pa.string()), ("edit", pa.string())]
_CHAINED = [("conv_id", pa.int64()), ("part", pa.int32()), ("entry", pa.string()), ("top", pa.string()), ("tail", pa.string()), *_COUNTS]
_SPARK = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.int32(): "int",
          pa.list_(_EXIT): "array<struct<entry:string,top:string,cost:long>>"}


def _ddl(fields) -> str:
    return ", ".join(f"{name} {_SPARK[kind]}" for name, kind in fields)


def _batch(lines: list[dict], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.get(n) for x in lines], k) for n, k in fields], [n for n, _ in fields])


def _batches(lines: Iterator[dict], fields, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Lines in batches of about ``most`` bytes."""
    out, size = [], 0
    for line in lines:
        out.append(line)
        size += 200 + len(line.get("text") or "") + len(line.get("audit") or "")
        if size >= most:
            yield _batch(out, fields)
            out, size = [], 0
    if out:
        yield _batch(out, fields)


def _rows(batches, fields=_ROW) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name, _ in fields], strict=True)


class Tally:
    """Counts over the turns of a conversation, or of a part of one, and its parses from the given stack tops."""

    def __init__(self, entries=("",)):
        self.parses = {e: Parse(e) for e in entries}
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn, role: str, n: int, fault: str, seen: bool) -> None:
        """``n`` equal turns: the first may stay, the others are duplicates, or blank."""
        initial, what = role[:1], fault if fault == "blank" or not seen else "duplicate"
        if what:
            self.faults[what] += 1
        self.faults["blank" if what == "blank" else "duplicate"] += n - 1
        for parse in self.parses.values():
            parse.turn((initial if initial and initial in "sua" else "?", what), n - 1)
        self.illegal += (n - 1) * (2 * initial not in LEGAL)
        if self.last_role is None:
            self.first_role = initial
        else:
            self.illegal += self.last_role + initial not in LEGAL
        self.last_role = initial
        if turn is not None:  # turns come in order
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def line(self) -> dict:
        return self.faults | {"illegal": self.illegal, "first_turn": self.first_turn, "last_turn": self.last_turn, "turns": self.turns}


def _tally(rows: Iterator[tuple], entries=("",)) -> Tally:
    tally = Tally(entries)
    for _, turn, role, _, n, what, seen in rows:
        tally.add(turn, role, n, what, seen)
    return tally


def _results(base: dict, parts: Iterator[tuple[int, list[tuple], str, str]], edits_wanted: bool) -> Iterator[dict]:
    """The result lines of one conversation, from (part, turns, entry top, audit) of its parts in order."""
    sha, whole, lines = hashlib.sha256(), [], 0
    for part, rows, entry, audit in parts:
        turns = ((r[2], r[3]) for r in rows for _ in range(r[4]))
        for pos, (edit, role, text) in enumerate(apply_edits(turns, audit, entry)):
            if edits_wanted:
                yield {"kind": 0, "conv_id": base["conv_id"], "part": part, "pos": pos, "edit": edit, "role": role, "text": text}
            elif edit != "D":
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        whole.append(audit)
    if not edits_wanted:
        yield base | {"kind": 0, "audit": "".join(whole), "repaired_sha256": sha.hexdigest()}


def _repair_ranges(edits_wanted: bool):
    """Repairs what lies inside a range of sorted turns; the first and the last conversation may reach over its border."""
    def run(batches):
        part = TaskContext.get().partitionId()

        def lines():
            at_border, waiting = True, None
            for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
                if waiting is not None:
                    yield from inside(*waiting)
                    waiting = None
                if at_border:
                    yield from border(conv_id, rows)
                    at_border = False
                else:
                    waiting = conv_id, list(rows)
            if waiting is not None:
                yield from border(*waiting)

        def inside(conv_id, rows):
            tally = _tally(rows)
            parse = tally.parses[""]
            cost, index, tail = ending(parse.exits())
            base = tally.line() | {"conv_id": conv_id, "cost": cost}
            yield from _results(base, [(part, rows, "", parse.audit(index) + tail)], edits_wanted)

        def border(conv_id, rows):
            tally, pos = Tally(tuple(FOLLOWS)), 0
            for pos, r in enumerate(rows):
                tally.add(r[1], r[2], *r[4:])
                yield {"kind": 1, "part": part, "pos": pos} | dict(zip([n for n, _ in _ROW], r, strict=True))
            exits = [{"entry": e, "top": t, "cost": c} for e, parse in tally.parses.items() for t, c in parse.exits()]
            yield tally.line() | {"kind": 2, "part": part, "conv_id": conv_id, "exits": exits,
                                  "first_role": tally.first_role, "last_role": tally.last_role}
        return _batches(lines(), _LINE)
    return run


def _chain(table: pa.Table) -> pa.Table:
    """Counts of a whole conversation, and where each of its parts begins and ends in the cheapest parse."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    by = [{e: [(x["top"], x["cost"]) for x in r["exits"] if x["entry"] == e] for e in FOLLOWS} for r in rows]
    cost, tail, path = chain_parts(by)
    total = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal", "turns")} | {"cost": cost}
    for a, b in zip(rows, rows[1:], strict=False):
        total["illegal"] += a["last_role"] + b["first_role"] not in LEGAL
        total["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    total["first_turn"] = next((r["first_turn"] for r in rows if r["first_turn"] is not None), None)
    total["last_turn"] = next((r["last_turn"] for r in reversed(rows) if r["last_turn"] is not None), None)
    tails = [""] * (len(rows) - 1) + [tail]
    lines = [total | {"conv_id": r["conv_id"], "part": r["part"], "entry": e, "top": t, "tail": x}
             for r, (e, t), x in zip(rows, path, tails, strict=True)]
    return pa.Table.from_batches([_batch(lines, _CHAINED)])


def _finish_borders(edits_wanted: bool):
    """Edits of the conversations at borders, one part at a time; only their digest runs over all parts."""
    fields = [*_ROW, *[f for f in _CHAINED if f[0] != "conv_id"]]
    names = [n for n, _ in fields]

    def run(batches):
        def lines():
            for _, rows in groupby(_rows(batches, fields), key=lambda r: r[0]):
                first = next(rows)
                base = dict(zip(names, first, strict=True))
                base = {n: base[n] for n in ("conv_id", *[n for n, _ in _COUNTS])}
                yield from _results(base, parts(chain([first], rows)), edits_wanted)

        def parts(rows):
            for part, own in groupby(rows, key=lambda r: r[len(_ROW)]):
                own = list(own)
                _, entry, top, tail = own[0][len(_ROW):len(_ROW) + 4]
                yield part, own, entry, _tally((r[:len(_ROW)] for r in own), (entry,)).parses[entry].audit_to(top) + tail
        return _batches(lines(), _LINE)
    return run


def _repaired(turns: DataFrame, edits_wanted: bool) -> DataFrame:
    spark = turns.sparkSession
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    rows = counted_turns(turns).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    done = stored(rows.select(*[n for n, _ in _ROW]).mapInArrow(_repair_ranges(edits_wanted), _ddl(_LINE)), "dialogue")
    summaries = done.filter("kind = 2").select("conv_id", "part", *[n for n, _ in _COUNTS], *[n for n, _ in _SUMMARY])
    chained = summaries.groupBy("conv_id").applyInArrow(_chain, _ddl(_CHAINED))
    chosen = chained.select(F.col("conv_id").alias("_c"), *[F.col(n).alias(f"_{n}") for n, _ in _CHAINED[1:]])
    border = (done.filter("kind = 1").select("part", "pos", *[n for n, _ in _ROW])
              .join(F.broadcast(chosen), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_part")))  # two rows a range
              .withColumn("part", F.col("_part")).repartition(partitions(spark), "conv_id").sortWithinPartitions(
                  F.col("conv_id").asc_nulls_first(), "part", "pos"))
    border = border.select(*[n for n, _ in _ROW], "part", *[F.col(f"_{n}").alias(n) for n, _ in _CHAINED[2:]])
    return done.filter("kind = 0").union(border.mapInArrow(_finish_borders(edits_wanted), _ddl(_LINE)))


def repair_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, part, pos, edit, role, text, in order of part and pos.

    ``edit`` is K (kept), R (re-roled), I (inserted, empty text) or D (a turn that goes, as it was). Of all edits that make
    the roles read ``(s?(ua)+)?``, the cheapest; of these the ASCII-least audit. Blank and repeated turns always go. A null
    role or text counts as one space, a null turn comes first, and rows without conv_id are one conversation. Turns with
    one number are taken in order of role and text. An empty table gives an empty table; other columns are not read.
    """
    return _repaired(turns, True).select("conv_id", "part", "pos", "edit", "role", "text")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation: faults, illegal neighbours, gaps, cost, audit and sha256 of the repaired text.

    The same cases hold as in ``repair_turns``.
    """
    gap = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).otherwise(0)
    return _repaired(turns, False).select("conv_id", gap.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                                          "cost", "audit", "repaired_sha256")


# --- the query -------------------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and n (equal turns) after the damage that crc32 of ``conv_id:turn`` decides."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return turns.filter(what != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(what == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.when(what == 3, 2).otherwise(1).cast("long").alias("n"))


def op13_conversations(spark, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    found = conversation_digests(damaged(turns))
    nothing = hashlib.sha256(b"").hexdigest()
    every = turns.select(F.col("conv_id").cast("long").alias("_c")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("_c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))

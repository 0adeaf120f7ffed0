"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

A legal conversation is `(s?(ua)+)?` in the initials of its roles. Edits: Keep, Rerole to user or assistant,
Delete, Insert an empty user or assistant turn. A dynamic program over the rows finds the cheapest edits; among
equally cheap ones the audit, their initials in order, that is least in ASCII.

Both wishes are one integer. Its high digits carry the cost; below them lie `width` positional digits of `BITS`
bits, one for each letter of the audit from the front, zeros behind its end. The program is then an ordinary
search for the least integer over a directed acyclic graph, whose nodes are (row, state of the roles) just after
a row was kept, reroled or deleted. An edge is up to two insertions and that row's edit. No audit of such a
node is a prefix of another one of the same node (it would have to go on with insertions, but all end with a
row's edit), so what is least at the node stays least whatever follows.

The width does not grow with the conversation: when the digits are used up, the leading ones on which all
nodes agree are decided, told and shifted out (nodes too dear ever to win are dropped first); only if they agree
on none is the width doubled. So a conversation streams through its task, and its rows are held only until
their edits are decided.

Faults of a row, the first counts: blank, duplicate (role and text seen earlier), truncated (the last character
that isn't blank is not one of `.!?`). Blank and duplicate rows must go; a truncated row that stays costs 1 more.

Defined cases: null roles and texts are one space; a null id is a conversation of its own; rows are ordered by
turn (nulls first), then role and text, and repeated rows are duplicates; a role of another initial, an empty
one too, can only be reroled or deleted; a conversation without rows is repaired to none; an empty table gives an
empty result; other columns are not read. One conversation is one task's work, since its digest needs its turns
one after the other.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLANK = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
# A node dearer than the cheapest by more than this never wins: from any state, every other one's
# continuations can be had for at most this much (insert two turns, delete a system row).
MOST_APART = 2 * INSERT + DELETE

LETTERS = " DIKR"  # digit of a letter: its place here, so that digits are ordered like ASCII
BITS = 3
WIDTH = 64
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (START, ASSISTANT)
INITIALS = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
ROLES = {USER: "user", ASSISTANT: "assistant"}


def kept_state(state: int, initial: str) -> int | None:
    """Where keeping a row leads, None if it may not follow."""
    if state == START and initial == INITIALS[SYSTEM]:
        return SYSTEM
    return FOLLOWS[state] if initial == INITIALS[FOLLOWS[state]] else None


def _insertions(state: int) -> Iterator[tuple[int, str, int]]:
    """(state, letters, cost) after none, one or two insertions."""
    for n in range(3):
        yield state, "I" * n, n * INSERT
        state = FOLLOWS[state]


def _moves(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, int, int]]:
    """(from, to, cost, digits, letters) of every way to pass a row."""
    found = []
    for state in FOLLOWS:
        for at, letters, cost in _insertions(state):
            ways = [(at, "D", DELETE)]
            if not must_go:
                ways.append((FOLLOWS[at], "R", REROLE + TRUNCATED * truncated))
                if (kept := kept_state(at, initial)) is not None:
                    ways.append((kept, "K", KEEP + TRUNCATED * truncated))
            for to, letter, own in ways:
                audit = letters + letter
                digits = 0
                for x in audit:
                    digits = digits << BITS | LETTERS.index(x)
                found.append((state, to, cost + own, digits, len(audit)))
    return found


MOVES = {
    (i, go, cut): _moves(i, go, cut) for i in ("s", "u", "a", "") for go in (False, True) for cut in (False, True)
}


class Search:
    """The program over one conversation, row by row; `step` and `close` give the letters decided so far."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.nodes = {START: (0, 0)}  # state: weight, letters used

    def step(self, initial: str, must_go: bool, truncated: bool) -> str:
        told = self._decided() if max(n for _, n in self.nodes.values()) + 3 > self.width else ""
        low, nodes = BITS * self.width, self.nodes
        after: dict[int, tuple[int, int]] = {}
        for state, to, cost, digits, letters in MOVES[initial if initial in ("s", "u", "a") else "", must_go, truncated]:
            if state in nodes:
                weight, used = nodes[state]
                used += letters
                weight += (cost << low) + (digits << (low - BITS * used))
                if to not in after or weight < after[to][0]:
                    after[to] = (weight, used)
        most = ((min(after.values())[0] >> low) + MOST_APART + 1) << low
        self.nodes = {state: node for state, node in after.items() if node[0] < most}
        return told

    def close(self) -> str:
        told = self._decided() if max(n for _, n in self.nodes.values()) + 3 > self.width else ""
        low, ends = BITS * self.width, []
        for state, (weight, used) in self.nodes.items():
            for at, letters, cost in _insertions(state):
                if at in ENDS:
                    for _ in letters:
                        used += 1
                        weight += LETTERS.index("I") << (low - BITS * used)
                    ends.append((weight + (cost << low), used))
                    break
        weight, used = min(ends)
        return told + self._letters(weight, used)

    def _letters(self, weight: int, n: int) -> str:
        low = BITS * self.width
        return "".join(LETTERS[weight >> (low - BITS * i) & (1 << BITS) - 1] for i in range(1, n + 1))

    def _decided(self) -> str:
        """Tell and shift out the leading letters that all nodes share, and make room."""
        low = BITS * self.width
        below = (1 << low) - 1
        first = next(iter(self.nodes.values()))[0]
        apart = 0
        for weight, _ in self.nodes.values():
            apart |= (weight ^ first) & below
        shared = min((low - apart.bit_length()) // BITS, *(n for _, n in self.nodes.values()), self.width)
        told = self._letters(first, shared)
        least = min(self.nodes.values())[0] >> low
        wider = self.width if shared < 3 else 0
        for state, (weight, used) in self.nodes.items():
            cost, digits = (weight >> low) - least, (weight & below) << BITS * shared & below
            self.nodes[state] = ((cost << low | digits) << BITS * wider, used - shared)
        self.width += wider
        return told


def edits(rows: Iterable[tuple[str, str, str]]) -> Iterator[tuple[str, str | None, str | None, tuple | None]]:
    """(letter, role, text, row) of the cheapest edits of `rows`, which begin with (role, text, fault).

    Role and text are those of the repaired turn, None for a deleted one; the row is None for an insertion.
    """
    search, waiting, state = Search(), deque(), START

    def told(letters):
        nonlocal state
        for letter in letters:
            row = waiting.popleft() if letter != "I" else None
            if letter == "D":
                yield letter, None, None, row
                continue
            if letter == "K":
                state = kept_state(state, row[0][:1])
                yield letter, row[0], row[1], row
                continue
            state = FOLLOWS[state]
            yield letter, ROLES[state], row[1] if row else "", row

    for row in rows:
        waiting.append(row)
        yield from told(search.step(row[0][:1], row[2] in ("blank", "duplicate"), row[2] == "truncated"))
    yield from told(search.close())


def edit_cost(letter: str, fault: str | None) -> int:
    whole = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter]
    return whole + (TRUNCATED if fault == "truncated" and letter in "KR" else 0)


def _plain(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with a quarter of the rows damaged, by crc32 of `conv_id:turn` mod 20.

    0 drops the row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes its role user.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    how = F.col("how")
    return (
        _plain(conversations)
        .withColumn("how", F.crc32(name.cast("binary")) % 20)
        .where(how != 0)
        .withColumn("text", F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(how == 4, "user").otherwise(F.col("role")))
        .withColumn("times", F.explode(F.when(how == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select("conv_id", "turn", "role", "text")
    )


def fault(text: Column, seen: Column) -> Column:
    last = F.right(F.rtrim(text, F.lit(BLANK)), F.lit(1))
    return F.when(last == "", "blank").when(seen, "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")


EDITS = (
    "conv_id long, turn long, own_role string, fault string, edit string, cost long, position long, "
    "role string, text string"
)
FRAME_CHARS = 4_000_000


def repair(conversations: DataFrame) -> DataFrame:
    """One row per edit, the edits of a conversation in order and next to each other in one partition.

    turn, own_role, fault (empty: none): of the row (null for an insertion); edit: K, R, D or I; cost;
    position, role, text: of the repaired turn, null for a deleted one.
    """
    same = W.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = (
        _plain(conversations)
        .withColumn("fault", fault(F.col("text"), F.row_number().over(same) > 1))
        .withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
        .select("role", "text", "fault", "turn", "key")
        .repartition("key")
        .sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate")
        .withColumn("turn", F.col("turn").cast("string"))
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, chars = [], 0
        for key, own in groupby(_tuples(frames), itemgetter(4)):
            position = 0
            for letter, role, text, row in edits(own):
                was, _, why, turn, _ = row or (None, None, None, None, None)
                place = None if letter == "D" else position
                out.append((_long(key), _long(turn), was, why, letter, edit_cost(letter, why), place, role, text))
                position += letter != "D"
                chars += len(text or "") + 50
                if chars > FRAME_CHARS:
                    yield _frame(out, EDITS)
                    out, chars = [], 0
        yield _frame(out, EDITS)

    return rows.mapInPandas(run, EDITS)


def _tuples(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    return (row for f in frames for row in zip(*[f[c].tolist() for c in f.columns]))


def _long(text: str | None) -> int | None:
    return int(text) if text else None


def _frame(rows: list, ddl: str) -> pd.DataFrame:
    types = dict(x.split() for x in ddl.split(", "))
    columns = zip(*rows) if rows else [()] * len(types)
    kinds = {"long": "Int64", "string": object}
    return pd.DataFrame({c: pd.Series(list(v), dtype=kinds[k]) for (c, k), v in zip(types.items(), columns)})


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text."""
    return repair(conversations).where("edit <> 'D'").select("conv_id", "position", "role", "text")


DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
MOST_LONG = 2**63 - 1


def digests(made: DataFrame) -> DataFrame:
    """What `repair` made, one row per conversation. Gaps beyond a long are the largest long."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for key, own in groupby(_tuples(frames), itemgetter(0)):
            count = dict.fromkeys(["blank", "duplicate", "truncated"], 0)
            audit, sha, illegal, cost, turns = [], hashlib.sha256(), 0, 0, 0
            before = least = most = None
            between = ""
            for _, turn, was, why, letter, price, role, text in own:
                audit.append(letter)
                cost += price
                if letter != "D":
                    sha.update(f"{between}{role}:{text}".encode())
                    between = "\n"
                if letter == "I":
                    continue
                if why in count:
                    count[why] += 1
                illegal += before is not None and before + was[:1] not in ("su", "ua", "au")
                before = was[:1]
                if (turn := _long(turn)) is not None and turn != most:  # in order of turns
                    least, most, turns = turn if least is None else least, turn, turns + 1
            gaps = 0 if most is None else min(most - least + 1 - turns, MOST_LONG)
            out.append((_long(key), gaps, *count.values(), illegal, cost, "".join(audit), sha.hexdigest()))
        yield _frame(out, DIGEST)

    names = [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("string")]
    return made.select(*names, "own_role", "fault", "edit", "cost", "role", "text").mapInPandas(run, DIGEST)


def report(conversations: DataFrame) -> DataFrame:
    """Damage, repair and digest; every original conversation has a row."""
    found = digests(repair(damaged(conversations)))
    found = found.withColumnRenamed("conv_id", "found_id")
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return joined.fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna(nothing)


# The same least edits from the end of a conversation to its start: v holds, for each of the states (start, system,
# user, assistant), the cheapest (cost, audit, repaired turns) of what follows.
REPORT_SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
             lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                                      lambda c, n: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)),
             4294967295) % 20 AS how
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, LATERAL (SELECT unnest(range(CASE how WHEN 3 THEN 2 ELSE 1 END))) WHERE how <> 0),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending, role[1:1] AS initial,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
  FROM e),
f AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM o),
t AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
p AS (
  SELECT conv_id, n AS i, [{'c': 0, 'a': '', 'r': ''}, {'c': 4, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'},
                           {'c': 2, 'a': 'I', 'r': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 'r': ''}] AS v
  FROM t
  UNION ALL
  SELECT conv_id, i - 1, list_transform([1, 2, 3, 4], lambda x: list_min([
           b[x],
           {'c': b[g[x]].c + 2, 'a': 'I' || b[g[x]].a, 'r': chr(10) || names[g[x]] || ':' || b[g[x]].r},
           {'c': b[g[g[x]]].c + 4, 'a': 'II' || b[g[g[x]]].a,
            'r': chr(10) || names[g[x]] || ':' || chr(10) || names[g[g[x]]] || ':' || b[g[g[x]]].r}]))
  FROM (
    SELECT conv_id, i, g, names, list_transform([1, 2, 3, 4], lambda x: list_min([
             {'c': v[x].c + 3, 'a': 'D' || v[x].a, 'r': v[x].r},
             CASE WHEN stays THEN {'c': v[g[x]].c + 2 + late, 'a': 'R' || v[g[x]].a,
                                   'r': chr(10) || names[g[x]] || ':' || text || v[g[x]].r} END,
             CASE WHEN stays AND (initial = 's' AND x = 1)
                  THEN {'c': v[2].c + late, 'a': 'K' || v[2].a, 'r': chr(10) || role || ':' || text || v[2].r} END,
             CASE WHEN stays AND (initial = 'u' AND g[x] = 3 OR initial = 'a' AND g[x] = 4)
                  THEN {'c': v[g[x]].c + late, 'a': 'K' || v[g[x]].a, 'r': chr(10) || role || ':' || text || v[g[x]].r} END])) AS b
    FROM (SELECT p.conv_id, p.i, p.v, f.role, f.text, f.initial, f.fault IN ('', 'truncated') AS stays,
                 (f.fault = 'truncated')::INT AS late, [3, 3, 4, 3] AS g, ['', '', 'user', 'assistant'] AS names
          FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.i))),
r AS (SELECT conv_id, v[1].c AS cost, v[1].a AS audit, substr(v[1].r, 2) AS repaired FROM p WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN t ON c.conv_id IS NOT DISTINCT FROM t.conv_id
     LEFT JOIN r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""

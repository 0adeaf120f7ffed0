import hashlib
import random
import zlib

import pytest
from fixtures import EXTRA
from pyspark.sql import functions as F

from wattline.llm import structure

CONVERSATIONS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows, most_inserts=3):
    """(cost, audit, repaired turns) by trying every edit; rows: (role, text, must go, truncated)."""
    known = {}

    def rest(i, state, inserted):
        if (i, state, inserted) in known:
            return known[i, state, inserted]
        new = "assistant" if state == "u" else "user"
        found = [(10**9, "", ())]
        if i == len(rows):
            found += [(0, "", ())] if state in ("", "a") else []
        else:
            role, text, must_go, cut = rows[i]
            cost, audit, out = rest(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, out))
            if not must_go:
                cost, audit, out = rest(i + 1, new[0], 0)
                found.append((cost + cut + 2, "R" + audit, (f"{new}:{text}", *out)))
                if role[:1] == new[0] or role[:1] == "s" and state == "":
                    cost, audit, out = rest(i + 1, role[:1], 0)
                    found.append((cost + cut, "K" + audit, (f"{role}:{text}", *out)))
        if inserted < most_inserts:
            cost, audit, out = rest(i, new[0], inserted + 1)
            found.append((cost + 2, "I" + audit, (f"{new}:", *out)))
        known[i, state, inserted] = min(found)
        return known[i, state, inserted]

    return rest(0, "", 0)


def faults(rows):
    """(role, text, fault) of rows that are in order."""
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        why = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, why))
    return out


def brute_force(table):
    """The report's rows."""
    own = {conv: [] for conv, *_ in table}
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 1:
            text = ""
        if how == 2:
            text = "".join(c for c in text if c not in ".!?")
        if how == 4:
            role = "user"
        own[conv] += [(turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    out = []
    for conv, rows in own.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {r[0] for r in rows} - {None}
        gaps = min(max(turns) - min(turns) + 1 - len(turns), 2**63 - 1) if turns else 0
        found = faults([r[1:] for r in rows])
        counts = [sum(f[2] == why for f in found) for why in ("blank", "duplicate", "truncated")]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        cost, audit, turns = cheapest([(r, t, w in ("blank", "duplicate"), w == "truncated") for r, t, w in found])
        digest = hashlib.sha256("\n".join(turns).encode()).hexdigest()
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return sorted(out, key=repr)


def conversations():
    rng = random.Random(4)
    texts = ["Hello.", "hello", "Why?", "", " \t\n", None, "x \r\n", "Well!\x0b", "é.", "。", "a: b\nuser: c.", "\x00"]
    roles = ["user", "assistant", "system", "user", "assistant", "User", "", None, "a", "tool", "sage", "été"]
    out = []
    for conv in range(150):
        known = rng.choice([3, 5, 12])
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14])):
            role = rng.choice(roles[:known]) if rng.random() < 0.5 else ["user", "assistant"][turn % 2]
            text = rng.choice(texts) if rng.random() < 0.5 else f"{turn} {'.' if rng.random() < 0.8 else ''}"
            out.append((conv, rng.choice([turn, turn, turn * 3, None, 2**62 + 3, -(2**62)]), role, text))
    out += [(None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 2, None, None)]
    out += [(-5, t, "user", None) for t in range(3)] + [out[3], out[3], out[9]]
    out += [(2**62 + 1, -(2**63), "user", "Far."), (2**62 + 1, 2**63 - 1, "assistant", "Off.")]
    return out + [(7000, 0, "user", "long " * 50_000), (7000, 1, "assistant", "?" * 1000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, CONVERSATIONS).repartition(3).withColumns({c: F.lit("extra") for c in [*EXTRA, "edit", "fault", "how", "times"]})


def collected(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


def test_report_equals_brute_force(spark):
    table = conversations()
    assert collected(structure.report(frame(spark, table))) == brute_force(table)


@pytest.mark.parametrize("width", [6, 7, structure.WIDTH])
def test_every_width_decides_alike(width, monkeypatch):
    rng = random.Random(width)
    for n in [0, 1, 2, 3, 4, 6, 9, 15, 40, 90] * 12:
        rows = []
        for _ in range(n):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool"])
            rows.append((role, "t", rng.choice(["", "", "", "truncated", "blank", "duplicate"])))
        if rng.random() < 0.3:  # roles that alternate for long
            rows = [(("user", "assistant")[i % 2], "t", "") for i in range(n)] + rows
        search = structure.Search(width)
        audit = "".join(search.step(r[:1], w in ("blank", "duplicate"), w == "truncated") for r, _, w in rows) + search.close()
        assert audit == cheapest([(r, t, w in ("blank", "duplicate"), w == "truncated") for r, t, w in rows])[1]


def test_a_long_conversation_needs_few_digits_and_few_rows():
    rng = random.Random(1)
    search, told, most = structure.Search(), 0, 0
    for i in range(100_000):
        told += len(search.step("ua"[i % 2] if rng.random() < 0.9 else "s", rng.random() < 0.05, rng.random() < 0.3))
        most = max(most, i - told)
    assert search.width <= 2 * structure.WIDTH and most <= 2 * structure.WIDTH


def test_repaired_conversations_are_legal_and_in_order(spark):
    table = conversations()
    out = {}
    for r in structure.repaired(frame(spark, table)).collect():
        out.setdefault(r.conv_id, []).append((r.position, r.role, r.text))
    for conv, rows in out.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        initials = "".join(r[1][0] for r in rows)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
    assert out[7000][0][2] == "long " * 50_000


def test_edits_name_their_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "q"), (1, 2, "user", "q"), (1, 4, "user", "Q."), (1, 5, "user", "")]
    made = [(r.turn, r.own_role, r.fault, r.edit, r.cost, r.position, r.role, r.text) for r in structure.repair(frame(spark, rows)).collect()]
    assert made == [
        (0, "system", "", "K", 0, 0, "system", "S."),
        (1, "user", "truncated", "K", 1, 1, "user", "q"),
        (2, "user", "duplicate", "D", 3, None, None, None),
        (4, "user", "", "R", 2, 2, "assistant", "Q."),
        (5, "user", "blank", "D", 3, None, None, None),
    ]


def test_empty(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert structure.report(none).count() == 0 and structure.repaired(none).count() == 0

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from basketlens.llm import dialogue

NEXT = {"0": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FULL = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    """The contract's faults, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def cheapest(rows):
    """(cost, edits) by trying all edits from the end, with the whole strings compared."""
    best = {"0": (0, ""), "a": (0, "")}

    def inserted(table):
        for _ in range(3):
            for state in NEXT:
                to = "a" if state == "u" else "u"
                if to in table:
                    cost, edits = table[to]
                    table[state] = min(table.get(state, (1 << 40, "")), (cost + 5, "I" + edits))
        return table

    best = inserted(best)
    for initial, fault in reversed(rows):
        table = {}
        for state in NEXT:
            options = []
            if state in best:
                options.append((2, "D", state))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if initial in NEXT[state]:
                    options.append((extra, "K", NEXT[state][initial]))
                options += [(1 + extra, "R", NEXT[state][role]) for role in "ua" if role in NEXT[state]]
            found = [(cost + best[to][0], edit + best[to][1]) for cost, edit, to in options if to in best]
            if found:
                table[state] = min(found)
        best = inserted(table)
    return best["0"]


def brute(rows):
    """conv_id -> report of the damaged rows."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    found = {}
    for conv, turns in groups.items():
        # the order of rows with one turn is the operator's: by role and hash of the text, so tests give such rows one role and text
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, marked, counts = set(), [], defaultdict(int)
        for turn, role, text in turns:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role[:1], fault))
        initials = [i for i, _ in marked]
        cost, edits = cheapest(marked)
        known = {t for t, _, _ in turns if t is not None}
        state, at, lines = "0", 0, []
        for edit in edits:
            wanted = "a" if state == "u" else "u"
            if edit == "I":
                lines.append(FULL[wanted] + ":")
                state = wanted
                continue
            _, role, text = turns[at]
            at += 1
            if edit == "D":
                continue
            lines.append(f"{role if edit == 'K' else FULL[wanted]}:{text}")
            state = role[:1] if edit == "K" else wanted
        found[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0,
            counts["blank"], counts["duplicate"], counts["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def check(spark, original, rows):
    frames = [spark.createDataFrame(r, SCHEMA).repartition(3) for r in (original, rows)]
    found = {r.conv_id: tuple(r)[1:] for r in dialogue.reports(*frames).collect()}
    wanted = {conv: EMPTY for conv, *_ in original} | brute(rows)
    assert found == wanted


def conversations(seed, n, longest):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(pick.randrange(1, longest)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            text = pick.choice(["", " \n", "Yes.", "So it is", f"Word {pick.randrange(40)}!", "Well? "])
            if pick.random() > 0.1:
                rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("block", [16_384, 7])
def test_against_all_edits(spark, monkeypatch, block):
    """Whole conversations in one block, and most of them cut over several."""
    monkeypatch.setattr(dialogue, "BLOCK_ROWS", block)
    rows = conversations(block, 60, 30)
    check(spark, rows, rows)


def test_runs_and_memory_agree_with_single_steps():
    pick = random.Random(3)
    for _ in range(300):
        symbols = [pick.choice("suaoSUAOx") for _ in range(pick.randrange(12)) for _ in range(pick.choice([1, 1, 2, 5]))]
        rows = [(s.lower() if s != "x" else "o", "blank" if s == "x" else "truncated" if s.isupper() else None) for s in symbols]
        edits, state = dialogue._decided([(s, 1) for s in symbols], 0, dialogue._END)
        while dialogue._END[state]:
            edits, state = edits + "I", dialogue._after(state)
        assert edits == cheapest(rows)[1]


def test_given_table(spark, folder):
    original = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, original, damage(original))
    frame = spark.createDataFrame(original, SCHEMA)
    assert sorted(map(tuple, dialogue.damaged(frame).collect())) == sorted(damage(original))


def test_edges(spark):
    """Nulls in every column, equal rows, one turn for all, no rows after damage, a very long text."""
    rows = [(1, None, "user", "Hi."), (1, 2, None, "Yes."), (1, 3, "user", None), (None, 1, "system", "S."), (None, 2, "user", "Q?")]
    rows += [(2, 5, "user", "Again.")] * 40 + [(3, 1, "", "No role."), (4, 9, "user", "long " * 200_000 + ".")]
    rows += [(5, -(1 << 40), "user", "Far."), (5, 1 << 40, "assistant", "Away.")]
    named = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    gone = [(6, 1, "user", "Only in the original.")]
    check(spark, rows + gone, named)
    frame = spark.createDataFrame([(1, 1, "user", "Hi.", 7, 7)], SCHEMA + ", m long, symbol long")
    assert dialogue.reports(frame, frame).count() == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert dialogue.reports(empty, dialogue.damaged(empty)).count() == 0


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "A."), (1, 2, "user", "U."), (1, 3, "user", "V.")], SCHEMA)
    _, decided = dialogue.decisions(rows)
    fixed = sorted(map(tuple, dialogue.repaired(rows, decided).collect()))
    assert [r[2] for r in fixed] in (["user", "assistant"], ["user", "assistant", "user", "assistant"])
    assert fixed[0][1] == 0 and {r[0] for r in fixed} == {"=1"}

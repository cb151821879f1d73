"""Structure repair against a search through all edit lists."""

import hashlib
import random
import re
from itertools import product

import pytest

from lapwise.llm import repair
from lapwise.llm.repair import Repair, repair_conversations, summaries

SCHEMA = "conv_id long, turn long, role string, text string, fault string, place int"
DIGEST_OF_NOTHING = hashlib.sha256(b"").hexdigest()
FITS = re.compile(r"(s?(ua)+)?")
#: What some further rows can still complete.
OPEN = re.compile(r"s?(ua)*u?")


def cheapest(rows):
    """(cost, letters, initials after) over all edit lists for rows (initial, fault)."""
    insertions = [()] + [t for n in (1, 2) for t in product("ua", repeat=n)]
    lists = {("", 0, "")}  # letters, cost, initials
    for initial, fault in rows:
        grown = set()
        for letters, cost, so_far in lists:
            for before in insertions:
                base = (letters + "I" * len(before), cost + 2 * len(before), so_far + "".join(before))
                grown.add((base[0] + "D", base[1] + 3, base[2]))
                if fault not in ("blank", "duplicate"):
                    extra = fault == "truncated"
                    grown.add((base[0] + "K", base[1] + extra, base[2] + (initial or "?")))
                    grown |= {(base[0] + "R", base[1] + 2 + extra, base[2] + r) for r in "ua"}
        lists = {g for g in grown if OPEN.fullmatch(g[2])}
    ended = {(c + 2 * len(e), s + "I" * len(e), r + "".join(e)) for s, c, r in lists for e in insertions}
    return min(e for e in ended if FITS.fullmatch(e[2]))


def by_states(rows):
    state = Repair(spool_bytes=7)
    for row in rows:
        state.add(*row)
    cost, ending, file = state.finish()
    letters, initials = "", ""
    for (_, letter, role, _, inserted, piece), (initial, _) in zip(state.path(file), rows, strict=True):
        letters += piece
        initials += inserted + {"K": initial, "R": role, "D": ""}[letter]
    return cost, letters + "I" * len(ending), initials + ending


@pytest.mark.parametrize("seed", range(4))
def test_agrees_with_all_edit_lists(seed, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 2)
    rng = random.Random(seed)
    faults = [None, None, "truncated", "blank", "duplicate"]
    for _ in range(40):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice(faults)) for _ in range(rng.randint(0, 4))]
        assert by_states(rows) == cheapest(rows), rows


def brute(rows):
    """The summary of one conversation's rows (turn, role, text)."""
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda w: (w[0] is not None, w[0] or 0, w[1].encode(), w[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    state = [(r[:1], f) for (_, r, _), f in zip(rows, faults)]
    cost, letters, initials = cheapest(state)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[0] + b[0] for a, b in zip(state, state[1:])]
    left, kept = iter(rows), []
    for letter in letters:
        _, role, text = next(left) if letter != "I" else (None, None, "")
        if letter != "D":
            initial = initials[len(kept)]
            kept.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[initial]}:{text}")
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        letters,
        hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    )


def table(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "own", 3) for c, t, r, x in rows], SCHEMA)


def found(spark, rows, **options):
    out = summaries(repair_conversations(table(spark, rows), **options)).collect()
    assert len({r.conv_id for r in out}) == len(out)
    return {r.conv_id: tuple(r)[1:] for r in out}


@pytest.mark.parametrize("spool_bytes", [1 << 24, 50])
def test_summaries_agree_with_brute_force(spark, spool_bytes):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "cut", " \t\n", "", None, "Is it?\n ", "ä. ", "Yes."]
    rows = []
    for conv in [None, *range(40)]:
        # Turns are missing, null and tied; rows are repeated.
        for _ in range(rng.randint(1, 5)):
            row = (conv, rng.choice([None, 0, 1, 2, 5]), rng.choice(["user", "assistant", "system", None, "tool", "user"]), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2])
    rng.shuffle(rows)
    expected = {}
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == conv]
        if len(own) <= 5:
            expected[conv] = brute(own)
    out = found(spark, rows, spool_bytes=spool_bytes)
    assert set(out) == {r[0] for r in rows}
    assert {c: out[c] for c in expected} == expected and len(expected) > 25


def test_a_giant_conversation_goes_through_scratch_files(spark):
    """Rows and choices beyond the bound, several Arrow batches, one very long text."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for t in range(30_000)] + [(2, 0, "user", "long " * 200_000 + "end.")]
    rows[20_001] = (1, 20_001, "user", "Text 20001.")
    small, large = found(spark, rows, spool_bytes=1_000), found(spark, rows)
    assert small == large
    letters = large[1][6]
    assert large[1][5] == 2 and letters.count("K") == 29_999 and letters[20_001] == "R" and large[2][6] == "KI"


def test_edits_are_rows_in_order(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "cut"), (1, 3, "assistant", "cut"), (1, 4, "user", "And?")]
    out = sorted(repair_conversations(table(spark, rows)).drop("conv_id", "was").collect())
    assert [tuple(r) for r in out] == [
        (0, "K", 0, None, "system", "Be kind."),
        (1, "R", 1, None, "user", "Hello."),
        (2, "K", 2, "truncated", "assistant", "cut"),
        (3, "D", 3, "duplicate", None, None),
        (4, "K", 4, None, "user", "And?"),
        (5, "I", None, None, "assistant", ""),
    ]


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_conversations_that_lose_all_rows(spark, tmp_path):
    """Of the registered query: a conversation that damage leaves nothing of counts zeros."""
    import zlib

    from lapwise.llm.queries import QUERIES

    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, turn, "user", "Gone."), (None, None, None, None), (8, 3, "user", None)]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_structure_repair"](spark, str(tmp_path)).collect()}
    assert out[7] == (0, 0, 0, 0, 0, 0, "", DIGEST_OF_NOTHING)
    # Nulls are one space: blank rows, which are deleted.
    assert out[8] == out[None] == (0, 1, 0, 0, 0, 3, "D", DIGEST_OF_NOTHING)

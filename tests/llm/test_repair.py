"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from sheaf.llm import queries, repair
from sheaf.llm.shared import table

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Of the rows (turn, role, text) of one conversation, in order."""
    seen, marks = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        marks.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserts):
        """(cost, audit, lines) of what is left; states n, s, u, a."""
        to = "a" if state == "u" else "u"
        found = [(0, "", ())] if i == len(rows) and state in "na" else []
        if inserts < 3:
            cost, audit, lines = best(i, to, inserts + 1)
            found.append((cost + 2, "I" + audit, ({"u": "user:", "a": "assistant:"}[to], *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, lines))
            if marks[i] not in ("b", "d"):
                more = marks[i] == "t"
                if role[:1] == to or (role[:1] == "s" and state == "n"):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    found.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, to, 0)
                found.append((cost + 2 + more, "R" + audit, ({"u": "user:", "a": "assistant:"}[to] + text, *lines)))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "n", 0)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(marks.count(m) for m in "bdt"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain(rows, every):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv in every:
        own = sorted(
            convs.get(conv, []),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()),
        )
        out[conv] = plain_repair(own)
    return out


def collected(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def test_the_query_on_the_whole_table(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    expected = plain(plain_damage(rows), {r[0] for r in rows})
    assert collected(queries.QUERIES["op13_conversation_repair"](spark, sf)) == expected


def made(rng, n_conv, most):
    rows = []
    for conv in [None, *range(n_conv)]:
        for t in range(rng.randint(0 if conv else 1, most)):
            turn = rng.choice([None, t, t, t, t + 3, t // 2])
            role = rng.choice(["user", "assistant", "system", "assistant", "user", "tool", "", None, "ursa"])
            text = rng.choice(["Yes.", "no", "Why?\n", "", " \t", None, "a b.", "ok!", "long " * 5, "é\U0001f600.", "x "])
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("size", [128, 3])
def test_random_conversations(spark, size):
    """Also in chunks of three rows, when nearly all conversations have several."""
    rng = random.Random(size)
    rows = made(rng, 60, 14)
    rows += rows[:40]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA)
    expected = plain(plain_damage(rows), {r[0] for r in rows})
    assert collected(repair.repaired(df, repair.damaged(df), chunk_rows=size)) == expected


def test_every_small_chunk_by_all_ways():
    """Costs through chunks, put together, are those of the whole."""
    rng = random.Random(4)
    valid = [c | f for c in range(4) for f in (0, 4, 8, 16)]
    for _ in range(300):
        codes = bytes(rng.choices(valid, k=rng.randint(1, 9)))
        whole = repair.Auction(codes, repair._ENDS).path(0)
        cut = rng.randint(0, len(codes))
        ends = list(repair._ENDS)
        for part in (codes[cut:], codes[:cut]):
            if part:
                through = repair.costs_through(part)
                ends = [min(through[4 * a + b] + ends[b] for b in range(4)) for a in range(4)]
        assert ends[0] == whole[0]


def test_a_long_conversation(spark):
    """Thousands of rows of one conversation, over all tasks."""
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", f"t{i}", "", "same."])) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(repair.repair(df))[1]
    codes, seen = bytearray(), set()
    for _, _, role, text in rows:
        code = {"user": 1, "assistant": 2}[role]
        code |= repair.BLANK if not text else repair.REPEATED if (role, text) in seen else 0 if text[-1] == "." else repair.UNFINISHED
        seen.add((role, text))
        codes.append(code)
    # Least costs from the end on, row by row.
    dist = list(repair._ENDS)
    for code in reversed(codes):
        old, dist = dist, [0] * 4
        for state in (3, 0, 1, 2, 3, 0, 1, 2):
            ways = [cost + (old if forward else dist)[to] for _, cost, forward, to in repair._ARCS[code, state] if forward]
            dist[state] = min(ways)
        for _ in range(4):
            dist = [min(dist[s], 2 + dist[repair._NEXT[s]]) for s in range(4)]
    assert got[5] == dist[0] and len(got[6]) >= 3000


def test_tables_without_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collected(repair.repaired(empty, repair.damaged(empty))) == {}
    # Of the conversation 0 only a row that is lost: nothing is wrong with it.
    lost = next(t for t in range(1000) if zlib.crc32(f"0:{t}".encode()) % 20 == 0)
    clash = spark.createDataFrame(
        [(0, lost, "user", "A.", 1, "x", 5)], SCHEMA + ", no INT, digest STRING, kind INT"
    )
    none = hashlib.sha256(b"").hexdigest()
    assert collected(repair.repaired(clash, repair.damaged(clash))) == {0: (0, 0, 0, 0, 0, 0, "", none)}

"""Conversation repair against a search that keeps whole strings, and against plain-Python rows."""

import hashlib
import random

import pytest

from batchgate.llm import conversation_repair as C
from batchgate.llm.queries import damaged, line_digest_rows

SPACE = " \t\n\x0b\x0c\r"
ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}


def search(rows):
    """Least (cost, edits, lines) of (must go, initial, cut off, role, text) rows: inserts anywhere, whole strings compared."""
    def inserted(live):
        for _ in range(3):
            new = dict(live)
            for s, (c, a, lines) in live.items():
                put(new, NEXT[s], (c + 2, a + "I", lines + (ROLE[s] + ":",)))
            live = new
        return live

    def put(new, s, way):
        if s not in new or way < new[s]:
            new[s] = way

    live = {0: (0, "", ())}
    for must, initial, cut, role, text in rows:
        new = {}
        for s, (c, a, lines) in inserted(live).items():
            put(new, s, (c + 3, a + "D", lines))
            if not must:
                kept = lines + (f"{role}:{text}",)
                if initial == ROLE[s][0]:
                    put(new, NEXT[s], (c + cut, a + "K", kept))
                if s == 0 and initial == "s":
                    put(new, 1, (c + cut, a + "K", kept))
                put(new, NEXT[s], (c + 2 + cut, a + "R", lines + (f"{ROLE[s]}:{text}",)))
        live = new
    return min(way for s, way in inserted(live).items() if s in (0, 3))


def expected(rows):
    """conv -> report and digest, from (conv, turn, role, text) rows."""
    out, by_conv = {}, {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or (" " if role is None else ""),
                                             " " if text is None else text, turn))
    for conv, group in by_conv.items():
        group.sort(key=lambda r: r[:4])
        seen, items = set(), []
        blank = dup = cut = 0
        for _, _, role, text, _ in group:
            body = text.strip(SPACE)
            is_blank, is_dup = not body, bool(body) and (role, text) in seen
            is_cut = bool(body) and not is_dup and body[-1] not in ".!?"
            seen.add((role, text))
            blank, dup, cut = blank + is_blank, dup + is_dup, cut + is_cut
            items.append((is_blank or is_dup, role[:1], int(is_cut), role, text))
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        turns = [t for *_, t in group if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = search(items)
        out[conv] = (gaps, blank, dup, cut, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        df = df.selectExpr("*", *[f"'x' AS {c}" for c in ("conv", "seg", "pos", "n", "first", "rid", "blank", "cost", "audit", "s", "start")])
    got = C.repair(df)
    sha = {r["conv"]: r["sha"] for r in C.line_digests(got.lines).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], sha.get(r["conv"], empty))
            for r in got.report.collect()}


def random_rows(rng, conv, n, turns=None):
    texts = ["Yes.", "No?", "cut off", "", " \n", "fine!", "a", None] + [f"text {k}." for k in range(n)]
    return [(conv, rng.choice([k, k, k, k + 1, None]) if turns is None else turns(k),
             rng.choice(["user", "assistant", "assistant", "system", "user", "tool", "", None]), rng.choice(texts)) for k in range(n)]


def decoded(rows, start=0, stop=None, closes=True):
    d, out = C.Decoder(start), []
    for must, initial, cut, *_ in rows:
        out += d.block(1) if must else d.step(initial, bool(cut))
    cost, rest = d.finish(stop, closes)
    return cost, "".join(e for e, _ in out + rest)


def items(rng, n):
    return [(rng.random() < 0.2, rng.choice("suauax"), int(rng.random() < 0.3), "r", "t") for _ in range(n)]


def test_decoder_against_whole_strings():
    rng = random.Random(2)
    for k in range(1500):
        rows = items(rng, 300 if k % 100 == 0 else rng.randrange(12))
        assert decoded(rows) == search(rows)[:2]


def test_segments_compose_to_the_same_edits():
    rng = random.Random(3)
    for k in range(600):
        rows = items(rng, 200 if k % 50 == 0 else 1 + rng.randrange(14))
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(6)))})
        parts = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
        sums = []
        for part in parts:
            ds = [C.Decoder(s) for s in C.STATES]
            for d in ds:
                for must, initial, cut, *_ in part:
                    d.block(1) if must else d.step(initial, bool(cut))
            sums.append(C.summary(ds))
        got = [decoded(p, a, b, i == len(parts) - 1) for i, (p, (a, b)) in enumerate(zip(parts, C.compose(sums)))]
        assert (sum(c for c, _ in got), "".join(a for _, a in got)) == search(rows)[:2]


@pytest.mark.parametrize("letters", ["ua", "suauax", "uuuua", "s"])
def test_survivors_coalesce_so_memory_stays_bounded(letters):
    rng, d, held, given = random.Random(4), C.Decoder(), 0, 0
    for k in range(20_000):
        given += sum(len(e) > 0 for e, _ in d.step(rng.choice(letters), rng.random() < 0.2))
        held = max(held, d.held)
    assert held < 200 and given > 19_000


def test_edits_that_stay_open_are_decided_by_whole_strings():
    """Two ways through a run of one role cost the same to the end: the string's first edit decides."""
    for n in (1, 2, 3, 10, 301, 1000):
        rows = [(False, "a", 0, "r", "t")] * n
        assert decoded(rows) == search(rows)[:2]
    d = C.Decoder()
    for _ in range(50_000):                            # each step compares places, not strings of 50,000 edits
        d.step("a", False)
    assert d.finish()[0] == 50_000


def test_the_place_carried_on_is_the_order_of_the_whole_strings():
    rng, d = random.Random(9), C.Decoder()
    for _ in range(3000):
        d.block(1) if rng.random() < 0.2 else d.step(rng.choice("suuaax"), rng.random() < 0.3)
        assert d.order() == sorted(d.live, key=lambda s: d.live[s][1])


def test_random_conversations_and_awkward_rows(spark):
    rng = random.Random(5)
    rows = [r for conv in range(60) for r in random_rows(rng, conv, rng.randrange(1, 12))]
    rows += random_rows(rng, None, 9) + [(900, None, None, None), (901, 3, "user", "x" * 100_000), (901, 9, "assistant", "ok."),
                                         (902, 1, "user", "same"), (902, 1, "user", "same"), (902, 1, "user", "same"),
                                         (903, 1, "user é", "漢字."), (903, 2, "a", "ok.")]
    assert run(spark, rows) == expected(rows)


def test_a_conversation_with_most_rows_is_cut_and_composed(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_ROWS", 100)
    rng = random.Random(6)
    hot = random_rows(rng, 7, 900) + random_rows(rng, 7, 300, turns=lambda k: 2000 + k)
    rows = hot + [(7, 5000, "user", "again")] * 400 + [r for conv in range(8, 40) for r in random_rows(rng, conv, rng.randrange(1, 20))]
    assert run(spark, rows) == expected(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segs = C._segments(C._named(df, "conv_id", "turn", "role", "text"))
    counts = {(r["conv"], r["seg"]): r["n"] for r in segs.groupBy("conv", "seg").agg({"n": "count"}).toDF("conv", "seg", "n").collect()}
    assert sum(c == 7 for c, _ in counts) > 5 and max(counts.values()) < 400


def test_turns_without_order_in_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_ROWS", 50)
    rng = random.Random(8)
    rows = [(1, None, rng.choice(["user", "assistant"]), f"t{k}.") for k in range(400)]
    assert run(spark, rows) == expected(rows)


def test_empty_table_and_a_conversation_that_loses_all_rows(spark):
    assert run(spark, [(1, 1, "user", "x")]) == expected([(1, 1, "user", "x")])
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    got = C.repair(df)
    assert got.report.count() == 0 and got.lines.count() == 0 and C.line_digests(got.lines).count() == 0
    # crc32('1:3') % 20 etc. decide; a table of which every row is dropped keeps its conversations in the query.
    table = spark.range(2000).selectExpr("id AS conv_id", "id AS turn", "'user' AS role", "'Hi.' AS text")
    out = line_digest_rows(table, C.repair(damaged(table)))
    rows = {r["conv_id"]: r for r in out.collect()}
    lost = [r for r in rows.values() if r["audit"] == ""]
    assert len(rows) == 2000 and 50 < len(lost) < 200
    assert {tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")) for r in lost} == {(0,) * 6}
    assert {r["repaired_sha256"] for r in lost} == {hashlib.sha256(b"").hexdigest()}
